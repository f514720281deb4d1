"""Toxicity classifier with a counterfactual penalty.

A text is cut into sentences (of at most ``UNIT_WORDS`` words each). A
sentence's logit is a bias plus the weights of its distinct features: words,
word beginnings of three to six letters (so that unseen forms of a learned
word count) and pairs of neighbouring words, hashed to ``BUCKETS``. A
document's logit is that of its most toxic sentence, in training as well, so a
label of a whole document finds the sentences it is about.

Counterfactuals: in a sample of labelled sentences every identity term is
swapped for another term of its group; every group holds a neutral term
besides the names of people. Where a sentence has none, one is put in front
before the swap, so that groups that the labels never mention are covered, too. The squared change of the logit is added
to the loss with weight ``PENALTY``: a term that merely names a group cannot
carry toxicity, although labels may correlate with it.

Only features that occur in clearly more documents of one label than of the
other are learned, so that rare ones cannot memorise documents; they are
counted by Spark. The model is trained in numpy on the driver from those
features alone, on a bounded sample of labelled rows: ``TRAIN_ROWS`` per label, of texts of at most ``TRAIN_CHARS`` characters,
drawn by a hash of the id; scoring reads whole texts. Classes are weighted back
to their share of the labels, toxic ones ``TOXIC_COST`` times.

Defined results: a text that is NULL, empty or without a word has the bias
alone; an id with several labels counts as their mean, an id with several rows
as one of them (the least text); rows without a label are scored and not
learned from; with labels of one class the score is their share, without
labels 0.5; repeated rows are scored each; an empty table gives an empty
result. A column of ``docs`` named like ``score_col`` is replaced.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import written

BUCKETS = 1 << 18
UNIT_WORDS = 48
PREFIXES = (3, 4, 5, 6)
TRAIN_ROWS = 3000
TRAIN_CHARS = 50_000
SWAPS = 2
#: A feature is learned if it tells the labels apart by so many standard
#: deviations, in so many documents at least.
LEAST_Z = 5.0
LEAST_DOCS = 3
STEPS = 300
RATE = 0.1
PENALTY = 1.0
#: A missed toxic document costs so many times a false alarm.
TOXIC_COST = 3.0
DECAY = 1e-5
#: Tokens and their characters that a worker remembers, and characters that it
#: describes at a time.
KNOWN_WORDS = 300_000
KNOWN_CHARS = 8_000_000
CHUNK_CHARS = 2_000_000

#: Interchangeable terms, a neutral one first.
IDENTITY_TERMS = (
    ("people", "women", "men", "muslims", "christians", "jews", "hindus", "buddhists", "atheists", "immigrants", "refugees",
     "gays", "lesbians", "africans", "asians", "europeans", "americans", "mexicans", "veterans", "teenagers", "seniors"),
    ("person", "woman", "man", "girl", "boy", "muslim", "christian", "jew", "immigrant", "refugee", "lesbian", "african",
     "asian", "european", "american", "mexican", "veteran", "teenager", "senior"),
    ("nice", "black", "white", "jewish", "islamic", "catholic", "gay", "straight", "transgender", "bisexual", "deaf", "blind",
     "disabled", "old", "young", "foreign"),
    ("gens", "femmes", "hommes", "musulmans", "chrétiens", "juifs", "immigrés", "réfugiés", "homosexuels", "africains",
     "asiatiques", "handicapés"),
    ("leute", "frauen", "männer", "muslime", "christen", "juden", "einwanderer", "flüchtlinge", "schwule", "lesben",
     "afrikaner", "asiaten", "behinderte"),
    ("personas", "mujeres", "hombres", "musulmanes", "cristianos", "judíos", "inmigrantes", "refugiados", "homosexuales",
     "africanos", "asiáticos", "discapacitados"),
)

_ENDS = re.compile(r"[.!?\n]+")
_WORD = re.compile(r"[^\W_]+")
#: Stands between the numbers of words where a sentence ends.
END = -1


def units(text: str) -> list[list[str]]:
    """The sentences of a whole text as lists of words."""
    out = []
    for part in _ENDS.split(text.lower()):
        words = _WORD.findall(part)
        out += [words[i:i + UNIT_WORDS] for i in range(0, len(words), UNIT_WORDS)]
    return out


def _hash(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass"))


#: Hashes of what stands before a word, and before its beginnings of n letters.
_WHOLE = _hash("=")
_BEGINNING = [(n, _hash(f"^{n}")) for n in PREFIXES]


def word_features(word: str) -> list[int]:
    """Buckets of ``=word`` and of ``^n`` with each of its beginnings."""
    data = word.encode("utf-8", "surrogatepass")
    found = [zlib.crc32(data, _WHOLE) % BUCKETS]
    if len(data) != len(word):
        data = None
    for n, before in _BEGINNING:
        if len(word) < n:
            break
        found.append(zlib.crc32(data[:n] if data else word[:n].encode("utf-8", "surrogatepass"), before) % BUCKETS)
    return found


def _pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Buckets of neighbouring words, from their hashes."""
    mixed = first.astype(np.uint64) * np.uint64(0x9E3779B1) + second.astype(np.uint64)
    return ((mixed ^ (mixed >> np.uint64(17))) & np.uint64(BUCKETS - 1)).astype(np.int64)


def unit_features(words: list[str]) -> np.ndarray:
    """Features of one sentence; a repeated word or pair counts once."""
    own = [b for w in dict.fromkeys(words) for b in word_features(w)]
    h = np.array([_hash(w) for w in words], np.uint64)
    return np.concatenate([np.array(own, np.int64), np.unique(_pairs(h[:-1], h[1:]))]).astype(np.int32)


def swaps(words: list[str], groups: tuple[tuple[str, ...], ...], n: int, insert: bool) -> list[tuple[list[str], list[str]]]:
    """Up to ``n`` pairs of a sentence and itself with every identity term
    swapped. If it has none and ``insert``, one is put in front first."""
    home = {term: group for group in groups for term in group}
    draw = _hash(" ".join(words))
    if not any(w in home for w in words):
        if not insert:
            return []
        group = groups[draw % len(groups)]
        words = [group[draw // 7 % len(group)], *words]
    out = []
    for i in range(n):
        def other(word: str, i: int = i) -> str:
            group = home.get(word)
            if group is None:
                return word
            if i == 0 and word != group[0]:
                return group[0]
            rest = [t for t in group if t != word]
            return rest[(draw + i) % len(rest)] if rest else word

        out.append((words, [other(w) for w in words]))
    return out


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs; 0 for an empty run."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


class Toxicity:
    """Weights by bucket, and the bias."""

    def __init__(self, bias: float, weights: np.ndarray | None = None):
        self.bias = bias
        self.weights = np.zeros(BUCKETS, np.float32) if weights is None else weights

    def logit(self, words: list[str]) -> float:
        """Of one sentence."""
        return self.bias + float(self.weights[unit_features(words)].sum(dtype=np.float64))


class Scorer:
    """Scores whole texts, and remembers what white-space separated tokens
    hold: their words, and the sentence ends between them."""

    def __init__(self, model: Toxicity):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}     # tokens
        self.words: dict[str, int] = {}
        self.held = 0                       # characters of the tokens
        self.items = array("q")             # of all tokens in turn: a word's number, or END
        self.starts = array("q")            # of each token in ``items``
        self.hash = array("Q")
        self.weight = np.zeros(0)
        self.buckets, self.sizes = array("q"), array("q")   # of the words whose weight is not summed yet

    def _number(self, word: str) -> int:
        at = self.words.get(word)
        if at is None:
            at = self.words[word] = len(self.words)
            self.hash.append(_hash(word))
            own = word_features(word)
            self.buckets.extend(own)
            self.sizes.append(len(own))
        return at

    def _learn(self, token: str) -> None:
        self.known[token] = len(self.starts)
        self.starts.append(len(self.items))
        self.held += len(token)
        token = token.lower()
        if token.isalnum():
            self.items.append(self._number(token))
        elif token[:-1].isalnum():   # a word and a mark
            self.items.append(self._number(token[:-1]))
            if token[-1] in ".!?":
                self.items.append(END)
        else:
            for i, part in enumerate(_ENDS.split(token)):
                if i:
                    self.items.append(END)
                self.items.extend([self._number(w) for w in _WORD.findall(part)])

    def _weights(self) -> np.ndarray:
        """Of all words, by number."""
        if self.sizes:
            size = np.array(self.sizes)
            sums = np.add.reduceat(self.model.weights[np.array(self.buckets)].astype(np.float64), np.cumsum(size) - size)
            self.weight = np.concatenate([self.weight, sums])
            self.buckets, self.sizes = array("q"), array("q")
        return self.weight

    def scores(self, texts: list[str]) -> np.ndarray:
        out, chunk, held = [], [], 0
        for text in texts:
            chunk.append(text)
            held += len(text)
            if held > CHUNK_CHARS:
                out.append(self._chunk(chunk))
                chunk, held = [], 0
        if chunk:
            out.append(self._chunk(chunk))
        return np.concatenate(out) if out else np.zeros(0)

    def _chunk(self, texts: list[str]) -> np.ndarray:
        if len(self.known) > KNOWN_WORDS or self.held > KNOWN_CHARS:
            self._forget()
        known = self.known
        tokens: list[int] = []
        counts = []
        for text in texts:
            own = text.replace("\n", " . ").split()   # a line's end ends a sentence, as a stop does
            own.append(".")
            try:
                tokens += [known[t] for t in own]
            except KeyError:
                for t in own:
                    if t not in known:
                        self._learn(t)
                tokens += [known[t] for t in own]
            counts.append(len(own))
        starts = np.append(np.array(self.starts), len(self.items))
        token = np.array(tokens, np.int64)
        size = starts[token + 1] - starts[token]
        ends = np.cumsum(size)
        item = np.array(self.items)[np.repeat(starts[token] - (ends - size), size) + np.arange(ends[-1])]
        is_word = item != END
        word = item[is_word]
        out = np.zeros(len(texts))
        if len(word):
            sentence = np.cumsum(~is_word)[is_word]
            begins = np.flatnonzero(np.diff(sentence, prepend=-1))
            place = np.arange(len(word)) - np.repeat(begins, np.diff(begins, append=len(word)))
            first = place % UNIT_WORDS == 0
            unit = np.cumsum(first) - 1
            at = np.cumsum(is_word)[ends[np.cumsum(counts) - 1] - 1]   # words up to each text's end
            logit = self._logits(word, unit, ~first)
            text = np.searchsorted(at, np.flatnonzero(first), side="right")
            some, begin = np.unique(text, return_index=True)
            out[some] = np.maximum.reduceat(logit, begin)
        return 1 / (1 + np.exp(-np.clip(out + self.model.bias, -50, 50)))

    def _logits(self, word: np.ndarray, unit: np.ndarray, follows: np.ndarray) -> np.ndarray:
        """Of each unit, without the bias. A repeated word or pair counts
        once; those without weight add nothing and are left out first."""
        n, weights = int(unit[-1]) + 1, self.model.weights
        weight, hashes = self._weights(), np.array(self.hash, np.uint64)
        some = np.flatnonzero(weight[word])
        once = np.unique(unit[some] * len(weight) + word[some])
        logit = np.bincount(once // len(weight), weight[once % len(weight)], n)
        right = np.flatnonzero(follows)
        bucket = _pairs(hashes[word[right - 1]], hashes[word[right]])
        some = np.flatnonzero(weights[bucket])
        pair = np.unique(unit[right[some]] * BUCKETS + bucket[some])
        return logit + np.bincount(pair // BUCKETS, weights[pair % BUCKETS], n)


def telling(counts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Buckets that tell the labels apart; ``counts`` holds, by label and
    bucket, how many of the ``n`` documents have it."""
    share = counts.sum(axis=0) / max(1, n.sum())
    spread = np.sqrt(np.maximum(1e-12, share * (1 - share)) * (1 / np.maximum(1, n)).sum())
    apart = np.abs(counts[1] / max(1, n[1]) - counts[0] / max(1, n[0])) >= LEAST_Z * spread
    return np.flatnonzero(apart & (counts.sum(axis=0) >= LEAST_DOCS) & (n.min() > 0))


def _only(used: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of buckets, reduced to (the numbers of) those in ``used``."""
    flat = np.asarray(flat, np.int64)
    at = np.full(BUCKETS, -1, np.int64)
    at[used] = np.arange(len(used))
    numbers = at[flat]
    run = np.repeat(np.arange(len(sizes)), sizes)
    return numbers[numbers >= 0], np.bincount(run[numbers >= 0], minlength=len(sizes))


def train(docs: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, weight: np.ndarray,
          pairs: list[tuple[np.ndarray, np.ndarray]], used: np.ndarray, odds: np.ndarray,
          penalty: float = PENALTY, steps: int = STEPS) -> Toxicity:
    """Fit documents (their sentences' features in a row, and the sentences'
    numbers of features) to ``label``, weighted; ``pairs`` holds the features
    of sentences and of their counterfactuals. A feature is a number of
    ``used`` buckets, whose log odds are where the weights begin."""
    share = float(np.average(label, weights=weight)) if len(label) else 0.5
    bias = float(np.log(np.clip(share, 1e-3, 1 - 1e-3) / (1 - np.clip(share, 1e-3, 1 - 1e-3))))
    if len(np.unique(label)) < 2 or not len(used):
        return Toxicity(bias)
    flat = np.concatenate([f for f, _ in docs])
    unit_size = np.concatenate([s for _, s in docs])
    unit_of = np.repeat(np.arange(len(docs)), [len(s) for _, s in docs])
    left, right = (np.concatenate([p[side] for p in pairs]) if pairs else flat[:0] for side in (0, 1))
    left_size, right_size = (np.array([len(p[side]) for p in pairs], np.int64) for side in (0, 1))
    w = 0.5 * np.clip(odds, -1.0, 6.0)
    first, second = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    unit_start = np.cumsum(unit_size) - unit_size
    starts = np.flatnonzero(np.diff(np.concatenate([[-1], unit_of])))
    filled = unit_of[starts]
    for step in range(1, steps + 1):
        logit = _sums(w[flat], unit_size)
        top = np.maximum.reduceat(logit, starts)
        is_top = np.flatnonzero(logit == np.repeat(top, np.diff(np.append(starts, len(logit)))))
        pick = is_top[np.unique(unit_of[is_top], return_index=True)[1]]
        score = np.zeros(len(docs))
        score[filled] = top
        slope = weight * (1 / (1 + np.exp(-np.clip(score + bias, -50, 50))) - label) / weight.sum()
        size = unit_size[pick]
        at = np.repeat(unit_start[pick] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        grad = np.bincount(flat[at], np.repeat(slope[unit_of[pick]], size), len(used))
        if pairs:
            pull = 2 * penalty * (_sums(w[left], left_size) - _sums(w[right], right_size)) / len(pairs)
            grad += np.bincount(left, np.repeat(pull, left_size), len(used))
            grad -= np.bincount(right, np.repeat(pull, right_size), len(used))
        grad = np.append(grad + DECAY * w, slope.sum())
        first += 0.1 * (grad - first)
        second += 0.01 * (grad * grad - second)
        move = RATE * min(1.0, 2 * (1 - step / (steps + 1))) * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
        w -= move[:-1]
        bias -= move[-1]
    weights = np.zeros(BUCKETS, np.float32)
    weights[used] = w
    return Toxicity(float(bias), weights)


def fit(docs: DataFrame, labels: DataFrame, may_learn: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", groups: tuple[tuple[str, ...], ...] = IDENTITY_TERMS, penalty: float = PENALTY,
        train_rows: int = TRAIN_ROWS) -> Toxicity:
    """Learn ``label_col`` of at most ``train_rows`` rows of each class from
    the rows of ``labels`` where ``may_learn``."""
    known = (
        labels.where(may_learn & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).cast("long").alias("__id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("__label"))
    )
    rows = docs.select(F.col(id_col).cast("long").alias("__id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text"))
    short = rows.where(F.length("__text") <= TRAIN_CHARS)
    order = [F.xxhash64("__id", F.lit("draw")), F.col("__id")]
    counts = {r[0]: r[1] for r in known.groupBy("__label").count().collect()}
    ids = [known.where(F.col("__label") == c).orderBy(*order).limit(train_rows) for c in (0, 1)]
    drawn = short.join(F.broadcast(ids[0].unionAll(ids[1])), "__id").groupBy("__id", "__label").agg(F.min("__text").alias("text"))

    drawn = written(drawn, "toxicity_sample")

    def occur(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = np.zeros((2, BUCKETS), np.int64), np.zeros(2, np.int64)
        for frame in frames:
            for label, text in zip(frame["__label"], frame["text"], strict=True):
                n[label] += 1
                own = [unit_features(u) for u in units(text)]
                if own:
                    held[label, np.unique(np.concatenate(own))] += 1
        some = np.flatnonzero(held.sum(axis=0))
        yield pd.DataFrame({"bucket": np.append(some, -1), "n0": np.append(held[0, some], n[0]), "n1": np.append(held[1, some], n[1])})

    # At most BUCKETS rows, whatever the documents.
    sums = drawn.mapInPandas(occur, "bucket int, n0 long, n1 long").groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    sums = sums.toPandas()
    held, n = np.zeros((2, BUCKETS), np.int64), sums.loc[sums["bucket"] == -1, ["n0", "n1"]].to_numpy().sum(axis=0)
    own = sums[sums["bucket"] >= 0]
    held[:, own["bucket"]] = own[["n0", "n1"]].to_numpy().T
    used = telling(held, n)
    odds = (np.log((held[1] + 0.5) / (n[1] + 1)) - np.log((held[0] + 0.5) / (n[0] + 1)))[used]
    terms = {t for group in groups for t in group}

    def describe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def runs(sentences: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
            parts = [unit_features(u) for u in sentences]
            sizes = np.array([len(f) for f in parts], np.int64)
            return _only(used, np.concatenate(parts) if parts else np.zeros(0, np.int64), sizes)

        for frame in frames:
            out = []
            for i, label, text in zip(frame["__id"], frame["__label"], frame["text"], strict=True):
                own = units(text)
                flat, sizes = runs(own)
                empty = np.flatnonzero(sizes == 0)   # one sentence without features says as much as many
                sizes = np.delete(sizes, empty[1:])
                named = [u for u in own if any(w in terms for w in u)]
                pairs = [side for u in named[:4] or own[:1] for pair in swaps(u, groups, SWAPS, not named) for side in pair]
                out.append((i, label, flat, sizes, *runs(pairs)))
            yield pd.DataFrame(out, columns=["id", "label", "features", "sizes", "pairs", "pair_sizes"])

    found = drawn.mapInPandas(
        describe, "id long, label int, features array<int>, sizes array<int>, pairs array<int>, pair_sizes array<int>"
    ).toPandas().sort_values("id", ignore_index=True)
    label = found["label"].to_numpy(np.int64)
    weight = np.array([counts.get(c, 1) * (1.0, TOXIC_COST)[c] / max(1, (label == c).sum()) for c in (0, 1)])[label]
    pairs = []
    for flat, sizes in zip(found["pairs"], found["pair_sizes"], strict=True):
        sides = np.split(np.asarray(flat, np.int64), np.cumsum(sizes)[:-1]) if len(sizes) else []
        pairs += [(a, b) for a, b in zip(sides[::2], sides[1::2], strict=True) if len(a) or len(b)]
    docs = [(np.asarray(f, np.int64), np.asarray(s, np.int64)) for f, s in zip(found["features"], found["sizes"], strict=True)]
    return train(docs, label, weight, pairs, used, odds, penalty)


def score(docs: DataFrame, model: Toxicity, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with ``score_col``: the probability that the whole text is
    toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shared.value)
        for batch in batches:
            yield pd.Series(scorer.scores(batch.tolist()))

    return docs.withColumn(score_col, apply(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
