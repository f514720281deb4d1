"""Language identification by a bidirectional gated recurrent network over
bytes.

The text's UTF-8 bytes are cut into segments of ``SEGMENT`` bytes. Two gated
recurrent layers read each segment, one from each end; at every byte their
states together give a probability for each language, and a document's
probabilities are the mean over all of its bytes. The network is trained here,
in numpy, by backpropagation through time on a bounded sample of labelled
documents (``TRAIN_DOCS`` windows of ``SEGMENT`` bytes per language).

Defined results: a text that is NULL, empty or without a letter is ``und``
with score 0; with no labelled rows to learn from, every text is ``und``;
rows that repeat are answered each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import in_parts

UNKNOWN = "und"
SEGMENT = 128
HIDDEN = 8
TRAIN_DOCS = 500
TRAIN_STEPS = 160
BATCH = 128
BLOCK = 2048
#: Characters of texts that a worker cuts into segments at once.
PART_CHARS = 8 * BLOCK * SEGMENT
#: Where a text counts as told apart: so far from chance to the score that 99 of
#: 100 labelled texts reach.
FLOOR = 0.1


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class ByteGru:
    """Weights by name: ``table`` (input by byte, per direction), ``back``
    (recurrent), ``out`` and ``bias`` (labels). ``floor`` is the score below
    which a text is in none of the labels' languages, for any number of them;
    ``fit`` sets it from labelled texts."""

    floor = 0.0

    def __init__(self, labels: list[str], hidden: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.labels, self.hidden = labels, hidden
        draw = lambda scale, *shape: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.weights = {
            "table": draw(0.3, 2, 256, 3 * hidden),
            "back": draw(hidden ** -0.5, 2, hidden, 3 * hidden),
            "out": draw(0.3, 2, hidden, len(labels)),
            "bias": np.zeros(len(labels), np.float32),
        }

    def _step(self, bytes_: np.ndarray, h: np.ndarray):
        """One byte for both directions: gates, candidate and new state."""
        k, table = self.hidden, self.weights["table"]
        given = np.empty((2, h.shape[1], 3 * k), np.float32)
        np.take(table[0], bytes_[0], axis=0, out=given[0])
        np.take(table[1], bytes_[1], axis=0, out=given[1])
        kept = h @ self.weights["back"]
        gates = _sigmoid(given[..., :2 * k] + kept[..., :2 * k])
        update, reset, memory = gates[..., :k], gates[..., k:], kept[..., 2 * k:]
        candidate = np.tanh(given[..., 2 * k:] + reset * memory)
        return update, reset, memory, candidate, candidate + update * (h - candidate)

    def _logits(self, segments: np.ndarray, trace: list | None = None) -> np.ndarray:
        """(position, segment, label)."""
        size, length = segments.shape
        seen = np.ascontiguousarray(segments.T)
        h = np.zeros((2, size, self.hidden), np.float32)
        logits = np.zeros((length, size, len(self.labels)), np.float32)
        for t in range(length):
            both = (seen[t], seen[length - 1 - t])
            *step, new = self._step(both, h)
            if trace is not None:
                trace.append((both, h, *step, new))
            h = new
            logits[t] += h[0] @ self.weights["out"][0]
            logits[length - 1 - t] += h[1] @ self.weights["out"][1]
        return logits + self.weights["bias"]

    def probabilities(self, segments: np.ndarray) -> np.ndarray:
        """A label's probability at every position: (position, segment, label)."""
        p = self._logits(segments)
        p -= p.max(axis=-1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=-1, keepdims=True)
        return p

    def gradients(self, segments: np.ndarray, mask: np.ndarray, label: np.ndarray) -> tuple[float, dict]:
        """Mean cross entropy over the masked positions, and its gradients by
        backpropagation through time."""
        k, w, trace = self.hidden, self.weights, []
        p = self._logits(segments, trace)
        p = np.exp(p - p.max(axis=-1, keepdims=True))
        p /= p.sum(axis=-1, keepdims=True)
        on, n = mask.T.astype(np.float32), max(1, int(mask.sum()))
        rows = np.arange(len(label))
        loss = float(-(np.log(p[:, rows, label] + 1e-9) * on).sum() / n)
        p[:, rows, label] -= 1
        p *= (on / n)[..., None]
        grads = {name: np.zeros_like(x) for name, x in w.items()}
        grads["bias"] = p.sum(axis=(0, 1))
        length, later = len(trace), np.zeros((2, len(label), k), np.float32)
        inputs = np.empty((2, length, len(label), 3 * k), np.float32)
        for t in range(length - 1, -1, -1):
            _, before, update, reset, memory, candidate, state = trace[t]
            slopes = (p[t], p[length - 1 - t])
            for d in (0, 1):
                grads["out"][d] += state[d].T @ slopes[d]
            dh = later + np.stack([slopes[d] @ w["out"][d].T for d in (0, 1)])
            d_cand = dh * (1 - update) * (1 - candidate ** 2)
            d_update = dh * (before - candidate) * update * (1 - update)
            d_reset = d_cand * memory * reset * (1 - reset)
            d_kept = np.concatenate([d_update, d_reset, d_cand * reset], axis=-1)
            inputs[:, t] = np.concatenate([d_update, d_reset, d_cand], axis=-1)
            grads["back"] += before.transpose(0, 2, 1) @ d_kept
            later = dh * update + d_kept @ w["back"].transpose(0, 2, 1)
        for d in (0, 1):
            seen = np.stack([step[0][d] for step in trace]).ravel()
            flat = inputs[d].reshape(len(seen), -1)
            for j in range(3 * k):
                grads["table"][d, :, j] = np.bincount(seen, weights=flat[:, j], minlength=256)
        return loss, grads

    def train(self, segments: np.ndarray, mask: np.ndarray, label: np.ndarray,
              steps: int = TRAIN_STEPS, batch: int = BATCH, rate: float = 0.03, seed: int = 11) -> list[float]:
        """Adam over balanced batches; the loss of each step."""
        rng, losses = np.random.default_rng(seed), []
        first = {name: np.zeros_like(x) for name, x in self.weights.items()}
        second = {name: np.zeros_like(x) for name, x in self.weights.items()}
        by_label = [np.flatnonzero(label == i) for i in range(len(self.labels))]
        each = max(1, batch // len(self.labels))
        for step in range(1, steps + 1):
            pick = np.concatenate([rng.choice(rows, each) for rows in by_label])
            loss, grads = self.gradients(segments[pick], mask[pick], label[pick])
            losses.append(loss)
            slow = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for name, g in grads.items():
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.01 * (g * g - second[name])
                self.weights[name] -= (slow * (first[name] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[name] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
        return losses


def cut(data: list[bytes], length: int = SEGMENT) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all texts, and of each segment: its text, its first byte
    and how many bytes it has. Segments never cross texts."""
    sizes = np.array([len(x) for x in data], dtype=np.int64)
    flat = np.frombuffer(b"".join(data) + bytes(length), dtype=np.uint8)
    n = -(-sizes // length)
    of = np.repeat(np.arange(len(data)), n)
    at = (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * length
    return flat, of, np.repeat(np.cumsum(sizes) - sizes, n) + at, np.minimum(length, np.repeat(sizes, n) - at)


def _segments(flat: np.ndarray, begin: np.ndarray, size: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    step = np.arange(length)
    mask = step < size[:, None]
    return np.where(mask, flat[begin[:, None] + step], 0).astype(np.uint8), mask


def document_probabilities(model: ByteGru, data: list[bytes], length: int = SEGMENT) -> np.ndarray:
    """Mean over all bytes of each text; zeros for an empty text."""
    flat, of, begin, size = cut(data, length)
    total = np.zeros((len(data), len(model.labels)))
    for at in range(0, len(of), BLOCK):
        block = slice(at, at + BLOCK)
        segments, mask = _segments(flat, begin[block], size[block], length)
        sums = np.einsum("tsl,st->sl", model.probabilities(segments), mask.astype(np.float32))
        np.add.at(total, of[block], sums)
    return total / np.maximum(1, np.array([len(x) for x in data]))[:, None]


def fit(docs: DataFrame, may_learn: Column, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", train_docs: int = TRAIN_DOCS, steps: int = TRAIN_STEPS,
        hidden: int = HIDDEN, length: int = SEGMENT) -> ByteGru | None:
    """Train on one window from each of about ``train_docs`` texts of each
    language, drawn by a hash of the id from the rows where ``may_learn``.
    At most 3 x ``train_docs`` windows per language come to the driver. None
    if there is nothing to learn from."""
    usable = docs.where(may_learn & F.col(lang_col).isNotNull() & F.col(text_col).rlike("\\p{L}"))
    counts = {r[0]: r[1] for r in usable.groupBy(lang_col).count().collect()}
    if not counts:
        return None
    labels = sorted(counts)
    share = F.lit(0.0)
    for name in labels:
        share = F.when(F.col(lang_col) == name, F.lit(2 * train_docs / counts[name])).otherwise(share)
    drawn = F.pmod(F.xxhash64(F.col(id_col), F.lit("draw")), F.lit(1_000_000)) / 1_000_000
    begin = F.pmod(F.xxhash64(F.col(id_col), F.lit("window")), F.greatest(F.lit(1), F.length(text_col) - length)) + 1
    rows = (
        usable.where(drawn < share)
        .select(F.col(lang_col).alias("lang"), F.substring(F.col(text_col), begin.cast("int"), F.lit(length)).alias("text"))
        .limit(3 * train_docs * len(labels)).collect()
    )
    rows = sorted((r["lang"], r["text"]) for r in rows)
    data = [text.encode()[:length] for _, text in rows]
    label = np.array([labels.index(lang) for lang, _ in rows], dtype=np.int64)
    missing = set(range(len(labels))) - set(label.tolist())
    labels_seen = [x for i, x in enumerate(labels) if i not in missing]
    if not labels_seen:
        return None
    label = np.array([labels_seen.index(lang) for lang, _ in rows], dtype=np.int64)
    flat, _, first, size = cut(data, length)
    segments, mask = _segments(flat, first, size, length)
    model = ByteGru(labels_seen, hidden)
    model.train(segments, mask, label, steps)
    model.floor = _floor(document_probabilities(model, data, length), label)
    return model


def _floor(p: np.ndarray, label: np.ndarray) -> float:
    """``ByteGru.floor``, from the probabilities of labelled texts."""
    chance = 1 / p.shape[1]
    right = p[p.argmax(axis=1) == label].max(axis=1)
    return chance + FLOOR * max(0.0, float(np.quantile(right, 0.01)) - chance) if len(right) else chance


def identify(docs: DataFrame, model: ByteGru | None, text_col: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with columns ``lang_pred`` and ``score`` (named after
    ``prefix``): the likeliest language of each whole text."""
    pred, score = f"{prefix}lang_pred", f"{prefix}score"
    if model is None:
        return docs.withColumns({pred: F.lit(UNKNOWN), score: F.lit(0.0)})

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = np.array(model.labels)
        for batch in batches:
            p = np.concatenate([np.zeros((0, len(names))), *(
                document_probabilities(model, [x.encode() for x in batch.iloc[part]]) for part in in_parts(batch, PART_CHARS))])
            best = p.argmax(axis=1)
            yield pd.DataFrame({"lang": names[best], "score": np.clip(p[np.arange(len(p)), best], 0, 1)})

    known = F.coalesce(F.col(text_col).rlike("\\p{L}"), F.lit(False))
    found = f"{prefix}__found"
    out = docs.withColumn(found, predict(F.coalesce(F.col(text_col), F.lit(""))))
    return out.withColumns({
        pred: F.when(known, F.col(found)["lang"]).otherwise(UNKNOWN),
        score: F.when(known, F.col(found)["score"]).otherwise(0.0),
    }).drop(found)
