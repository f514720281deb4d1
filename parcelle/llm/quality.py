"""Quality classifier: a generalised additive model with pairwise terms.

Every text is described by a few shares and lengths. Cyclic boosting visits
one feature after another, fits a shallow tree on that feature's bins to the
current gradient and adds a small part of it to the feature's lookup table;
afterwards the pairs of features with the strongest interaction get lookup
tables over two coarser binnings in the same way. A score is the logistic of
the sum of one entry of each table.

Labels are read from a bounded sample of rows (``TRAIN_ROWS``); features use
the whole text. Defined results: NULL and empty texts have all features 0 and
are scored like any text; rows without a label are scored and not learned
from; several labels of one id count as their mean; with labels of one class
or none the score is the prior (0.5 without labels); an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAIN_ROWS = 20_000
BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS = 80
PAIR_ROUNDS = 30
RATE = 0.15

CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "space": b" \t\r\x0b\x0c",
    "line": b"\n",
    "stop": b".,;:'\"()-",
    "shout": b"!?",
    "bar": b"|",
    "symbol": b"#$%&*+/<=>@[\\]^_`{}~",
}
FEATURES = ["log_bytes", "upper", "digit", "space", "line", "stop", "shout", "bar", "symbol", "word_length", "repeated"]


def features(data: list[bytes]) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    flat = np.frombuffer(b"\n".join([*data, b""]), dtype=np.uint8)
    sizes = np.array([len(x) for x in data], dtype=np.int64)
    begin = np.cumsum(sizes + 1) - sizes - 1
    code = np.zeros(256, np.uint8)
    for i, chars in enumerate(CLASSES.values(), 1):
        code[np.frombuffer(chars, np.uint8)] = i
    kind = code[flat]
    counts = {}
    for i, name in enumerate(CLASSES, 1):
        counts[name] = np.add.reduceat((kind == i).view(np.uint8), begin, dtype=np.int64) if len(begin) else np.zeros(0)
    counts["line"] = counts["line"] - 1  # the separator of the texts
    gap = (kind == 4) | (kind == 5)
    edge = np.flatnonzero(np.diff(np.concatenate([[True], gap])))
    first, last = edge[::2], edge[1::2]
    words = np.bincount(np.searchsorted(begin, first, side="right") - 1, minlength=len(data))
    n = np.maximum(1, sizes)
    letters = np.maximum(1, counts["upper"] + counts["lower"])
    out = [np.log1p(sizes), counts["upper"] / letters]
    out += [counts[name] / n for name in ("digit", "space", "line", "stop", "shout", "bar", "symbol")]
    out.append((sizes - counts["space"] - counts["line"]) / np.maximum(1, words))
    out.append(_repeated(flat, first, last, np.searchsorted(begin, first, side="right") - 1, words))
    return np.column_stack(out) if len(data) else np.zeros((0, len(FEATURES)))


def _repeated(flat: np.ndarray, first: np.ndarray, last: np.ndarray, of: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Share of a text's words that are longer than seven bytes and occur in
    it before: high where lines or passages repeat."""
    long = last - first > 7
    first, last, of = first[long], last[long], of[long]
    powers = np.cumprod(np.full(7, 1_000_003, np.uint64))
    key = np.zeros(len(first), np.uint64)
    for i in range(7):  # its first and its last bytes tell a long word well enough for a share
        key += flat[first + i] * powers[i] + flat[last - 1 - i] * powers[-1 - i] * np.uint64(31)
    order = np.lexsort((key, of))
    same = (of[order][1:] == of[order][:-1]) & (key[order][1:] == key[order][:-1])
    return np.bincount(of[order][1:][same], minlength=len(words)) / np.maximum(1, words)


def _edges(values: np.ndarray) -> np.ndarray:
    """Quantiles of all values and of the positive ones; 0 is a bin alone."""
    at = np.linspace(0, 1, BINS // 2 + 1)[1:-1]
    parts = [np.quantile(v, at) for v in (values, values[values > 0]) if len(v)]
    edges = np.unique(np.concatenate([[1e-12], *parts]))
    return edges[edges > 0]


class Additive:
    """Edges of the bins, lookup tables by feature and by pair, prior."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        rate = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
        self.prior = float(np.log(rate / (1 - rate)))
        self.edges = [_edges(x[:, j]) for j in range(len(FEATURES))]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.coarse = [np.unique(e[:: max(1, -(-len(e) // (PAIR_BINS - 1)))]) for e in self.edges]
        self.pairs: dict[tuple[int, int], np.ndarray] = {}
        if len(np.unique(y)) == 2:
            self._fit(x, y)

    def _fit(self, x: np.ndarray, y: np.ndarray) -> None:
        bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)]
        f = np.full(len(y), self.prior)
        for _ in range(ROUNDS):
            for j, table in enumerate(self.tables):
                p = 1 / (1 + np.exp(-f))
                step = RATE * _tree(np.bincount(bins[j], y - p, len(table)), np.bincount(bins[j], p * (1 - p), len(table)), 3)
                table += step
                f += step[bins[j]]
        bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.coarse)]
        width = [len(e) + 1 for e in self.coarse]
        cells = {(a, b): bins[a] * width[b] + bins[b] for a, b in combinations(range(len(FEATURES)), 2)}
        p = 1 / (1 + np.exp(-f))
        gain = {}
        for (a, b), cell in cells.items():
            g = np.bincount(cell, y - p, width[a] * width[b])
            h = np.bincount(cell, p * (1 - p), width[a] * width[b])
            gain[a, b] = float((g * g / (h + 1)).sum())
        for pair in sorted(gain, key=lambda k: -gain[k])[:PAIRS]:
            self.pairs[pair] = np.zeros(width[pair[0]] * width[pair[1]])
        for _ in range(PAIR_ROUNDS):
            for (a, b), table in self.pairs.items():
                cell, p = cells[a, b], 1 / (1 + np.exp(-f))
                g = np.bincount(cell, y - p, len(table)).reshape(width[a], width[b])
                h = np.bincount(cell, p * (1 - p), len(table)).reshape(width[a], width[b])
                step = RATE * _quadrants(g, h).ravel()
                table += step
                f += step[cell]

    def score(self, x: np.ndarray) -> np.ndarray:
        f = np.full(len(x), self.prior)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            f += table[np.searchsorted(edges, x[:, j], side="right")]
        for (a, b), table in self.pairs.items():
            wide = len(self.coarse[b]) + 1
            f += table[np.searchsorted(self.coarse[a], x[:, a], side="right") * wide
                       + np.searchsorted(self.coarse[b], x[:, b], side="right")]
        return 1 / (1 + np.exp(-f))


def _tree(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """Values per bin of a tree with up to ``leaves`` leaves over the bins."""
    parts = [(0, len(g))]
    worth = lambda a, b: g[a:b].sum() ** 2 / (h[a:b].sum() + 1)
    for _ in range(leaves - 1):
        best = max(((worth(a, m) + worth(m, b) - worth(a, b), i, m) for i, (a, b) in enumerate(parts)
                    for m in range(a + 1, b)), default=(0, 0, 0))
        if best[0] <= 1e-9:
            break
        a, b = parts.pop(best[1])
        parts += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + 1)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values per cell of the best cut of a plane into four quadrants."""
    best, out = 0.0, np.zeros_like(g)
    for i in range(1, g.shape[0]):
        for j in range(1, g.shape[1]):
            cuts = [(slice(0, i), slice(0, j)), (slice(0, i), slice(j, None)),
                    (slice(i, None), slice(0, j)), (slice(i, None), slice(j, None))]
            sums = [(g[c].sum(), h[c].sum()) for c in cuts]
            worth = sum(a * a / (b + 1) for a, b in sums)
            if worth > best:
                best, out = worth, np.zeros_like(g)
                for c, (a, b) in zip(cuts, sums, strict=True):
                    out[c] = a / (b + 1)
    return out


def fit(docs: DataFrame, labels: DataFrame, may_learn: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", train_rows: int = TRAIN_ROWS) -> Additive:
    """Learn ``label_col`` of at most ``train_rows`` rows, drawn by a hash of
    the id from the rows of ``labels`` where ``may_learn``."""
    known = labels.where(may_learn & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    drawn = F.pmod(F.xxhash64(F.col(id_col), F.lit("draw")), F.lit(1_000_000)) / 1_000_000
    share = 0.9 * train_rows / max(1, known.count())
    picked = (
        known.where(drawn < share).groupBy(F.col(id_col).alias("__id")).agg(F.avg(label_col).alias("__label"))
        .limit(train_rows)
    )
    rows = docs.join(F.broadcast(picked), F.col(id_col) == F.col("__id")).select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col("__label").alias("label"))

    def describe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            x = pd.DataFrame(features([t.encode() for t in frame["text"]]), columns=FEATURES)
            yield x.assign(id=frame["id"].to_numpy(), label=frame["label"].to_numpy())

    schema = ", ".join(f"{name} double" for name in FEATURES) + ", id long, label double"
    found = rows.mapInPandas(describe, schema).limit(2 * train_rows).toPandas().sort_values(["id", *FEATURES])
    return Additive(found[FEATURES].to_numpy(), (found["label"] >= 0.5).to_numpy().astype(float))


def score(docs: DataFrame, model: Additive, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with ``score_col``: the probability of label 1."""

    @F.pandas_udf("double")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(model.score(features([x.encode() for x in batch])))

    return docs.withColumn(score_col, apply(F.coalesce(F.col(text_col), F.lit(""))))
