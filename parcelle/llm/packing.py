"""Packing of token sequences by non-negative least squares.

Documents may be cut. Each is cut into whole windows, one piece whose length
is a multiple of ``grid``, and a tail shorter than ``grid``:

* a whole window is a sequence by itself;
* the grid pieces have few lengths. All combinations of up to ``depth`` of
  them that fill a window exactly are enumerated; how often each is used is
  the non-negative least squares solution against the histogram of lengths,
  rounded to what the histogram holds;
* the pieces left over and the tails are packed greedily: inside buckets of
  documents they are laid end to end and cut at window ends. What remains at
  the end of a bucket is cut at powers of two, where no padding is due.

Only the histogram (one count per grid length) comes to the driver. Ranks of
pieces are row numbers inside buckets plus sums over the buckets before, so
no task holds all pieces of a length.

Defined results: a NULL text is empty and packs as its end token alone; rows
with the same or no id are packed separately; an empty table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parcelle.llm.common import in_parts, texts, written
from parcelle.llm.tokens import encode_texts

WINDOW = 4096
GRID = 128
DEPTH = 4
BUCKET_ROWS = 4_000
#: Characters of texts whose ids a worker holds at once.
PART_CHARS = 2 << 20
#: Names of sequences: kind, bucket and number in the bucket in one integer.
WHOLE, COMBINED, STREAM = 1, 2, 3


def tokenize(docs: DataFrame, tokenizer_path: str, end_id: int,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, ids, n): token ids (little-endian unsigned 32-bit) with
    ``end_id`` at the end of each document, and how many there are."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in frames:
            for part in in_parts(whole["text"], PART_CHARS):
                frame = whole.iloc[part]
                ids = [found + end for found in encode_texts(tokenizer_path, frame["text"].tolist())]
                yield pd.DataFrame({
                    "row": frame["row"], "doc_id": frame["doc_id"].astype("Int64"),
                    "ids": ids, "n": [len(x) // 4 for x in ids],
                })

    return texts(docs, id_col, text_col).mapInPandas(encode, "row long, doc_id long, ids binary, n long")


@lru_cache
def combinations(units: int, depth: int) -> list[tuple[int, ...]]:
    """All multisets of up to ``depth`` lengths under ``units`` that sum to it."""
    found: list[tuple[int, ...]] = []

    def extend(parts: tuple[int, ...], left: int, most: int) -> None:
        if left == 0:
            found.append(parts)
        elif len(parts) < depth:
            for part in range(min(most, left), 0, -1):
                extend((*parts, part), left - part, part)

    extend((), units, units - 1)
    return found


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """min |a x - b| with x >= 0, by the active-set method."""
    m, n = a.shape
    x, free = np.zeros(n), np.zeros(n, dtype=bool)
    tol = 1e-9 * max(1.0, float(np.abs(b).max(initial=0)))
    for _ in range(10 * n):
        slope = a.T @ (b - a @ x)
        slope[free] = -np.inf
        best = int(np.argmax(slope))
        if slope[best] <= tol or free.sum() >= m:
            break
        free[best] = True
        while True:
            s = np.zeros(n)
            s[free] = np.linalg.lstsq(a[:, free], b, rcond=None)[0]
            low = free & (s <= tol)
            if not low.any():
                break
            step = float(np.min(x[low] / (x[low] - s[low] + 1e-300)))
            x = x + step * (s - x)
            free &= ~(low & (x <= tol))
            x[~free] = 0
        x = s
    return x


def repeat_counts(histogram: dict[int, int], units: int, depth: int) -> list[tuple[tuple[int, ...], int]]:
    """(combination, how often) that the histogram can supply, by NNLS."""
    ways = combinations(units, depth)
    a = np.zeros((units - 1, len(ways)))
    for j, way in enumerate(ways):
        for part in way:
            a[part - 1, j] += 1
    left = np.array([histogram.get(i, 0) for i in range(1, units)], dtype=float)
    x = nnls(a, left) if left.any() else np.zeros(len(ways))
    plan = []
    for j in np.argsort(-x, kind="stable"):
        used = a[:, j] > 0
        count = int(min(round(x[j]), np.min(left[used] // a[used, j])))
        if count > 0:
            left -= count * a[:, j]
            plan.append((ways[j], count))
    return plan


def _slots(plan: list[tuple[tuple[int, ...], int]], grid: int) -> list[tuple]:
    """(units, first rank, end rank, per sequence, first sequence, first
    offset): which ranks of a length fill which place of which sequences."""
    rows, taken, sequences = [], {}, 0
    for way, count in plan:
        at = 0
        for part in dict.fromkeys(way):
            per, low = way.count(part), taken.get(part, 0)
            rows.append((part, low, low + per * count, per, sequences, at * grid))
            taken[part], at = low + per * count, at + per * part
        sequences += count
    return rows


def _sequence(kind: int, bucket, number):
    return F.lit(kind << 60) + F.shiftleft(bucket.cast("long"), 33) + number


def plan_pieces(lengths: DataFrame, window: int = WINDOW, grid: int = GRID, depth: int = DEPTH) -> DataFrame:
    """Pieces (row, start, length, sequence_id, offset) of documents given as
    (row, n): how many tokens each row has."""
    spark = lengths.sparkSession
    total = lengths.count()
    bucket = F.pmod(F.xxhash64("row"), F.lit(max(1, total // BUCKET_ROWS)))
    rest = F.col("n") % window
    docs = written(lengths.select(
        "row", "n", bucket.alias("bucket"), (F.col("n") - rest).alias("whole"),
        F.floor(rest / grid).cast("int").alias("units"), (rest % grid).alias("tail"),
    ), "lengths")

    order = Window.partitionBy("bucket").orderBy("row")
    whole = (
        docs.where("whole > 0").withColumn("before", F.sum("whole").over(order) - F.col("whole"))
        .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole") - 1, F.lit(window).cast("long"))).alias("start"))
        .select("row", "start", F.lit(window).cast("long").alias("length"),
                _sequence(WHOLE, F.col("bucket"), F.floor((F.col("before") + F.col("start")) / window)).alias("sequence_id"),
                F.lit(0).cast("long").alias("offset"))
    )

    parts = docs.where("units > 0")
    counts = parts.groupBy("bucket", "units").agg(F.count(F.lit(1)).alias("n_parts"))
    histogram = {r[0]: r[1] for r in counts.groupBy("units").agg(F.sum("n_parts")).collect()}  # a row per length
    slots = _slots(repeat_counts(histogram, window // grid, depth), grid)
    before = counts.select("bucket", "units", (
        F.sum("n_parts").over(Window.partitionBy("units").orderBy("bucket")) - F.col("n_parts")
    ).alias("first"))
    local = F.row_number().over(Window.partitionBy("bucket", "units").orderBy("row")) - 1
    ranked = (
        parts.withColumn("local", local).join(before, ["bucket", "units"])
        .withColumn("rank", F.col("first") + F.col("local"))
    )
    table = spark.createDataFrame(slots, "units int, low long, high long, per long, sequence long, at long")
    # the table's size is fixed by window, grid and depth
    placed = ranked.join(
        F.broadcast(table.withColumnRenamed("units", "units_of")),
        (F.col("units") == F.col("units_of")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")),
        "left",
    )
    placed = written(placed.select(
        "row", "bucket", F.col("whole").alias("start"), (F.col("units") * grid).cast("long").alias("length"),
        (F.lit(COMBINED << 60) + F.col("sequence") + F.floor((F.col("rank") - F.col("low")) / F.col("per"))).alias("sequence_id"),
        (F.col("at") + (F.col("rank") - F.col("low")) % F.col("per") * F.col("units") * grid).alias("offset"),
    ), "placed")
    combined = placed.where("sequence_id is not null").drop("bucket")

    tails = docs.where("tail > 0").select(
        "row", "bucket", (F.col("whole") + F.col("units") * grid).alias("start"), F.col("tail").alias("length"))
    loose = placed.where("sequence_id is null").select("row", "bucket", "start", "length").unionByName(tails)
    along = Window.partitionBy("bucket").orderBy(F.desc("length"), "row", "start")
    loose = loose.withColumns({
        "high": F.sum("length").over(along),
        "sum": F.sum("length").over(Window.partitionBy("bucket")),
    }).withColumn("low", F.col("high") - F.col("length"))
    last = F.col("sum") - F.col("sum") % window
    step = F.lit(window).cast("long")
    inner = F.sequence(F.floor(F.col("low") / window) * step, F.col("high"), step)
    ends = F.transform(
        F.sequence(F.lit(window.bit_length() - 2), F.lit(0)),
        lambda bit: last + F.expr("(sum % {0})".format(window)) - F.expr(f"sum % {window}") % F.pow(F.lit(2), bit + 1).cast("long"),
    )
    edges = F.array_sort(F.array_distinct(F.concat(inner, ends)))
    cuts = F.array_sort(F.array_distinct(F.concat(
        F.array("low", "high"), F.filter("edges", lambda e: (e > F.col("low")) & (e < F.col("high"))))))
    stream = (
        loose.withColumn("edges", edges).withColumn("cuts", cuts)
        .select("*", F.explode(F.arrays_zip(
            F.slice("cuts", 1, F.size("cuts") - 1).alias("from"), F.slice("cuts", 2, F.size("cuts") - 1).alias("to"))).alias("cut"))
        .withColumn("begin", F.array_max(F.filter("edges", lambda e: e <= F.col("cut.from"))))
        .select("row", (F.col("start") + F.col("cut.from") - F.col("low")).alias("start"),
                (F.col("cut.to") - F.col("cut.from")).alias("length"),
                _sequence(STREAM, F.col("bucket"), F.col("begin")).alias("sequence_id"),
                (F.col("cut.from") - F.col("begin")).alias("offset"))
    )
    return whole.unionByName(combined).unionByName(stream)


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 2, window: int = WINDOW, grid: int = GRID,
         depth: int = DEPTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of packed sequences: (doc_id, start, length, ids, doc_tokens,
    sequence_id, offset). ``ids`` holds the piece's token ids as little-endian
    unsigned 32-bit integers; a sequence is its pieces by ``offset``."""
    if window & (window - 1) or window % grid:
        raise ValueError("window must be a power of two and a multiple of grid")
    tokens = written(tokenize(docs, tokenizer_path, end_id, id_col, text_col), "tokens")
    pieces = plan_pieces(tokens.select("row", "n"), window, grid, depth)
    lists = pieces.groupBy("row").agg(
        F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("pieces"))  # of one document
    cut = F.transform("pieces", lambda p: F.struct(
        p["start"].alias("start"), p["length"].alias("length"), p["sequence_id"].alias("sequence_id"),
        p["offset"].alias("offset"),
        F.col("ids").substr((p["start"] * 4 + 1).cast("int"), (p["length"] * 4).cast("int")).alias("ids")))
    return tokens.join(lists, "row").select("doc_id", F.col("n").alias("doc_tokens"), F.inline(cut)).select(
        "doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
