"""Near duplicates by MinHash with tensored banding.

Two small collections of ``SIDE`` keys are computed per document, each key
from ``ROWS`` minhashes. A table's key is a pair of one key of either
collection, so 2 x ``SIDE`` x ``ROWS`` minhashes serve ``SIDE`` ** 2 tables of
2 x ``ROWS`` minhashes each, instead of ``SIDE`` ** 2 x 2 x ``ROWS``. With the
defaults (8, 2: 32 minhashes, 64 tables) two sets of similarity 0.85 share no
table with probability 7e-5.

Documents with equal shingle sets are one class; only classes are hashed.
Candidates are verified on their full shingle sets. Buckets are never expanded
into all pairs: in each of ``ROUNDS`` rounds every bucket elects one member of
its largest component, the members of its other components are verified
against it, and the links found are joined into components. A large group of
near copies collapses in a round or two. Pairs are verified once; a bucket of
two is decided after the first round. For members of larger buckets that then
still hold several components an exact join finds the rest: two sets of
similarity t share one of their 1 - t rarest shingles, and the place of the
first one that they share bounds how many can follow. So every pair that
shares a table is in one component already, excluded by that bound, or
verified: no candidate is dropped.

Defined results: NULL or blank texts have no shingles and are linked with
nothing; texts with fewer words than a shingle have one, the whole sequence;
of a component one row with the smallest id is kept (the first such row where
ids repeat, a NULL id only if there is no other; the query calls every row with
that id kept); an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from parcelle.llm.common import numbered, rows_in, small_batches, written
from parcelle.llm.components import components

SIDE = 8
ROWS = 2
ROUNDS = 2
#: Bytes of texts that a worker cuts into shingles at once; it holds some 60
#: times as much meanwhile.
CHUNK_BYTES = 250_000
_BASE, _INVERSE = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    ones = np.ones(1, np.uint64)
    return tuple(np.cumprod(np.concatenate([ones, np.full(n, x, np.uint64)])) for x in (_BASE, _INVERSE))


def _shingles(data: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    flat = np.frombuffer(b" ".join([b"", *data, b""]), dtype=np.uint8)
    upper = (flat >= 65) & (flat <= 90)
    flat = np.where(upper, flat + 32, flat).astype(np.uint8)
    space = (flat == 32) | ((flat >= 9) & (flat <= 13))
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    first, last = edge[::2], edge[1::2]
    size = 1 << max(19, int(len(flat)).bit_length())
    power, inverse = _powers(size)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * power[:len(flat)])])
    word = _mix((sums[last] - sums[first]) * inverse[first] + (last - first).astype(np.uint64))
    ends = np.cumsum([len(x) + 1 for x in data])
    of = np.searchsorted(ends, first, side="left")
    bound = np.searchsorted(of, np.arange(len(data) + 1))
    factors = _mix(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)
    n = max(0, len(word) - words + 1)
    shingle = np.zeros(n, np.uint64)
    for i in range(words):
        shingle += word[i:i + n] * factors[i]
    shingle = _mix(shingle)
    out = []
    for a, b in zip(bound[:-1].tolist(), bound[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(shingle[a:b - words + 1]))
        elif b > a:
            out.append(_mix((word[a:b] * factors[:b - a]).sum(keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def shingle_sets(data: list[bytes], words: int) -> Iterator[np.ndarray]:
    """The set of each text, a bounded amount of text at a time."""
    chunk, held = [], 0
    for text in data:
        if chunk and held + len(text) > CHUNK_BYTES:
            yield from _shingles(chunk, words)
            chunk, held = [], 0
        chunk.append(text)
        held += len(text)
    if chunk:
        yield from _shingles(chunk, words)


def pieces(frames: Iterator[pd.DataFrame], column: str, most: int = 4 * CHUNK_BYTES) -> Iterator[pd.DataFrame]:
    """The frames, cut so that a piece has about ``most`` bytes of
    ``column``, or one row."""
    for frame in frames:
        ends = np.cumsum(frame[column].str.len().to_numpy())
        at = 0
        while at < len(frame):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
            yield frame.iloc[at:stop]
            at = stop


def minhashes(sets: list[np.ndarray], n: int) -> np.ndarray:
    """(set, n) minima of n hash functions; the sets must not be empty."""
    flat = np.concatenate(sets)
    begin = np.cumsum([0, *(len(s) for s in sets[:-1])])
    salts = _mix(np.arange(1000, 1000 + 2 * n, dtype=np.uint64)).reshape(n, 2)
    out = np.empty((len(sets), n), np.uint64)
    for k in range(n):
        h = (flat ^ salts[k, 0]) * (salts[k, 1] | np.uint64(1))
        h ^= h >> np.uint64(32)
        out[:, k] = np.minimum.reduceat(h, begin)
    return out


def _sketch(docs: DataFrame, words: int, side: int, rows: int) -> DataFrame:
    """(row, doc_id, n, digest, left, right, mins) of each document."""
    n_hash = 2 * side * rows

    def sketch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in pieces(frames, "text"):
            sets = list(shingle_sets([x.encode() for x in frame["text"]], words))
            some = [i for i, s in enumerate(sets) if len(s)]
            keys = np.zeros((len(sets), 2 * side), np.uint64)
            mins: list[bytes] = [b""] * len(sets)
            for at in range(0, len(some), 256):
                part = some[at:at + 256]
                low = minhashes([sets[i] for i in part], n_hash)
                parts = low.reshape(len(part), 2 * side, rows)
                key = np.zeros(parts.shape[:2], np.uint64)
                for r in range(rows):
                    key = _mix(key + parts[:, :, r])
                keys[part] = key
                small = (low >> np.uint64(32)).astype("<u4")
                for i, x in zip(part, small, strict=True):
                    mins[i] = x.tobytes()
            signed = keys.view(np.int64)
            yield pd.DataFrame({
                "row": frame["row"].to_numpy(), "doc_id": frame["doc_id"].astype("Int64").array, "n": [len(s) for s in sets],
                "digest": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
                "left": list(signed[:, :side]), "right": list(signed[:, side:]), "mins": mins,
            })

    return docs.mapInPandas(
        sketch, "row long, doc_id long, n long, digest binary, left array<long>, right array<long>, mins binary")


def _full_sets(docs: DataFrame, words: int) -> DataFrame:
    def extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in pieces(frames, "text"):
            sets = shingle_sets([x.encode() for x in frame["text"]], words)
            yield pd.DataFrame({"row": frame["row"].to_numpy(), "shingles": [s.astype("<u8").tobytes() for s in sets]})

    return docs.mapInPandas(extract, "row long, shingles binary")


@F.pandas_udf(T.LongType())
def _common(left: pd.Series, right: pd.Series) -> pd.Series:
    """Size of the intersection of two sorted sets."""
    def size(a: bytes, b: bytes) -> int:
        x, y = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
        at = np.searchsorted(x, y)
        at[at == len(x)] = 0
        return int((x[at] == y).sum()) if len(x) else 0

    return pd.Series([size(a, b) for a, b in zip(left, right, strict=True)], dtype="int64")


@F.pandas_udf(T.LongType())
def _agree(left: pd.Series, right: pd.Series) -> pd.Series:
    """How many minhashes agree."""
    return pd.Series([int((np.frombuffer(a, "<u4") == np.frombuffer(b, "<u4")).sum())
                      for a, b in zip(left, right, strict=True)], dtype="int64")


def _linked(pairs: DataFrame, members: DataFrame, sets: DataFrame, percent: int, least_agree: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar."""
    side = lambda x: members.select(F.col("row").alias(x), F.col("n").alias(f"n_{x}"), F.col("mins").alias(f"m_{x}"))
    near = (
        pairs.join(side("a"), "a").join(side("b"), "b")
        .where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
        .where(_agree("m_a", "m_b") >= least_agree).select("a", "b", "n_a", "n_b")
    )
    near = written(near, "near_pairs")
    full = lambda x: sets.select(F.col("row").alias(x), F.col("shingles").alias(f"s_{x}"))
    both = near.join(full("b"), "b").join(full("a"), "a").withColumn("common", _common("s_a", "s_b"))
    return both.where(100 * F.col("common") >= percent * (F.col("n_a") + F.col("n_b") - F.col("common"))).select("a", "b")


def _with_root(rows: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return rows.withColumn("root", F.col("row"))
    found = roots.select(F.col("node").alias("row"), "root")
    return rows.join(found, "row", "left").withColumn("root", F.coalesce("root", "row"))


def _rare_pairs(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components among ``rows`` (row, root) that
    can reach the similarity: rarest shingles first, both sets' shingles in
    one order, the first shared one is early enough in both."""
    def spread(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row, root, data in zip(frame["row"], frame["root"], frame["shingles"], strict=True):
                shingle = np.frombuffer(data, "<i8")
                yield pd.DataFrame({"row": row, "root": root, "n": len(shingle), "shingle": shingle})

    every = written(rows.join(sets, "row").mapInPandas(spread, "row long, root long, n long, shingle long"), "spread")
    shared = every.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    common = every.join(shared, "shingle")
    place = F.row_number().over(Window.partitionBy("row").orderBy("df", "shingle")) - 1
    held = F.count(F.lit(1)).over(Window.partitionBy("row"))
    # shingles that no other set holds come first
    early = common.withColumn("place", place + F.col("n") - held).where(100 * F.col("place") <= (100 - percent) * F.col("n"))
    early = written(early.select("row", "root", "n", "shingle", "place"), "early")
    side = lambda x: early.select("shingle", *[F.col(c).alias(f"{c}_{x}") for c in ("row", "root", "n", "place")])
    reach = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))  # this one and all after it
    return (
        side("a").join(side("b"), "shingle")
        .where((F.col("row_a") < F.col("row_b")) & (F.col("root_a") != F.col("root_b"))
               & ((100 + percent) * reach >= percent * (F.col("n_a") + F.col("n_b"))))
        .select(F.col("row_a").alias("a"), F.col("row_b").alias("b")).distinct()
    )


def _buckets(reps: DataFrame, side: int) -> DataFrame:
    """(row, key, n) of the tables' keys that ``n`` > 1 classes share. A table
    key pairs one key of either collection and can be shared only if both of
    these are: so the 2 x ``side`` keys of a class are filtered first, and only
    the pairs of those left are formed."""
    ones = reps.select("row", F.posexplode(F.concat("left", "right")).alias("place", "key"))
    ones = ones.select("row", "place", F.xxhash64("place", "key").alias("one"))
    often = ones.groupBy("one").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("one")
    ones = written(ones.join(often, "one", "left_semi"), "side_keys")
    collect = lambda on: F.collect_list(F.when(on, F.col("one")))
    halves = ones.groupBy("row").agg(  # at most ``side`` keys each
        collect(F.col("place") < side).alias("left"), collect(F.col("place") >= side).alias("right"))
    keys = halves.select("row", "right", F.explode("left").alias("l")).select("row", "l", F.explode("right").alias("r"))
    keys = keys.select("row", F.xxhash64("l", "r").alias("key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return written(keys.join(shared, "key").select("row", "key", "n"), "buckets")


def similar_classes(docs: DataFrame, sketches: DataFrame, words: int, percent: int, side: int, rows: int) -> DataFrame | None:
    """(node, root) of the components of similar classes, named by rows."""
    reps = sketches.where("n > 0").groupBy("digest").agg(F.min("row").alias("row")).select("row")
    buckets = _buckets(sketches.join(reps, "row", "left_semi"), side)
    met = buckets.select("row").distinct()
    members = written(sketches.select("row", "n", "mins").join(met, "row", "left_semi"), "members")
    sets = written(_full_sets(rows_in(docs, members).select("row", "text"), words), "sets")

    roots = tried = None
    n_hash = 2 * side * rows
    mean = n_hash * percent / 100
    least_agree = int(mean - 5.2 * (mean * (1 - percent / 100)) ** 0.5)  # one pair in a million is below
    for turn in range(ROUNDS + 1):
        rooted = written(_with_root(buckets, roots), "rooted")
        order = F.xxhash64("row", F.lit(turn)) if turn else F.col("row")
        per_root = rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c"), F.min_by("row", order).alias("first"))
        open_ = written(per_root.groupBy("key").agg(
            F.count(F.lit(1)).alias("roots"),
            F.max_by(F.struct("root", "first"), F.struct("c", -F.col("first"))).alias("e")).where("roots > 1"), "open_buckets")
        rooted = rooted.join(open_.select("key", "e"), "key")
        if turn == ROUNDS:
            left = written(rooted.select("row", "root").distinct(), "left")
            pairs = _rare_pairs(left, sets, percent)
        else:  # one elected member of each bucket's largest component with the members of others
            pairs = rooted.where(F.col("root") != F.col("e.root")).select(
                F.least("row", F.col("e.first")).alias("a"), F.greatest("row", F.col("e.first")).alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        tried = pairs if tried is None else tried.unionByName(pairs)
        found = written(_linked(pairs, members, sets, percent, least_agree), "links")
        stars = found if roots is None else found.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
        roots = written(components(stars), "roots")
        if turn == 0:  # the one pair of a bucket of two has been verified
            buckets = buckets.where("n > 2")
    return roots


def near_dedup(docs: DataFrame, words: int = 3, percent: int = 85, side: int = SIDE, rows: int = ROWS,
               id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """Components of documents whose sets of ``words``-word shingles have a
    Jaccard similarity of ``percent`` / 100 or more, one row per input row:
    (row, doc_id, n_shingles, component_id, kept)."""
    source = numbered(docs, id_col, text_col, row_col)
    with small_batches(docs.sparkSession):
        sketches = written(_sketch(source, words, side, rows), "sketches")
        roots = similar_classes(source, sketches, words, percent, side, rows)
    classes = sketches.where("n > 0").groupBy("digest").agg(F.min("row").alias("rep"))
    rooted = _with_root(classes.select("digest", F.col("rep").alias("row")), roots).select("digest", "root")
    rows_ = sketches.select("row", "doc_id", F.col("n").alias("n_shingles"), "digest")
    rooted = written(
        rows_.join(rooted, "digest", "left").withColumn("root", F.when(F.col("n_shingles") > 0, F.col("root")).otherwise(F.col("row"))),
        "rooted_rows")
    least = rooted.groupBy("root").agg(F.min(_order()).alias("keep"))
    return rooted.join(least, "root").select(
        "row", "doc_id", "n_shingles", F.col("keep.doc_id").alias("component_id"),
        (F.col("row") == F.col("keep.row")).alias("kept"))


def _order() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("row"))
