"""Benchmark decontamination by SimHash over item-sized windows.

A benchmark item of n words is compared with windows of n words of the
documents. Both are multisets of five-word shingles. Two multisets of a and b
shingles with similarity t share at least t (a + b) / (1 + t), so a window is
laid at every word where at least so many of its shingles are also an item's
of that length, in whatever order they stand. Each window gets a 128-bit
SimHash. A multi-index finds all items of the window's length within
``radius`` bits: fingerprints are cut into eight blocks of 16 bits, and two
that differ in at most 31 bits differ in at most 3 in one of the blocks
(8 x 4 > 31). So an item is entered under all 697 values within 3 bits of each
of its blocks, a window looks its own eight values up, and of unrelated pairs
fewer than one in ten meet. Only items are spread out, never windows. The
pairs found are verified by their exact weighted Jaccard similarity (shared
shingles by multiplicity over all shingles by multiplicity).

At similarity 0.8 two fingerprints differ in 19 of 128 bits on average
(standard deviation 4); ``RADIUS`` is three deviations above.

All DataFrame operations. The shingle index of the benchmark is broadcast
only while it is under ``BROADCAST_ROWS`` rows (32 bytes each); a larger one
is a shuffled join. Defined results: NULL texts and texts or items of under
five words have no shingle and match nothing; a window that would reach over
the text's end is moved inside it, and a text shorter than the item is one
window; of a document's equally similar windows for an item, those with a
shingle at the item's own offset of it count first, then the first; equal
items are reported each; empty tables give an empty result.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import ascii_lower, numbered, texts, written

WORDS = 5
RADIUS = 31
BITS = 64
PRINT_WORDS = 2
BLOCK_BITS = 16
BROADCAST_ROWS = 250_000


def _hashed(rows: DataFrame, words: int) -> DataFrame:
    """``text`` replaced by ``n``, its number of words, and ``shingles``, the
    hashes of all runs of ``words`` words. (The words are bound once, as a
    lambda's argument; as a column they would be split anew for every run.)"""
    found = F.array_remove(F.split(ascii_lower(F.col("text")), "[\\x20\\x09-\\x0D]+"), "")
    runs = lambda w: F.transform(
        F.sequence(F.lit(1), F.size(w) - words + 1),
        lambda i: F.xxhash64(*[F.element_at(w, i + k) for k in range(words)]))
    both = F.transform(F.array(found), lambda w: F.struct(
        F.size(w).alias("n"),
        F.when(F.size(w) >= words, runs(w)).otherwise(F.array().cast("array<long>")).alias("shingles")))
    return rows.select(*[c for c in rows.columns if c != "text"], F.inline(both))


def simhash(shingles: str) -> Column:
    """64 majority bits over the hashes in a column."""
    ones = lambda bit: F.aggregate(
        shingles, F.lit(0).cast("long"), lambda s, h: s + F.call_function("shiftright", h, bit).bitwiseAND(F.lit(1).cast("long")))
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(BITS - 1)), F.lit(0).cast("long"),
        lambda acc, bit: acc.bitwiseOR(
            F.when(2 * ones(bit) > F.size(shingles), F.call_function("shiftleft", F.lit(1).cast("long"), bit)).otherwise(F.lit(0).cast("long"))))


def prints(shingles: str) -> Column:
    """The fingerprint: ``PRINT_WORDS`` words of 64 majority bits."""
    again = lambda i: F.transform(shingles, lambda h: F.xxhash64(h, F.lit(i)))
    return F.array(simhash(shingles), *[simhash(again(i)) for i in range(1, PRINT_WORDS)])


def distance(left: str, right: str) -> Column:
    """In how many bits two fingerprints differ."""
    return F.aggregate(F.zip_with(left, right, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda s, n: s + n)


def near_values(value: Column, radius: int) -> Column:
    """All values of a block that differ in as few bits as two fingerprints
    within ``radius`` do in one of their blocks."""
    near = radius // (PRINT_WORDS * BITS // BLOCK_BITS)
    masks = [sum(1 << bit for bit in some) for k in range(near + 1) for some in combinations(range(BLOCK_BITS), k)]
    return F.transform(F.array(*map(F.lit, masks)), lambda mask: value.bitwiseXOR(mask.cast("long")))


def blocks(fingerprint: str) -> Column:
    """(block, value) of the blocks of a fingerprint."""
    each = BITS // BLOCK_BITS
    low = F.lit((1 << BLOCK_BITS) - 1).cast("long")
    return F.array(*[
        F.struct(F.lit(i).alias("block"),
                 F.shiftrightunsigned(F.element_at(fingerprint, i // each + 1), BLOCK_BITS * (i % each)).bitwiseAND(low).alias("value"))
        for i in range(PRINT_WORDS * each)])


def _windows(spots: DataFrame, similarity: float, words: int) -> DataFrame:
    """(row, length, start, aligned): every window of ``length`` words with as
    many shared shingles as ``similarity`` needs; aligned if one of them
    stands at an item's offset of it."""
    last = F.greatest(F.lit(0), F.col("n") - F.col("length"))
    begin = F.greatest(F.lit(0), F.least(F.col("at") - F.col("offset"), last))
    both = F.least("n", "length") + F.col("length") - 2 * (words - 1)  # shingles of the window and of the item
    needed = F.greatest(F.lit(1), F.ceil(both * similarity / (1 + similarity) - 1e-9)).cast("int")
    found = spots.groupBy("row", "length", "n").agg(  # of one text
        F.array_sort(F.collect_set("at")).alias("at"), F.collect_set(begin).alias("aligned"))
    found = found.withColumn("needed", needed).where(F.size("at") >= F.col("needed"))
    at = lambda i: F.element_at("at", i)
    # windows that begin after spot i - 1, at spot i at the latest, and reach over the spot needed - 1 later
    first = lambda i: F.greatest(
        F.lit(0), at(i + F.col("needed") - 1) - (F.col("length") - words), F.when(i > 1, at(F.greatest(i - 1, F.lit(1))) + 1))
    ranges = F.transform(F.sequence(F.lit(1), F.size("at") - F.col("needed") + 1), lambda i: F.struct(
        first(i).alias("first"), F.least(at(i), last).alias("last")))
    ranges = F.filter(ranges, lambda r: r["first"] <= r["last"])
    starts = found.select("row", "length", "aligned", F.explode(ranges).alias("r")).select(
        "row", "length", "aligned", F.explode(F.sequence("r.first", "r.last")).alias("start"))
    return starts.select("row", "length", "start", F.array_contains("aligned", F.col("start")).alias("aligned"))


def candidates(windows: DataFrame, items: DataFrame, radius: int) -> DataFrame:
    """(row, start, length, item): windows and items of one length whose
    fingerprints (``print``) are within ``radius`` bits."""
    own = windows.select("row", "start", "length", "print", F.inline(blocks("print")))
    entries = items.select("item", "length", F.col("print").alias("item_print"), F.inline(blocks("print"))).select(
        "item", "length", "item_print", "block", F.explode(near_values(F.col("value"), radius)).alias("value"))
    met = own.join(entries, ["length", "block", "value"]).where(distance("print", "item_print") <= radius)
    return met.select("row", "start", "length", "item").distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, words: int = WORDS,
                 radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """(row, doc_id, item_id, start, n_words, similarity): the best window of
    each document for each item that it contains; words are counted from 0."""
    items = texts(benchmark, item_col, item_text_col).select(F.col("row").alias("item"), F.col("doc_id").alias("item_id"), "text")
    items = written(
        _hashed(items, words).where(F.size("shingles") > 0).withColumn("print", prints("shingles"))
        .withColumnRenamed("n", "length"), "items")
    index = written(
        items.select("length", F.posexplode("shingles").alias("offset", "shingle")).distinct(), "item_shingles")
    source = numbered(docs, id_col, text_col, row_col)

    spots = _hashed(source.select("row", "text"), words).select("row", "n", F.posexplode("shingles").alias("at", "shingle"))
    small = index.count() <= BROADCAST_ROWS
    spots = spots.join(F.broadcast(index) if small else index, "shingle")
    windows = written(_windows(spots, similarity, words), "windows")

    hits = source.join(windows.select("row").distinct(), "row", "left_semi")
    hits = _hashed(hits.select("row", "doc_id", "text"), words).select("row", "doc_id", "shingles")
    windows = windows.join(hits, "row").select(
        "row", "doc_id", "start", "length", "aligned",
        F.slice("shingles", F.col("start") + 1, F.col("length") - words + 1).alias("shingles"))
    windows = written(windows.withColumn("print", prints("shingles")), "prints")

    near = candidates(windows, items, radius)

    at = ["row", "start", "length"]
    inside = windows.select(*at, F.explode("shingles").alias("shingle")).groupBy(*at, "shingle").agg(F.count(F.lit(1)).alias("n_window"))
    of_item = items.select("item", F.explode("shingles").alias("shingle")).groupBy("item", "shingle").agg(F.count(F.lit(1)).alias("n_item"))
    shared = (
        near.join(of_item, "item").join(inside, [*at, "shingle"])
        .groupBy(*at, "item").agg(F.sum(F.least("n_window", "n_item")).alias("shared"))
    )
    sizes = windows.select(*at, "doc_id", "aligned", F.size("shingles").alias("n_window"))
    totals = items.select("item", "item_id", F.size("shingles").alias("n_item"))
    scored = shared.join(sizes, at).join(totals, "item").withColumn(
        "similarity", F.col("shared") / (F.col("n_window") + F.col("n_item") - F.col("shared")))
    best = scored.where(F.col("similarity") >= similarity).groupBy("row", "doc_id", "item", "item_id").agg(
        F.max_by(F.struct("start", F.col("length").alias("n_words"), "similarity"), F.struct("similarity", "aligned", -F.col("start"))).alias("best"))
    return best.select("row", "doc_id", "item_id", "best.*")
