"""Exact duplicates by deterministic block naming.

The lower-cased bytes of a text are cut into blocks of fixed size. Sorting
the blocks gives each distinct block an integer name; then adjacent names are
paired and the pairs named in the same way, until every document is down to
one name. Two documents have the same (level, name) if and only if their
texts are equal: names come from comparing and sorting the blocks themselves,
so there are no collisions to verify.

Blocks are sorted inside hash buckets, so naming is one exchange of the text.
A block that holds more than 1 / ``HOT_SHARE`` of all blocks would make one
bucket large. There are at most ``HOT_SHARE`` such blocks, whatever the size
of the input; their copies are combined per task before they are named, and
the names are joined back, where Spark splits skewed partitions.

Defined results: a NULL text equals an empty text; an empty table gives an
empty result; rows that repeat (same id, same text) are one group, of which
one row is kept; of rows with equal text the largest id stays, and a NULL id
only if there is no other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parcelle.llm.common import ascii_lower, numbered, written

BLOCK_BYTES = 4096
HOT_SHARE = 100_000
HOT_LEAST = 64
BUCKET_ROWS = 4_000


def _packed(bucket, rank):
    """One integer of a bucket and a rank in it."""
    return F.shiftleft(bucket.cast("long"), 32) + rank.cast("long")


def _buckets(rows: int) -> int:
    return max(16, rows // BUCKET_ROWS)


def _name_blocks(blocks: DataFrame, total: int) -> DataFrame:
    """Replace ``block`` by an integer ``name``, equal for equal blocks only."""
    n = _buckets(total)
    blocks = blocks.withColumn("hash", F.xxhash64("block"))
    hot = (
        blocks.groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > max(HOT_LEAST, total // HOT_SHARE)).select("hash")
    )
    bucket = F.pmod(F.col("hash"), F.lit(n)).alias("bucket")
    rank = F.dense_rank().over(Window.partitionBy("bucket").orderBy("block"))
    rest = [c for c in blocks.columns if c not in ("hash", "block")]
    cold = (
        blocks.join(F.broadcast(hot), "hash", "left_anti")
        .select("*", bucket).withColumn("name", _packed(F.col("bucket"), rank)).select(*rest, "name")
    )
    hot_blocks = blocks.join(F.broadcast(hot), "hash", "left_semi")
    hot_names = (
        hot_blocks.select(bucket, "block").distinct()
        .select("block", (-_packed(F.col("bucket"), rank) - 1).alias("name"))
    )
    return cold.unionByName(hot_blocks.join(hot_names, "block").select(*rest, "name"))


def _name_pairs(pairs: DataFrame, rows: int) -> DataFrame:
    """Replace (left, right) by ``name``; ``right`` is NULL at an odd end."""
    bucket = F.pmod(F.xxhash64("left", "right"), F.lit(_buckets(rows))).alias("bucket")
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy("left", "right"))
    names = (
        pairs.select(bucket, "left", "right").distinct()
        .select("left", "right", _packed(F.col("bucket"), rank).alias("name"))
    )
    same = pairs["left"].eqNullSafe(names["left"]) & pairs["right"].eqNullSafe(names["right"])
    return pairs.join(names, same).select("row", "pos", "name")


def name_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   block_bytes: int = BLOCK_BYTES, row_col: str | None = None) -> DataFrame:
    """One row per input row: (row, doc_id, sha256, level, name)."""
    data = ascii_lower(F.col("text")).cast("binary")
    rows = numbered(docs, id_col, text_col, row_col).select("row", "doc_id", data.alias("bytes"))
    n_blocks = F.greatest(F.ceil(F.octet_length("bytes") / block_bytes), F.lit(1)).cast("int")
    total, longest = rows.agg(F.sum(n_blocks), F.max(n_blocks)).first()
    cut = F.transform(
        F.sequence(F.lit(0), F.col("n_blocks") - 1),
        lambda i: F.expr("bytes").substr(i * block_bytes + 1, F.lit(block_bytes)),
    )
    blocks = (
        rows.withColumns({"n_blocks": n_blocks, "sha256": F.sha2("bytes", 256)})
        .select("row", "doc_id", "sha256", "n_blocks", F.posexplode(cut).alias("pos", "block"))
    )
    first = F.col("pos") == 0
    blocks = blocks.withColumns({"doc_id": F.when(first, F.col("doc_id")), "sha256": F.when(first, F.col("sha256"))})
    base = written(_name_blocks(blocks, total or 0), "block_names")
    heads = base.where(first).select("row", "doc_id", "sha256")
    done = base.where("n_blocks = 1").select("row", F.lit(0).alias("level"), "name")
    names, level, longest = base.where("n_blocks > 1").select("row", "pos", "name"), 0, longest or 1
    while longest > 1:
        level, longest = level + 1, (longest + 1) // 2
        side = F.col("pos") % 2
        pairs = names.groupBy("row", F.shiftright("pos", 1).alias("pos")).agg(
            F.max(F.when(side == 0, F.col("name"))).alias("left"),
            F.max(F.when(side == 1, F.col("name"))).alias("right"),
        )
        pairs = written(pairs, "pairs")
        named = written(_name_pairs(pairs, pairs.count()), "pair_names")
        ends = named.groupBy("row").agg(F.max("pos").alias("end"), F.max("name").alias("name"))
        done = done.unionByName(ends.where("end = 0").select("row", F.lit(level).alias("level"), "name"))
        names = named.join(ends.where("end > 0").select("row"), "row", "left_semi")
    return heads.join(done, "row")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                block_bytes: int = BLOCK_BYTES, row_col: str | None = None) -> DataFrame:
    """Groups of equal texts (after lower-casing A-Z), one row per input row:
    (row, doc_id, keep_id, group_size, kept, text_sha256)."""
    named = written(name_documents(docs, id_col, text_col, block_bytes, row_col), "document_names")
    order = F.struct(F.col("doc_id").isNotNull(), F.col("doc_id"), -F.col("row"))
    groups = named.groupBy("level", "name").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.max_by(F.struct("doc_id", "row"), order).alias("keep"),
    )
    return named.join(groups, ["level", "name"]).select(
        "row", "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"), F.col("sha256").alias("text_sha256"),
    )
