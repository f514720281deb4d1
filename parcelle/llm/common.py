"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parcelle.session import scratch_path, settings

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, UPPER.lower())


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, text) of ``docs``; other columns are left behind.

    ``row`` numbers the rows (unique, also where ids repeat or are NULL). Each
    scan numbers them anew, after how it splits the files: for one scan only,
    else ``numbered``. A NULL text is an empty text.
    """
    return docs.select(F.monotonically_increasing_id().alias("row"), *_id_and_text(id_col, text_col))


def _id_and_text(id_col: str, text_col: str) -> list[Column]:
    return [F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")]


def numbered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """``texts`` with numbers that stay the same in every scan, however the
    files are split: numbered once and written. A written table that has such
    numbers already names them as ``row_col``."""
    if row_col is None:
        return written(texts(docs, id_col, text_col), "numbered")
    return docs.select(F.col(row_col).alias("row"), *_id_and_text(id_col, text_col))


#: Bits of a row's number that hold its place in its file.
ROW_BITS = 33


def by_place(docs: DataFrame) -> DataFrame:
    """``docs`` with a number ``__row`` of each row that stays the same in every
    scan: its file's number and its place in the file, so a Parquet table as it
    was read needs no copy. Rows that come from elsewhere are numbered once and
    written."""
    try:
        placed = docs.select(*docs.columns, F.col("_metadata.file_path").alias("__path"), F.col("_metadata.row_index").alias("__row"))
    except AnalysisException:
        return written(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    number = F.row_number().over(Window.orderBy("__path")).cast("long")  # a row per file, as in the driver's listing
    files = written(placed.select("__path").distinct().select("__path", number.alias("__file")), "files")
    row = F.shiftleft("__file", ROW_BITS) + F.col("__row")
    return placed.join(F.broadcast(files), "__path").select(*docs.columns, row.alias("__row"))


def written(df: DataFrame, name: str, file_rows: int = 0) -> DataFrame:
    """Write ``df`` to a table in the shared checkpoint folder and read it
    back: cuts the lineage, and survives the loss of executors. ``file_rows``
    bounds the rows of a file (0: no bound), for rows of many megabytes."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").option("maxRecordsPerFile", file_rows).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_parts(batch: pd.Series, size: int) -> Iterator[slice]:
    """Slices that cover a batch of texts in turn, each cut where it reaches
    ``size`` characters: a worker need not hold what it makes of all of them."""
    begin, held = 0, 0
    for i, text in enumerate(batch):
        held += len(text)
        if held >= size:
            yield slice(begin, i + 1)
            begin, held = i + 1, 0
    if begin < len(batch):
        yield slice(begin, len(batch))


#: Row numbers that may be broadcast (some 16 bytes each).
BROADCAST_ROWS = 4_000_000


def rows_in(docs: DataFrame, rows: DataFrame, how: str = "left_semi", row_col: str = "row") -> DataFrame:
    """The rows of ``docs`` whose ``row_col`` is in the written table ``rows``
    (``left_semi``) or not (``left_anti``). Up to ``BROADCAST_ROWS`` numbers go
    to the texts, whatever the planner estimates; beyond, a shuffle join moves
    the texts."""
    wanted = rows.select(row_col)
    few = rows.count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(wanted) if few else wanted, row_col, how)


#: A Bloom filter has at most so many bits (64 MB): enough for some 50 million
#: keys, beyond which it lets more and more rows pass.
BLOOM_BITS = 1 << 29


@contextmanager
def bloom_joins(spark: SparkSession, keys: int) -> Iterator[None]:
    """Within: Spark may drop rows of a join's large side by a Bloom filter of
    the other side's ``keys`` before they are shuffled, whatever the sizes.
    The join itself stays exact."""
    bits = str(min(BLOOM_BITS, 10 * keys + 1024))
    wanted = {
        "enabled": "true", "creationSideThreshold": "1TB", "applicationSideScanSizeThreshold": "0", "numBits": bits,
        "maxNumBits": bits, "maxNumItems": str(keys + 1), "expectedNumItems": str(keys + 1),
    }
    with settings(spark, {f"spark.sql.optimizer.runtime.bloomFilter.{k}": v for k, v in wanted.items()}):
        yield


#: Bytes of rows that Spark hands to a Python worker at once: texts or sets of
#: 10,000 rows would lie in the executor's memory several times over.
WORKER_BYTES = 2 << 20


@contextmanager
def small_batches(spark: SparkSession, size: int = WORKER_BYTES) -> Iterator[None]:
    """Within: what runs hands its Python workers batches of about ``size``
    bytes, or one row, instead of 10,000 rows."""
    with settings(spark, {"spark.sql.execution.arrow.maxBytesPerBatch": str(size)}):
        yield


def held_out(doc_id: Column, parts: int = 4, part: int = 2) -> Column:
    """crc32 of the id as text, mod ``parts``, is ``part``. A NULL id is not
    held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(False))
