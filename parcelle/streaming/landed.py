"""Incremental cleaning of newly landed sales files.

Collection lands ``dvf_{dept}_{year}.csv[.gz]`` files every month, and a new
version of a file replaces the one before. A file stream with the
``availableNow`` trigger sees which files are new (tracked in the stream's
checkpoint); it reads their names only. Each micro-batch recomputes the
department-years that its files belong to, each from all its current files,
and overwrites their part of the output. So the output equals the batch
result whatever the number of files per batch, the order of arrival or the
versions in between, and a batch that is replayed after a loss replaces its
own output.

A batch is cleaned in shares of whole names, and what a share has shuffled goes
when it is written: of a landing of any size, the shuffled lines of one share
are on disk at a time.

A sale belongs to one department and year. Lines whose file is of no
department-year are recomputed under that file's own name.
"""

from __future__ import annotations

from collections import defaultdict
from urllib.parse import quote

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from parcelle.plans.clean import clean_sales
from parcelle.schema import CLEAN_SCHEMA
from parcelle.session import brief_shuffles
from parcelle.sources.files import SCAN_BYTES, _file_columns, current_files, scan_sales, small_scans

MARK = "\x1f"
#: Scan tasks a core in a share of a batch, and bytes of text in a byte of a
#: compressed file, about.
TASKS_A_CORE = 4
GZIP_RATIO = 6
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def landed_stream(spark: SparkSession, root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of the paths of files landing under root."""
    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(root).select("path")


def _shares(files: list[Row], most: int) -> list[list[str]]:
    """Paths of listed files (``path, length, logical``) in shares of up to
    ``most`` bytes of text, or of one name; a name is in one share."""
    by_name: dict[str, list[Row]] = defaultdict(list)
    for f in files:
        by_name[f["logical"]].append(f)
    shares, held = [], most
    for name in sorted(by_name):
        text = sum(f["length"] * (GZIP_RATIO if f["path"].endswith(".gz") else 1) for f in by_name[name])
        if not shares or held + text > most:
            shares.append([])
            held = 0
        shares[-1] += [f["path"] for f in by_name[name]]
        held += text
    return shares


def clean_new_files(spark: SparkSession, root: str, output: str, checkpoint: str,
                    max_files_per_trigger: int | None = None, share_bytes: int | None = None) -> None:
    """Bring the output up to date with every landed file, then stop. A share
    of a batch has up to ``share_bytes`` of text (default: some scan tasks for
    each core)."""
    most = share_bytes or TASKS_A_CORE * SCAN_BYTES * spark.sparkContext.defaultParallelism

    def write_share(paths: list[str]) -> set[str]:
        """Clean these files; the names that have a clean sale."""
        lines = scan_sales(spark, spark.createDataFrame([(p,) for p in paths], "path string"))
        # The file's name travels in front of the sale's id: a sale is of one file.
        name = _file_columns(F.url_decode("file_path"))["logical"]
        lines = lines.withColumn("id_mutation", F.concat(name, F.lit(MARK), "id_mutation")).drop("file_path")
        cleaned = clean_sales(lines).withColumns({
            "fichier": F.substring_index("id_mutation", MARK, 1),
            "id_mutation": F.substring_index("id_mutation", MARK, -1),
        })
        # Few, well-sized parts per file instead of one per file and task; one
        # write, which tells the files it filled (names again).
        seen = Observation("filled")
        with small_scans(spark), brief_shuffles(spark):
            (cleaned.hint("rebalance", "fichier").observe(seen, F.collect_set("fichier").alias("names"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("fichier").parquet(output))
        return set(seen.get["names"])

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        touched = batch.select(_file_columns(F.col("path"))["logical"].alias("logical")).distinct()
        names = [r[0] for r in touched.collect()]  # of the batch's files
        listed = current_files(spark, root).where(F.col("logical").isin(names)).select("path", "length", "logical")
        filled: set[str] = set()
        for paths in _shares(listed.collect(), most):
            filled |= write_share(paths)
        for empty in sorted(set(names) - filled):  # a new version without a clean sale
            nothing = spark.createDataFrame([], CLEAN_SCHEMA)
            nothing.write.mode("overwrite").parquet(f"{output}/fichier={quote(empty, safe='')}")

    query = (landed_stream(spark, root, max_files_per_trigger).writeStream
             .foreachBatch(write_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()


def read_cleaned(spark: SparkSession, output: str) -> DataFrame:
    """The cleaned sales of all files."""
    return spark.read.parquet(output).drop("fichier")
