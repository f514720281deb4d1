"""File sources: any format by name, raw sales from landed CSV / CSV.gz with
an explicit schema, and year / department taken from landed file names."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from parcelle.operators.conform import conform_columns
from parcelle.schema import LANDED_FILE_PATTERN, RAW_SALES_SCHEMA
from parcelle.session import settings

SALE_KEY = "id_mutation"

CSV_DEFAULTS = {"header": "true"}


# Text values keep their surrounding spaces: the cleaning step trims them.
RAW_TEXT_OPTIONS = {
    "header": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "recursiveFileLookup": "true",
}


def read(spark: SparkSession, path: str, format: str = "csv", options: dict | None = None,
         schema: T.StructType | str | None = None) -> DataFrame:
    """Read any Spark-supported format from any Hadoop URI.

    CSV defaults to a header line. Options, when given, replace the defaults
    wholly. A schema, when given, disables inference (key columns such as
    postal codes and ids must not be inferred as numbers or timestamps).
    """
    opts = dict(CSV_DEFAULTS if (options is None and format == "csv") else (options or {}))
    reader = spark.read.format(format).options(**opts)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def _file_columns(path: Column) -> dict[str, Column]:
    """Landed name, department-year and version of a listed file's path."""
    named = F.regexp_extract(path, LANDED_FILE_PATTERN, 0)
    folder = F.regexp_extract(path, "/fichier=([^/]*)/[^/]*$", 1)
    fichier = F.when(named != "", named).when(folder != "", folder).otherwise(F.regexp_extract(path, "([^/]*)$", 1))
    run = F.regexp_extract(path, "^(.*/run=[^/]*)/", 1)
    place = F.regexp_replace(path, "(/fichier=[^/]*)?/[^/]*$", "")
    return {
        "fichier": fichier,
        "logical": F.regexp_replace(fichier, r"\.gz$", ""),
        "version": F.when(run != "", run).otherwise(place),
        "in_run": run != "",
    }


def current_files(spark: SparkSession, root: str) -> DataFrame:
    """Files of the current version of every landed name: ``path, length,
    modificationTime, fichier, logical``.

    A landing run replaces the names that it writes: of several runs (or
    folders) that hold a name, the one whose newest file of that name is the
    latest counts, by path where two are as new. Outside the run layout, a
    name that lies there plain and compressed is read plain. Metadata only.
    """
    files = list_files(spark, root)
    files = files.withColumns(_file_columns(F.col("path")))
    newest = files.groupBy("logical", "version").agg(F.max("modificationTime").alias("at"))
    latest = newest.groupBy("logical").agg(F.max_by("version", F.struct("at", "version")).alias("version"))
    files = files.join(latest, ["logical", "version"])
    plain = F.max(~F.col("fichier").endswith(".gz")).over(Window.partitionBy("logical"))
    files = files.withColumn("plain", plain).where("in_run or not plain or not fichier like '%.gz'")
    return files.select("path", "length", "modificationTime", "fichier", "logical")


def _same_path(path: str) -> str:
    """A path as listings and row metadata both write it."""
    return re.sub(r"^file:/+", "file:/", path)


def _first_lines(spark: SparkSession, paths: list[str], options: dict) -> dict[str, str]:
    """First line of each file that has one, by path: one job, in which a
    task reads one file and stops after its first line."""
    lenient = {k: v for k, v in options.items() if k.lower().startswith("ignore") and k.lower().endswith("files")}
    apart = spark.newSession()  # file packing is a session setting: a task per file, nothing split
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        apart.conf.set(key, str(1 << 50))
    apart.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    lines = apart.read.options(**lenient).text(paths).select(
        F.url_decode("_metadata.file_path").alias("path"), F.col("value"))
    return {_same_path(r["path"]): r["value"] for r in lines.mapInArrow(first, "path string, value string").collect()}


def _by_header(spark: SparkSession, paths: list[str], options: dict) -> dict[tuple[str, ...], list[str]]:
    """Files by header. Only first lines are read, once per folder that Spark
    wrote (its parts share a header) and once per other file; files without a
    line (or unreadable, when the options say to ignore those) are left out."""
    groups: dict[str, list[str]] = {}
    for path in sorted(paths):
        folder = path.rsplit("/", 1)[0]
        groups.setdefault(folder if "=" in folder.rsplit("/", 1)[-1] else path, []).append(path)
    firsts = _first_lines(spark, [members[0] for members in groups.values()], options) if groups else {}
    sep = options.get("sep", options.get("delimiter", ","))
    found: dict[tuple[str, ...], list[str]] = {}
    for members in groups.values():
        line = firsts.get(_same_path(members[0]))
        if line is not None:
            header = tuple(next(csv.reader([line.removeprefix("\ufeff")], delimiter=sep), ()))
            found.setdefault(header, []).extend(members)
    found.pop((), None)
    return found


REJECTED = "_rejected_line"


def _reason(line: Column, n_fields: int, sep: str) -> Column:
    """Why a line is malformed, from its text."""
    outside = F.regexp_replace(line, '"[^"]*"', "")
    fields = F.length(outside) - F.length(F.replace(outside, F.lit(sep), F.lit("")))
    return (
        F.when(outside.contains('"'), F.lit("open quote"))
        .when(fields < (n_fields - 1) * len(sep), F.lit("too few fields"))
        .when(fields > (n_fields - 1) * len(sep), F.lit("too many fields"))
        .otherwise(F.lit("malformed"))
    )


def scan_lines(spark: SparkSession, files: DataFrame, options: dict | None = None) -> DataFrame:
    """Every line of listed ``files`` (``path``) by column name, with
    ``file_path`` and, where the line is malformed, its text and the reason
    (``_rejected_line``, ``reason``; else NULL).

    A line is malformed if it does not have its file's number of fields; a
    quote that is left open before the last field swallows the fields behind
    it, so it is, too. The list of paths comes to the driver, as any file
    scan's does; columns that a file lacks are NULL, others are dropped. A
    file without the sale's key column is an error.
    """
    opts = {**RAW_TEXT_OPTIONS, **(options or {})}
    sep = opts.get("sep", opts.get("delimiter", ","))
    extra = [T.StructField(c, T.StringType()) for c in ("file_path", REJECTED, "reason")]
    out = spark.createDataFrame([], T.StructType([*RAW_SALES_SCHEMA.fields, *extra]))
    for header, paths in _by_header(spark, [r["path"] for r in files.select("path").collect()], opts).items():
        if SALE_KEY not in header:
            raise ValueError(f"no column {SALE_KEY} in {paths[0]}: {list(header)}")
        schema = T.StructType([T.StructField(name, T.StringType()) for name in (*header, REJECTED)])
        # All fields of a line are parsed, whatever columns are asked for:
        # with pruned columns the parser would not count fields.
        full = {**opts, "columnPruning": "false", "columnNameOfCorruptRecord": REJECTED}
        lines = spark.read.options(**full).schema(schema).csv(paths).withColumns({
            "file_path": F.col("_metadata.file_path"), "reason": F.when(_is_rejected(), _reason(F.col(REJECTED), len(header), sep))})
        known = conform_columns(lines, RAW_SALES_SCHEMA, keep_extra=True)
        out = out.unionByName(known.select(*RAW_SALES_SCHEMA.names, "file_path", REJECTED, "reason"))
    return out


def _is_rejected() -> Column:
    """Not a bare null test of the reject column: the scan would answer that
    from the file without parsing, and a plan may not read it alone."""
    nothing = F.substring(F.coalesce(F.col(SALE_KEY), F.lit("")), 1, 0)
    return F.concat(F.coalesce(F.col(REJECTED), F.lit("")), nothing) != ""


def scan_sales(spark: SparkSession, files: DataFrame, options: dict | None = None) -> DataFrame:
    """The well-formed sale lines of listed ``files``, with ``file_path``;
    ``rejected_lines`` has the others."""
    return scan_lines(spark, files, options).where(~_is_rejected()).drop(REJECTED, "reason")


def rejected_lines(spark: SparkSession, files: DataFrame, options: dict | None = None) -> DataFrame:
    """``departement, annee, fichier, line, reason`` of the malformed lines:
    the side channel of ``scan_sales``, which keeps the others."""
    bad = with_file_columns(scan_lines(spark, files, options).where(_is_rejected()))
    return bad.select("departement", "annee", "fichier", F.col(REJECTED).alias("line"), "reason")


#: Bytes of landed files, as stored, that a task scans when their lines are
#: aggregated; a compressed file is not split.
SCAN_BYTES = 16 << 20


@contextmanager
def small_scans(spark: SparkSession) -> Iterator[None]:
    """Within: scan tasks of what runs are packed up to ``SCAN_BYTES``. Spark
    packs compressed files by their stored size, and 128 MB of these hold some
    ten million lines; a task that aggregates them keeps nearly each line's
    sale in memory, so its memory would grow with the input up to there."""
    with settings(spark, {"spark.sql.files.maxPartitionBytes": str(SCAN_BYTES)}):
        yield


def read_sales(spark: SparkSession, path: str, options: dict | None = None,
               rebalance: int | None = None) -> DataFrame:
    """Raw sale lines from a folder of landed CSV files, plain or gzip: the
    current version of each landed name, columns found by the files' headers
    in any order. Malformed lines are left out (``rejected_lines`` has them).

    All 13 columns are text (no inference). Gzip files are not splittable,
    so each is one read task; ``rebalance`` spreads the rows over that many
    partitions when a few large .gz files would otherwise serialise the
    per-line work.
    """
    df = scan_sales(spark, current_files(spark, path), options).drop("file_path")
    return df.repartition(rebalance) if rebalance else df


def landed_file_name(path: Column | None = None) -> Column:
    """The landed object name ``dvf_{dept}_{year}.csv[.gz]`` within a path."""
    p = path if path is not None else F.col("_metadata.file_path")
    return F.regexp_extract(p, LANDED_FILE_PATTERN, 0)


def with_file_columns(df: DataFrame) -> DataFrame:
    """Add ``departement``, ``annee`` and ``fichier`` parsed from the
    ``file_path`` that each row was read from. A name that is not of a
    department-year has no department and year."""
    name = _file_columns(F.url_decode("file_path"))["fichier"]
    return df.withColumns({
        "departement": F.nullif(F.regexp_extract("file_path", LANDED_FILE_PATTERN, 1), F.lit("")),
        "annee": F.nullif(F.regexp_extract("file_path", LANDED_FILE_PATTERN, 2), F.lit("")),
        "fichier": name,
    })


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Recursive listing ``path, length, modificationTime`` of a folder.

    The binary-file source reads no file content unless ``content`` is
    selected, so this is a metadata-only scan. Spark lists no file of zero
    bytes.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root).select("path", "length", "modificationTime")
