"""Landed sales files: layout, manifest, missing list, summary, metadata.

Layout: one logical file per (department, year) named
``dvf_{dept}_{year}.csv`` (or ``.csv.gz``). Written by Spark, each logical
file is a folder of part files; readers recover the name from the path, so
a folder of hand-placed single files reads the same way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.schema import LANDED_FILE_PATTERN, RAW_SALES_COLUMNS
from parcelle.session import brief_shuffles
from parcelle.sinks.files import remove, stored_bytes
from parcelle.sources.files import (
    _file_columns,
    current_files,
    rejected_lines,
    scan_lines,
    scan_sales,
    with_file_columns,
)
from parcelle.sources.integrity import check_files


def _year(raw: DataFrame) -> Column:
    # First four characters of the sale date text (the landing key).
    return F.substring(F.col("date_mutation"), 1, 4)


def landed_name(raw: DataFrame, gzip: Column) -> Column:
    base = F.concat(F.lit("dvf_"), F.col("code_departement"), F.lit("_"), _year(raw), F.lit(".csv"))
    return F.when(gzip, F.concat(base, F.lit(".gz"))).otherwise(base)


#: Stored bytes for which a write is cut into one more slice, so that it
#: shuffles less at once; each slice reads its input again.
SLICE_BYTES = 64 << 20
MOST_SLICES = 4


def slices_of(stored: int) -> int:
    """How many slices an input of so many stored bytes is written in."""
    return max(1, min(MOST_SLICES, stored // SLICE_BYTES))


def _sliced(df: DataFrame, column: str, i: int, n: int) -> DataFrame:
    """Rows of the i-th of n slices of a column's values; each row is in one."""
    return df.filter(F.pmod(F.xxhash64(column), F.lit(n)) == i) if n > 1 else df


def land_files(raw: DataFrame, root: str, gzip: Column | None = None,
               stage: str | None = None, run: str = "1", stage_slices: int = 1) -> None:
    """Write raw sale lines under ``root`` as per-(department, year) files.

    ``gzip`` picks the rows whose file is compressed (default: none). The
    rows are rebalanced by file name before the write (AQE ``rebalance``):
    each file gets few, well-sized parts instead of one part per task, and
    AQE splits the partition of a department-year holding a third of all
    rows over several tasks. ``run`` names the collection run. Two passes
    (plain, gzip) keep every row; with
    ``stage`` (a folder in the shared checkpoint folder) the input is
    written there once as Parquet and both passes read it, instead of each
    recomputing the input's lineage. It is written in ``stage_slices`` slices
    of the sales: more than one suits an input whose plan filters sales by
    their id before it joins and shuffles them. A large stage is read in
    slices of the file names, and it is removed when all files are written.
    """
    spark, slices = raw.sparkSession, 1
    if stage is not None:
        for i in range(stage_slices):
            with brief_shuffles(spark):
                _sliced(raw, "id_mutation", i, stage_slices).write.mode("append" if i else "overwrite").parquet(stage)
        raw = spark.read.parquet(stage)
        slices = slices_of(stored_bytes(spark, stage))
    gz = gzip if gzip is not None else F.lit(False)
    named = raw.withColumn("fichier", landed_name(raw, gz)).hint("rebalance", "fichier")
    # Each pass of a run overwrites its own folder ``run=<run>/<pass>``:
    # re-running a failed landing replaces what that run wrote (never
    # duplicates), and files of other runs under root stay.
    opts = {"header": "true", "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false"}
    plain = named.filter(~F.coalesce(gz, F.lit(False)))
    packed = named.filter(F.coalesce(gz, F.lit(False)))
    for name, part, extra in (("plain", plain, {}), ("gz", packed, {"compression": "gzip"})):
        for i in range(slices):
            with brief_shuffles(spark):
                (_sliced(part, "fichier", i, slices).write.mode("append" if i else "overwrite").options(**opts, **extra)
                 .partitionBy("fichier").csv(f"{root.rstrip('/')}/run={run}/{name}"))
    if stage is not None:
        remove(spark, stage)


def read_landed(spark: SparkSession, root: str, options: dict | None = None, only_sound: bool = False) -> DataFrame:
    """All current landed sale lines (plain and gzip together) with
    ``departement``, ``annee`` and ``fichier`` from each row's file name.
    ``only_sound`` leaves damaged compressed files out as a whole."""
    files = sound_files(spark, root) if only_sound else current_files(spark, root)
    lines = scan_sales(spark, files, options)
    return with_file_columns(lines).select(*RAW_SALES_COLUMNS, "departement", "annee", "fichier")


def read_rejected(spark: SparkSession, root: str, options: dict | None = None, only_sound: bool = False) -> DataFrame:
    """The malformed lines that ``read_landed`` leaves out, with file, text
    and reason."""
    return rejected_lines(spark, sound_files(spark, root) if only_sound else current_files(spark, root), options)


def landing_manifest(spark: SparkSession, root: str) -> DataFrame:
    """One row per current landed file: department, year, name, size in
    bytes, format and whether it is stored decompressed. A file whose name is
    not of a department-year is listed with NULL department and year.
    Metadata-only listing (no file is read)."""
    files = current_files(spark, root)
    part = lambda i: F.nullif(F.regexp_extract("fichier", LANDED_FILE_PATTERN, i), F.lit(""))
    return files.groupBy("fichier").agg(F.sum("length").alias("taille")).select(
        part(1).alias("departement"),
        part(2).alias("annee"),
        "fichier",
        "taille",
        F.when(F.col("fichier").endswith(".gz"), F.lit("csv.gz")).otherwise(F.lit("csv")).alias("format"),
        (~F.col("fichier").endswith(".gz")).alias("decompressed"),
    )


def integrity_errors(spark: SparkSession, root: str) -> DataFrame:
    """``path, fichier, error`` of every current compressed file; the error
    is NULL where the file is sound."""
    packed = current_files(spark, root).where(F.col("fichier").endswith(".gz"))
    checked = check_files(spark, packed).withColumns(_file_columns(F.col("path")))
    return checked.select("path", "fichier", "content_bytes", "error")


def with_decompression_errors(spark: SparkSession, root: str, manifest: DataFrame) -> DataFrame:
    """The manifest with ``decompression_error``: what is wrong with a
    compressed file, NULL where nothing is. All compressed files are decoded
    and checked; of several damaged parts the first by path speaks."""
    wrong = integrity_errors(spark, root).where("error is not null").groupBy("fichier").agg(
        F.min_by("error", "path").alias("decompression_error"))
    return manifest.join(wrong, "fichier", "left")


def sound_files(spark: SparkSession, root: str) -> DataFrame:
    """``current_files`` without the compressed files that do not decode to
    their end: a scan of these reads every line or fails, never half a file."""
    wrong = integrity_errors(spark, root).where("error is not null").select("path")
    return current_files(spark, root).join(wrong, "path", "left_anti")


def expected_grid(departments: DataFrame, years: list[str],
                  column: str = "departement") -> DataFrame:
    """Every (department, year) the collection should have landed; the
    year list is a small literal, exploded per department (no join)."""
    return departments.select(
        F.col(column).alias("departement"),
        F.explode(F.array(*[F.lit(str(y)) for y in years])).alias("annee"),
    ).distinct()


def missing_partitions(expected: DataFrame, manifest: DataFrame) -> DataFrame:
    """Expected (department, year) pairs with no landed file (anti join)."""
    landed = manifest.select("departement", "annee")
    return expected.join(landed, ["departement", "annee"], "left_anti")


def manifest_summary(manifest: DataFrame, missing: DataFrame) -> DataFrame:
    """files_count, success_count, failure_count in one aggregation."""
    tagged = manifest.select(F.lit(True).alias("ok")).unionByName(
        missing.select(F.lit(False).alias("ok")))
    return tagged.agg(
        F.count_if(F.col("ok")).alias("files_count"),
        F.count_if(F.col("ok")).alias("success_count"),
        F.count_if(~F.col("ok")).alias("failure_count"),
    )


def file_records(spark: SparkSession, root: str) -> DataFrame:
    """One row per current landed file: the manifest's columns, the lines and
    content bytes that Spark decodes (header lines apart), and the error of a
    damaged compressed file, whose lines are not counted."""
    files = sound_files(spark, root)
    lines = with_file_columns(scan_lines(spark, files)).groupBy("fichier").agg(
        F.count(F.lit(1)).alias("nombre_lignes"),
        F.count("reason").alias("nombre_rejets"),
    )
    listed = with_decompression_errors(spark, root, landing_manifest(spark, root))
    return listed.join(lines, "fichier", "left").fillna(0, ["nombre_lignes", "nombre_rejets"])


FILE_RECORD = ["fichier", "departement", "annee", "taille", "format", "decompressed", "decompression_error",
               "nombre_lignes", "nombre_rejets"]


def landing_metadata(spark: SparkSession, root: str, source: str, scope: dict[str, list[str]],
                     with_time: bool = True) -> DataFrame:
    """One row that describes a landing: source, scope lists, totals, and an
    array with a record per file, sorted by name. Two levels: lines are
    counted per file, then the files (not the lines) are gathered."""
    record = F.struct(*FILE_RECORD)
    out = file_records(spark, root).agg(
        F.count(F.lit(1)).alias("nombre_fichiers"),
        F.coalesce(F.sum("taille"), F.lit(0)).alias("taille_totale"),
        F.coalesce(F.sum("nombre_lignes"), F.lit(0)).alias("nombre_lignes"),
        F.coalesce(F.sum("nombre_rejets"), F.lit(0)).alias("nombre_rejets"),
        F.count("decompression_error").alias("fichiers_endommages"),
        F.array_sort(F.collect_list(record)).alias("fichiers"),
    ).withColumn("source", F.lit(source))
    for name, values in scope.items():
        out = out.withColumn(name, F.array(*[F.lit(v) for v in values]))
    return out.withColumn("date_extraction", F.current_timestamp()) if with_time else out


def dataset_metadata(landed: DataFrame, source: str | None = None,
                     with_time: bool = True, scope: dict | None = None) -> DataFrame:
    """One-row description of a dataset: sorted lists of the departments,
    years and files present (bounded by the number of files, not rows),
    record count, column list, optional literal scope lists (e.g. regions)
    and source. Works on records without file columns too."""
    file_cols = [("departement", "departements"), ("annee", "annees"), ("fichier", "fichiers")]
    present = [(c, alias) for c, alias in file_cols if c in landed.columns]
    columns = [c for c in landed.columns if c not in {c for c, _ in file_cols}]
    per_file = landed.groupBy(*[c for c, _ in present]).agg(F.count(F.lit(1)).alias("n")) if present else landed.agg(
        F.count(F.lit(1)).alias("n"))
    out = per_file.agg(  # a row per file from here on
        *[F.array_sort(F.collect_set(c)).alias(alias) for c, alias in present],
        F.coalesce(F.sum("n"), F.lit(0)).alias("nombre_enregistrements"),
    ).withColumn("colonnes", F.array(*[F.lit(c) for c in columns]))
    for name, values in (scope or {}).items():
        out = out.withColumn(name, F.array(*[F.lit(v) for v in values]))
    if source is not None:
        out = out.withColumn("source", F.lit(source))
    if with_time:
        out = out.withColumn("date_extraction", F.current_timestamp())
    return out
