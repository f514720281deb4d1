"""File sinks: any format and save mode, date-stamped partitions, and CSV of
nested records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXTRACT_DATE = "extract_date"


def write(df: DataFrame, path: str, format: str = "parquet", mode: str = "overwrite",
          options: dict | None = None, partition_by: list[str] | None = None) -> None:
    """Write ``df`` to any Hadoop URI; mode is append / overwrite / ignore /
    errorifexists; options pass through to the format."""
    w = df.write.format(format).mode(mode).options(**(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def with_extract_date(df: DataFrame, column: str = EXTRACT_DATE, date: str | None = None) -> DataFrame:
    stamp = F.lit(date) if date else F.date_format(F.current_date(), "yyyyMMdd")
    return df.withColumn(column, stamp)


def write_dated(df: DataFrame, path: str, format: str = "parquet",
                options: dict | None = None, column: str = EXTRACT_DATE,
                date: str | None = None) -> None:
    """Write under a ``extract_date=yyyyMMdd`` partition of ``path``; the
    ``date`` of the extraction, or else today.

    Dynamic partition overwrite replaces only today's partition, so earlier
    extractions stay, and readers prune by date.
    """
    opts = {"partitionOverwriteMode": "dynamic"}
    opts.update(options or {})
    write(with_extract_date(df, column, date), path, format=format, mode="overwrite",
          options=opts, partition_by=[column])


def nested_as_json(df: DataFrame) -> DataFrame:
    """Arrays, structs and maps become JSON text (CSV holds only scalars)."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    return df.withColumns({
        f.name: F.to_json(F.col("`" + f.name.replace("`", "``") + "`"))
        for f in df.schema.fields if isinstance(f.dataType, nested)
    })


def write_csv(df: DataFrame, path: str, mode: str = "overwrite",
              options: dict | None = None) -> None:
    """CSV with a header; nested columns are written as JSON text."""
    opts = {"header": "true", "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false"}
    opts.update(options or {})
    write(nested_as_json(df), path, format="csv", mode=mode, options=opts)


def write_json(df: DataFrame, path: str, mode: str = "overwrite",
               options: dict | None = None) -> None:
    """JSON lines, one record per line (nested values kept as JSON), gzipped
    unless ``options`` name another ``compression``: every line repeats the
    column names."""
    write(df, path, format="json", mode=mode, options={"compression": "gzip", **(options or {})})


def write_listing(files: DataFrame, root: str, path: str, date: str | None = None) -> None:
    """The listed ``files`` (``path``) below ``root`` as text, one per line in
    path order, under a date-stamped partition."""
    lines = files.select(below(F.col("path"), root).alias("value")).sort("value")
    write_dated(lines, path, format="text", date=date)


def below(path: Column, root: str) -> Column:
    """A listed path relative to ``root``."""
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    return F.replace(plain(path), F.concat(plain(F.lit(root.rstrip("/"))), F.lit("/")), F.lit(""))


def put_bytes(spark: SparkSession, path: str, content: bytes, overwrite: bool = True) -> None:
    """One small file of a given name, through the file system that Spark
    uses for the path (a driver-side write, for lists and markers). Without
    ``overwrite`` a file that exists is an error."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).create(hadoop, overwrite)
    try:
        stream.write(bytearray(content))
    finally:
        stream.close()


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files below a path (metadata only)."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(hadoop).getLength()


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate folder that this job has written."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
