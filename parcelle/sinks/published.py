"""Outputs that readers never see half written.

A writer writes its data aside, in a folder of its own, and then names that
folder in a commit record, a file with the next free number that is created
only if it does not exist. Readers follow the newest record. A writer that
dies before its record leaves data that nobody reads; one that finds its
number taken commits under the next one. The record is created in one step on
file systems with exclusive creation (HDFS, local); on an object store without
it two writers at a time can take one number, so let one writer publish there.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from parcelle.sinks.files import put_bytes, write

COMMITS = "_commits"
WIDTH = 12


def stage(df: DataFrame, root: str, format: str = "parquet", options: dict | None = None,
          partition_by: list[str] | None = None) -> str:
    """Write ``df`` aside; the name of its folder, for ``commit``."""
    name = f"data-{uuid.uuid4().hex}"
    write(df, f"{root}/{name}", format=format, mode="errorifexists", options=options, partition_by=partition_by)
    return name


def commit(spark: SparkSession, root: str, name: str) -> int:
    """Make a staged folder the current version; its number."""
    while True:
        number = max(versions(spark, root), default=0) + 1
        try:
            put_bytes(spark, f"{root}/{COMMITS}/{number:0{WIDTH}d}", name.encode(), overwrite=False)
            return number
        except Py4JJavaError as failure:
            if "already exists" not in str(failure.java_exception):
                raise


def publish(df: DataFrame, root: str, format: str = "parquet", options: dict | None = None,
            partition_by: list[str] | None = None) -> int:
    """Stage and commit."""
    return commit(df.sparkSession, root, stage(df, root, format, options, partition_by))


def versions(spark: SparkSession, root: str) -> dict[int, str]:
    """Committed folders by number."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{COMMITS}")
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder) or not system.listStatus(folder):
        return {}
    records = spark.read.format("binaryFile").option("pathGlobFilter", "[0-9]" * WIDTH).load(str(folder)).select("path", "content")
    return {int(r["path"].rsplit("/", 1)[1]): bytes(r["content"]).decode() for r in records.collect()}


def current(spark: SparkSession, root: str, version: int | None = None) -> str:
    """The folder of the newest version, or of ``version``."""
    found = versions(spark, root)
    number = max(found, default=None) if version is None else version
    if number not in found:
        raise FileNotFoundError(f"no committed version {'' if version is None else version} under {root}")
    return f"{root}/{found[number]}"


def read_published(spark: SparkSession, root: str, format: str = "parquet", version: int | None = None, **options: str) -> DataFrame:
    """The newest committed version, or ``version``."""
    return spark.read.format(format).options(**options).load(current(spark, root, version))
