"""JSON record sources: paged API dumps and GeoJSON polygon layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_pages(spark: SparkSession, root: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Landed pages ``{total_count, results: [...]}``, one JSON document per
    file, as one row per page (files are read in parallel, one task each)."""
    reader = spark.read.option("multiLine", "true").option("recursiveFileLookup", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(root)


def page_records(pages: DataFrame) -> DataFrame:
    """Append the ``results`` of every page into one record table."""
    return pages.select(F.explode("results").alias("r")).select("r.*")


def pages_complete(pages: DataFrame) -> DataFrame:
    """Records fetched vs the announced ``total_count`` (one row)."""
    return pages.agg(
        F.sum(F.size("results")).cast("long").alias("fetched"),
        F.max("total_count").alias("total_count"),
    ).withColumn("complete", F.col("fetched") == F.col("total_count"))


def read_geojson(spark: SparkSession, path: str, layout: str = "lines",
                 schema: T.StructType | str | None = None) -> DataFrame:
    """Features as rows: ``properties`` fields as columns plus ``geometry``.

    ``lines``: one Feature per line (splittable, the scalable layout).
    ``collection``: a FeatureCollection document per file (each file is
    parsed by one task; prefer ``lines`` for large layers).
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if layout == "collection":
        feats = reader.option("multiLine", "true").json(path).select(F.explode("features").alias("f"))
        feats = feats.select("f.*")
    else:
        feats = reader.json(path)
    return feats.select("properties.*", "geometry")
