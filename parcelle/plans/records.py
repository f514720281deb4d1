"""Area records (paged JSON) and polygon layers built from the driver
tables, landed as files, and read back with the record sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelle.sinks.geojson import write_geojson
from parcelle.sources.adapter import table


def area_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per nation with nested shapes: a struct, an array and a
    struct that is NULL on odd keys."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    code = F.lpad(F.col("n_nationkey").cast("string"), 2, "0")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("_key"),
        F.struct(
            F.col("r_name").alias("reg_name"),
            code.alias("dep_code"),
            F.col("n_name").alias("dep_name"),
            F.struct(F.col("n_regionkey").alias("region_key"),
                     F.col("n_nationkey").alias("nation_key")).alias("geo"),
            F.array(code, F.col("n_regionkey").cast("string")).alias("codes"),
            F.when(F.col("n_nationkey") % 2 == 0,
                   F.struct(F.col("n_name").alias("note"))).alias("extra"),
        ).alias("record"),
    )


def records_in_region(records: DataFrame, region: str, column: str = "reg_name") -> DataFrame:
    """Records of one region: equality on a text field, membership when the
    field is an array of names."""
    field = records.schema[column].dataType
    c = F.col(f"`{column}`")
    return records.filter(F.array_contains(c, region) if isinstance(field, T.ArrayType) else c == region)


def write_pages(records: DataFrame, root: str, page_size: int, page_of: Column) -> None:
    """Land records as pages ``{total_count, results}``, one file per page.

    Records are grouped by page (a page holds at most ``page_size``
    records); the total is one count, a single number.
    """
    total = records.count()
    pages = records.groupBy(page_of.alias("page")).agg(
        F.collect_list("record").alias("results"))
    (pages.select("page", F.lit(total).cast("long").alias("total_count"), "results")
     .write.mode("overwrite").partitionBy("page").json(root))


def polygon_layer(spark: SparkSession, sf_dir: str, department_column: str,
                  code: Column) -> DataFrame:
    """One square polygon per nation, with the department code under the
    given property name. Corners sit on a 1/8 grid (exact in binary)."""
    nation = table(spark, sf_dir, "nation")
    x0 = F.lit(-5.0) + F.col("n_nationkey") * F.lit(0.125)
    y0 = F.lit(47.0) + F.col("n_regionkey") * F.lit(0.125)
    x1, y1 = x0 + F.lit(0.125), y0 + F.lit(0.125)
    ring = F.array(F.array(x0, y0), F.array(x1, y0), F.array(x1, y1), F.array(x0, y1), F.array(x0, y0))
    return nation.select(
        code.alias(department_column),
        F.col("n_name").alias("NOM"),
        F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"),
    )


def land_layer(layer: DataFrame, root: str) -> None:
    write_geojson(layer, root)
