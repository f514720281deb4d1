"""Raw sale lines derived from the TPC-H-style driver tables.

One row per line item: the order is the sale, its line items are the sale's
lines (several lines share ``id_mutation``). Every value is text, as in a
landed CSV. A few values are deliberately unusable (price text ``null`` on
line 7, no property type for return flag ``N``) so the cleaning paths are
exercised on every scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.schema import RAW_SALES_COLUMNS

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (Parquet) by name."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _text(c: Column) -> Column:
    return c.cast("string")


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sale lines (13 text columns) over the whole driver tables.

    Join order for scale: orders (4x smaller than lineitem) meets customer
    and the nation table first, then the line items join that on the order
    key, then part. Only the columns used are read (pruned at the Parquet
    scan). All joins are left to Spark's size estimate: nation is broadcast,
    the others are shuffle joins on their keys at scale, where AQE splits
    skewed key partitions.
    """
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand", "p_size")
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag"
    )

    sales = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, F.col("c_nationkey") == nation.n_nationkey)
        .select("o_orderkey", "o_totalprice", "o_orderdate", "c_custkey", "n_nationkey", "n_name")
    )
    lines = lineitem.join(sales, lineitem.l_orderkey == sales.o_orderkey).join(
        part, F.col("l_partkey") == part.p_partkey
    )

    out = lines.select(
        F.concat(F.lit("T"), _text(F.col("l_orderkey"))).alias("id_mutation"),
        _text(F.col("o_orderdate").cast("date")).alias("date_mutation"),
        F.when(F.col("l_linenumber") == 7, F.lit("null"))
        .otherwise(_text(F.col("o_totalprice")))
        .alias("valeur_fonciere"),
        F.when(F.col("l_returnflag") == "N", F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("  "), F.col("p_type"), F.lit(" ")))
        .alias("type_local"),
        _text(F.col("l_quantity") * 10).alias("surface_reelle_bati"),
        _text(F.col("l_quantity") * 100).alias("surface_terrain"),
        F.concat(F.lit(" "), F.col("p_brand"), F.lit(" ")).alias("nature_culture"),
        _text(F.col("p_size") % 6).alias("nombre_pieces_principales"),
        F.lpad(_text(F.col("c_custkey")), 5, "0").alias("code_postal"),
        F.col("n_name").alias("nom_commune"),
        F.lpad(_text(F.col("n_nationkey")), 2, "0").alias("code_departement"),
        _text(F.lit(-5.0) + (F.col("l_suppkey") % 32) * F.lit(0.125)).alias("longitude"),
        _text(F.lit(47.0) + (F.col("l_partkey") % 24) * F.lit(0.125)).alias("latitude"),
    )
    return out.select(*RAW_SALES_COLUMNS)


# Same adapter as SQL text; runs unchanged in Spark SQL and DuckDB.
RAW_SALES_SQL = """
SELECT concat('T', CAST(l_orderkey AS varchar(20))) AS id_mutation,
       CAST(CAST(o_orderdate AS date) AS varchar(10)) AS date_mutation,
       CASE WHEN l_linenumber = 7 THEN 'null' ELSE CAST(o_totalprice AS varchar(40)) END AS valeur_fonciere,
       CASE WHEN l_returnflag = 'N' THEN NULL ELSE concat('  ', p_type, ' ') END AS type_local,
       CAST(l_quantity * 10 AS varchar(40)) AS surface_reelle_bati,
       CAST(l_quantity * 100 AS varchar(40)) AS surface_terrain,
       concat(' ', p_brand, ' ') AS nature_culture,
       CAST(p_size % 6 AS varchar(10)) AS nombre_pieces_principales,
       lpad(CAST(c_custkey AS varchar(10)), 5, '0') AS code_postal,
       n_name AS nom_commune,
       lpad(CAST(n_nationkey AS varchar(10)), 2, '0') AS code_departement,
       CAST(-5e0 + (l_suppkey % 32) * 0.125e0 AS varchar(40)) AS longitude,
       CAST(47e0 + (l_partkey % 24) * 0.125e0 AS varchar(40)) AS latitude
FROM lineitem
JOIN orders   ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation   ON c_nationkey = n_nationkey
JOIN part     ON l_partkey = p_partkey
"""
