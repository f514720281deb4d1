"""Sources and sinks round trips in fresh folders, JDBC on embedded Derby."""

import pathlib
import uuid

from pyspark.sql import functions as F

from parcelle.operators.conform import conform_columns
from parcelle.plans.clean import clean_sales, sale_points, serving_sales
from parcelle.schema import CLEAN_SCHEMA, RAW_SALES_SCHEMA
from parcelle.sinks.files import nested_as_json, write, write_csv, write_dated, write_json
from parcelle.sources.adapter import raw_sales
from parcelle.sources.files import RAW_TEXT_OPTIONS, read
from parcelle.sources.jdbc import derby_memory, read_table, string_column_types, write_table


def _same(a, b):
    return sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_json_is_compressed_unless_told(spark, tmp_dir):
    rows = spark.range(2000).selectExpr("id", "'a long column of text' AS a_long_column_name")
    write_json(rows, f"{tmp_dir}/packed")
    write_json(rows, f"{tmp_dir}/plain", options={"compression": "none"})
    size = {name: sum(f.stat().st_size for f in pathlib.Path(tmp_dir, name).glob("part-*")) for name in ("packed", "plain")}
    assert size["packed"] * 4 < size["plain"]
    assert _same(spark.read.schema(rows.schema).json(f"{tmp_dir}/packed"), rows)


def test_parquet_csv_json_text_round_trip(spark, sf_small, tmp_dir):
    clean = clean_sales(raw_sales(spark, sf_small)).cache()
    write(clean, f"{tmp_dir}/p")
    assert _same(spark.read.parquet(f"{tmp_dir}/p"), clean)
    write_json(clean, f"{tmp_dir}/j")
    assert _same(read(spark, f"{tmp_dir}/j", "json", schema=CLEAN_SCHEMA), clean)
    write_csv(clean, f"{tmp_dir}/c")
    back = read(spark, f"{tmp_dir}/c", "csv", options=RAW_TEXT_OPTIONS,
                schema=nested_as_json(clean).schema)
    assert _same(back, nested_as_json(clean))
    write(clean.select(F.col("id_mutation").alias("value")), f"{tmp_dir}/t", format="text")
    assert spark.read.text(f"{tmp_dir}/t").count() == clean.count()


def test_modes(spark, tmp_dir):
    df = spark.range(5)
    write(df, f"{tmp_dir}/m")
    write(df, f"{tmp_dir}/m", mode="append")
    write(df, f"{tmp_dir}/m", mode="ignore")
    assert spark.read.parquet(f"{tmp_dir}/m").count() == 10
    write(df, f"{tmp_dir}/m", mode="overwrite")
    assert spark.read.parquet(f"{tmp_dir}/m").count() == 5


def test_dated_partition_keeps_other_days(spark, tmp_dir):
    write(spark.range(3).withColumn("extract_date", F.lit("20000101")), f"{tmp_dir}/d",
          partition_by=["extract_date"])
    write_dated(spark.range(4), f"{tmp_dir}/d")
    back = spark.read.parquet(f"{tmp_dir}/d")
    assert back.count() == 7
    assert back.select("extract_date").distinct().count() == 2


def test_csv_scan_keeps_key_text(spark, tmp_dir):
    raw = spark.createDataFrame(
        [("2019-1", "2023-01-15", "1", "  Maison ", "1", None, None, "3", "01000", "A", "2A",
          "0.5", "1.5")], RAW_SALES_SCHEMA)
    write_csv(raw, f"{tmp_dir}/k")
    back = read(spark, f"{tmp_dir}/k", options=RAW_TEXT_OPTIONS, schema=RAW_SALES_SCHEMA).first()
    assert back["id_mutation"] == "2019-1"
    assert back["code_postal"] == "01000"
    assert back["code_departement"] == "2A"
    assert back["type_local"] == "  Maison "


def test_jdbc_round_trip_and_pushed_filter(spark, sf_small):
    target = derby_memory(f"t{uuid.uuid4().hex[:8]}")
    points = sale_points(serving_sales(clean_sales(raw_sales(spark, sf_small))))
    write_table(points, target, column_types=string_column_types(points))
    back = read_table(spark, target, partition_column="sale_price", num_partitions=3)
    assert back.count() == points.count()
    land = read_table(spark, target, where=F.col("property_type") == "terrain")
    plan = land._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "property_type" in plan
    assert land.count() == points.filter("property_type = 'terrain'").count()
    as_text = read_table(spark, target, where="property_type = 'terrain' AND rooms IS NULL")
    assert as_text.count() == land.count()
    # overwrite truncates: same row count again, table kept
    write_table(points, target, column_types=string_column_types(points))
    assert read_table(spark, target).count() == points.count()


def test_conform_then_clean_on_partial_columns(spark):
    df = spark.createDataFrame([("A", "2023-01-01", "1000", "10", "Maison", "29000")],
                               "id_mutation string, date_mutation string, valeur_fonciere string, "
                               "surface_reelle_bati string, type_local string, code_postal string")
    assert clean_sales(conform_columns(df)).count() == 1
