"""Collection outputs written in one call, read back."""

from pyspark.sql import functions as F

from parcelle.functions.nested import flatten
from parcelle.plans.landing import (
    expected_grid,
    land_files,
    landing_manifest,
    missing_partitions,
    read_landed,
)
from parcelle.plans.outputs import save_landing, save_layer, save_records
from parcelle.plans.records import area_records, polygon_layer
from parcelle.sources.adapter import raw_sales


def test_records_outputs(spark, sf_small, tmp_dir):
    records = flatten(area_records(spark, sf_small).select("record.*"))
    save_records(records, tmp_dir, source="api", scope={"regions": ["EUROPE"]})
    assert spark.read.option("header", "true").csv(f"{tmp_dir}/csv").count() == 25
    assert spark.read.json(f"{tmp_dir}/json").count() == 25
    meta = spark.read.json(f"{tmp_dir}/metadata").first()
    assert meta["nombre_enregistrements"] == 25 and meta["regions"] == ["EUROPE"]
    assert meta["extract_date"] is not None


def test_layer_outputs(spark, sf_small, tmp_dir):
    layer = polygon_layer(spark, sf_small, "CODE_DEP",
                          F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
    save_layer(layer, tmp_dir, scope={"departements": ["22"]})
    assert spark.read.json(f"{tmp_dir}/geojson").filter("type = 'Feature'").count() == 25
    assert spark.read.json(f"{tmp_dir}/metadata").first()["colonnes"] == ["CODE_DEP", "NOM"]


def test_landing_outputs(spark, sf_small, tmp_dir):
    land_files(raw_sales(spark, sf_small).filter(F.col("code_departement") == "04"),
               f"{tmp_dir}/land")
    manifest = landing_manifest(spark, f"{tmp_dir}/land")
    depts = spark.createDataFrame([("04",), ("22",)], "departement string")
    missing = missing_partitions(expected_grid(depts, ["1995", "1996"]), manifest)
    save_landing(manifest, missing, read_landed(spark, f"{tmp_dir}/land"), f"{tmp_dir}/out")
    assert spark.read.json(f"{tmp_dir}/out/failed").count() == 2
    assert spark.read.json(f"{tmp_dir}/out/successful").count() == manifest.count()
