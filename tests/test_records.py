"""Paged JSON records, flattening, department filter cascade, layer files."""

import os

import pytest
from pyspark.sql import functions as F

from parcelle.functions.nested import flatten, parse_json_column
from parcelle.plans.areas import find_department_column, layer_file_path, region_filter
from parcelle.plans.records import area_records, polygon_layer, records_in_region, write_pages
from parcelle.sinks.geojson import write_geojson
from parcelle.sources.json_records import page_records, pages_complete, read_geojson, read_pages


def test_pages_complete_and_missing(spark, sf_small, tmp_dir):
    records = area_records(spark, sf_small)
    write_pages(records, tmp_dir, 10, F.floor(F.col("_key") / 10))
    pages = read_pages(spark, tmp_dir)
    assert page_records(pages).count() == 25
    assert pages_complete(pages).first()["complete"] is True
    # one page lost: incomplete
    partial = read_pages(spark, f"{tmp_dir}/page=0")
    r = pages_complete(partial).first()
    assert r["fetched"] == 10 and r["total_count"] == 25 and r["complete"] is False


def test_flatten_nested(spark, sf_small):
    rec = area_records(spark, sf_small).select("record.*")
    flat = flatten(rec)
    assert "geo.region_key" in flat.columns and "extra.note" in flat.columns
    assert "codes" in flat.columns  # arrays stay whole
    evens = flat.filter(F.col("`extra.note`").isNotNull()).count()
    assert evens == 13


def test_parse_json_infers_over_all_rows(spark):
    df = spark.createDataFrame([('{"a": 1}',), ('{"b": {"c": "x"}}',)], "j string")
    flat = flatten(parse_json_column(df, "j"))
    assert sorted(flat.columns) == ["j.a", "j.b.c"]


def test_department_column_detection():
    assert find_department_column(["NOM", "DEPCOM", "CODE_DEP"]) == "CODE_DEP"
    assert find_department_column(["NOM", "my_dep_code"]) == "my_dep_code"
    assert find_department_column(["NOM", "geometry"]) is None


def _layer(spark, sf_small, tmp_dir, column, code):
    write_geojson(polygon_layer(spark, sf_small, column, code), tmp_dir)
    return read_geojson(spark, tmp_dir)


def code():
    return F.lpad(F.col("n_nationkey").cast("string"), 2, "0")


@pytest.mark.parametrize("column,make,expected", [
    ("CODE_DEP", lambda: code(), 1),                             # exact match
    ("DEPCOM", lambda: F.concat(code(), F.lit("001")), 1),       # prefix fallback
    ("DEP", lambda: F.concat(F.lit("X"), code()), 25),           # nothing matches: all
    ("my_dep_code", lambda: code(), 1),                          # found by substring
    ("NAME", lambda: code(), 25),                                # no department column
])
def test_region_filter_cascade(spark, sf_small, tmp_dir, column, make, expected):
    layer = _layer(spark, sf_small, tmp_dir, column, make())
    assert region_filter(layer).count() == expected


def test_geojson_collection_layout(spark, sf_small, tmp_dir):
    layer = polygon_layer(spark, sf_small, "CODE_DEP", code())
    feats = layer.select(F.struct(F.lit("Feature").alias("type"), "geometry",
                                  F.struct("CODE_DEP", "NOM").alias("properties")).alias("f"))
    doc = feats.agg(F.collect_list("f").alias("features")).select(
        F.lit("FeatureCollection").alias("type"), "features")
    doc.write.json(f"{tmp_dir}/fc")
    back = read_geojson(spark, f"{tmp_dir}/fc", layout="collection")
    assert back.count() == 25 and "CODE_DEP" in back.columns


def test_find_layer_file(spark, tmp_dir):
    for rel in ["b/readme.txt", "a/z/IRIS.GPKG", "c/iris.shp", "c/iris.dbf"]:
        path = os.path.join(tmp_dir, rel)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write(b"x")
    assert layer_file_path(spark, tmp_dir).endswith("a/z/IRIS.GPKG")
    with pytest.raises(FileNotFoundError):
        layer_file_path(spark, tmp_dir, [".gdb"])


def test_region_equality_text_and_array(spark):
    text = spark.createDataFrame([("Bretagne",), ("Normandie",)], "reg_name string")
    assert records_in_region(text, "Bretagne").count() == 1
    arr = spark.createDataFrame([(["Bretagne", "Pays"],), (["Normandie"],)], "reg_name array<string>")
    assert records_in_region(arr, "Bretagne").count() == 1


def test_dotted_keys_deep_structs_and_malformed_text(spark):
    from parcelle.functions.nested import flatten, parse_json_column
    from parcelle.sinks.files import nested_as_json

    rows = [('{"a": {"b": {"c.d": 1, "list": [{"x": 2}]}}, "OBJECT<k": 3}',), ("{not json",), (None,)]
    flat = flatten(parse_json_column(spark.createDataFrame(rows, "j string"), "j"))
    assert sorted(flat.columns) == ["j.OBJECT<k", "j.a.b.c.d", "j.a.b.list"]
    got = [tuple(r) for r in nested_as_json(flat.select(*[f"`{c}`" for c in sorted(flat.columns)])).collect()]
    assert got[0] == (3, 1, '[{"x":2}]') and got[1:] == [(None, None, None)] * 2


def test_region_filter_raises_when_a_task_fails(spark):
    import pytest
    from pyspark.sql import functions as F

    from parcelle.plans.areas import region_filter

    layer = spark.range(3).select(F.raise_error(F.lit("broken row")).cast("string").alias("DEP"))
    with pytest.raises(Exception, match="broken row"):
        region_filter(layer, ["22"]).collect()
