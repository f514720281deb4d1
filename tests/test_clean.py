"""The source job's unit case (6 lines in, 3 sales out) and the edge rows of
the raw sales data model."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from parcelle.functions.typing import type_sales
from parcelle.operators.conform import conform_columns
from parcelle.plans.clean import clean_sales, sale_points, serving_sales
from parcelle.schema import CLEAN_COLUMNS, RAW_SALES_COLUMNS, RAW_SALES_SCHEMA

SIX_COLUMNS = T.StructType([
    T.StructField(c, T.StringType()) for c in
    ["id_mutation", "date_mutation", "valeur_fonciere", "surface_reelle_bati", "type_local",
     "code_postal"]
])
SIX_ROWS = [
    ("M001", "2023-01-15", "200000", "80", "Appartement", "75001"),
    ("M002", "2023-02-20", "350000", "120", "Maison", "75002"),
    ("M003", "2023-03-10", "null", "90", "Appartement", "75003"),
    ("M004", "2023-04-05", "450000", "null", "Maison", "75004"),
    ("M005", "2023-05-18", "180000", "60", "  appartement  ", "75005"),
    ("M006", "2023-06-22", "1000000", "30", "Appartement", "75006"),
]


@pytest.fixture()
def six(spark):
    return spark.createDataFrame(SIX_ROWS, SIX_COLUMNS)


def test_six_lines_give_three_sales(six):
    out = clean_sales(six)
    rows = {r["id_mutation"]: r for r in out.collect()}
    assert set(rows) == {"M001", "M002", "M005"}
    assert out.columns == CLEAN_COLUMNS
    assert isinstance(out.schema["valeur_fonciere"].dataType, T.DoubleType)
    assert isinstance(out.schema["date_mutation"].dataType, T.DateType)
    assert rows["M001"]["prix_m2"] == pytest.approx(2500.0)
    assert rows["M002"]["prix_m2"] == pytest.approx(2916.6667, rel=1e-6)
    assert rows["M005"]["prix_m2"] == pytest.approx(3000.0)
    assert rows["M005"]["type_local"] == "appartement"
    assert rows["M001"]["date_mutation"] == dt.date(2023, 1, 15)


def test_conform_adds_typed_nulls(six):
    full = conform_columns(six)
    assert full.columns == RAW_SALES_COLUMNS
    assert full.schema == RAW_SALES_SCHEMA
    assert full.filter("longitude IS NOT NULL").count() == 0


def _raw(spark, rows):
    """rows: dicts of raw text values; absent keys are NULL."""
    return spark.createDataFrame(
        [tuple(r.get(c) for c in RAW_SALES_COLUMNS) for r in rows], RAW_SALES_SCHEMA)


def line(id_, price="100000", bati="50", terrain=None, type_="Maison", nature=None,
         date="2023-01-15", postal="01000", dept="2A", rooms="3", lon="-4.5", lat="48.0"):
    return {"id_mutation": id_, "date_mutation": date, "valeur_fonciere": price,
            "surface_reelle_bati": bati, "surface_terrain": terrain, "type_local": type_,
            "nature_culture": nature, "nombre_pieces_principales": rooms,
            "code_postal": postal, "nom_commune": "Quimper", "code_departement": dept,
            "longitude": lon, "latitude": lat}


def test_typing_turns_bad_text_into_null(spark):
    typed = type_sales(_raw(spark, [
        line("2019-1", price="12,5", date="15/01/2023", rooms="x"),
    ])).first()
    assert typed["valeur_fonciere"] is None
    assert typed["date_mutation"] is None
    assert typed["nombre_pieces_principales"] is None
    assert typed["id_mutation"] == "2019-1"


def test_edge_rows(spark):
    rows = [
        line("B-ZERO", bati="0"),                                 # no ratio: dropped
        line("B-BADDATE", date="15/01/2023"),                     # NULL date, kept
        line("B-LOW", price="10000", bati="100"),                 # ratio exactly 100
        line("B-HIGH", price="2000000", bati="100"),              # ratio exactly 20000
        line("B-OVER", price="2000001", bati="100"),              # just above: dropped
        line("L-LOW", price="500", bati=None, terrain="1000", type_=None, nature=" Pre "),
        line("L-HIGH", price="1000000", bati=None, terrain="1000", type_=None, nature="T"),
        line("L-NULLNAT", price="5000", bati=None, terrain="100", type_=None, nature=None),
        # two lines of one sale are summed
        line("B-TWO", price="300000", bati="60"),
        line("B-TWO", price="300000", bati="40"),
        # one sale with a building and a land line
        line("MIX", price="200000", bati="100"),
        line("MIX", price="200000", bati=None, terrain="400", type_=None, nature="sol"),
        line("MIX", price="200000", bati=None, terrain="600", type_=None, nature="sol"),
        line("MIX", price="200000", bati=None, terrain="200", type_=None, nature="bois"),
        # NULL postal twice: one group
        line("NP", price="100000", bati="30", postal=None),
        line("NP", price="100000", bati="20", postal=None),
    ]
    out = {(r["id_mutation"], r["type_local"]): r for r in clean_sales(_raw(spark, rows)).collect()}
    assert ("B-ZERO", "maison") not in out
    assert ("B-OVER", "maison") not in out
    assert out[("B-BADDATE", "maison")]["date_mutation"] is None
    assert out[("B-LOW", "maison")]["prix_m2"] == 100.0
    assert out[("B-HIGH", "maison")]["prix_m2"] == 20000.0
    assert out[("L-LOW", "terrain")]["prix_m2"] == 0.5
    assert out[("L-HIGH", "terrain")]["natures_culture"] == ["t"]
    assert out[("L-NULLNAT", "terrain")]["natures_culture"] == []
    two = out[("B-TWO", "maison")]
    assert two["surface_totale_bati"] == 100.0 and two["prix_m2"] == 3000.0
    assert two["surface_reelle_bati"] == 100.0
    mix_land = out[("MIX", "terrain")]
    assert mix_land["surface_totale_terrain"] == 1200.0
    assert mix_land["surface_terrain"] == 1200.0
    assert mix_land["natures_culture"] == ["bois", "sol", "sol"]
    assert mix_land["surface_reelle_bati"] is None
    assert mix_land["nombre_pieces_principales"] is None
    assert out[("MIX", "maison")]["nombre_pieces_principales"] == 3
    assert out[("NP", "maison")]["surface_totale_bati"] == 50.0
    low = out[("B-LOW", "maison")]
    assert low["code_postal"] == "01000" and low["code_departement"] == "2A"


def test_hot_sale_keeps_every_land_use(spark):
    # One sale with many lines: the land-use list keeps all duplicates.
    rows = [line("HOT", price="100000", bati=None, terrain="1000", type_=None,
                 nature=("a" if i % 3 else "b")) for i in range(3000)]
    r = clean_sales(_raw(spark, rows).repartition(8)).first()
    assert len(r["natures_culture"]) == 3000
    assert r["natures_culture"] == sorted(r["natures_culture"])
    assert r["surface_totale_terrain"] == 3_000_000.0


def test_serving_and_points(six):
    points = sale_points(serving_sales(clean_sales(conform_columns(six).withColumns(
        {"longitude": six["code_postal"].substr(1, 1), "latitude": six["code_postal"].substr(2, 1)}))))
    assert points.columns[:3] == ["transaction_id", "sale_date", "sale_price"]
    got = {r["transaction_id"]: r["coordinates"] for r in points.collect()}
    assert got["M001"] == "SRID=4326;POINT(7.0 5.0)"


def test_points_need_both_coordinates(six):
    served = serving_sales(clean_sales(six))
    assert sale_points(served.drop("latitude")).columns == served.drop("latitude").columns


def test_compact_land_uses(spark):
    rows = [line("HOT", price="100000", bati=None, terrain="1000", type_=None,
                 nature=("a" if i % 3 else "b")) for i in range(300)]
    r = clean_sales(_raw(spark, rows), natures_as="counts").first()
    assert [(p["value"], p["n"]) for p in r["natures_culture"]] == [("a", 200), ("b", 100)]
