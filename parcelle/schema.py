"""Schemas and fixed values of the property-sale data model.

Everything in this module is data, not logic: column lists, bounds and
scope constants that results depend on.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must stay equal to the source job's for identical results)
# ---------------------------------------------------------------------------

# Raw sale columns, all read as text so keys such as postal code "01000",
# department "2A" or id "2019-1" survive untouched.
RAW_SALES_COLUMNS = [
    "id_mutation",
    "date_mutation",
    "valeur_fonciere",
    "type_local",
    "surface_reelle_bati",
    "surface_terrain",
    "nature_culture",
    "nombre_pieces_principales",
    "code_postal",
    "nom_commune",
    "code_departement",
    "longitude",
    "latitude",
]

DATE_FORMAT = "yyyy-MM-dd"

# Price per square metre bounds, inclusive.
BUILDING_PRICE_M2_BOUNDS = (100.0, 20000.0)
LAND_PRICE_M2_BOUNDS = (0.5, 1000.0)

# Grouping keys of the per-sale aggregations.
BUILDING_KEYS = [
    "id_mutation",
    "date_mutation",
    "valeur_fonciere",
    "code_postal",
    "nom_commune",
    "code_departement",
    "type_local",
    "nombre_pieces_principales",
]
LAND_KEYS = [
    "id_mutation",
    "date_mutation",
    "valeur_fonciere",
    "code_postal",
    "nom_commune",
    "code_departement",
]

LAND_TYPE_LABEL = "terrain"

# Cleansed table, canonical column order.
CLEAN_COLUMNS = [
    "id_mutation",
    "date_mutation",
    "valeur_fonciere",
    "prix_m2",
    "type_local",
    "surface_reelle_bati",
    "surface_terrain",
    "nombre_pieces_principales",
    "code_postal",
    "nom_commune",
    "code_departement",
    "longitude",
    "latitude",
    "surface_totale_bati",
    "surface_totale_terrain",
    "natures_culture",
]

# Serving table `transactions`: (source column, serving name).
SERVING_COLUMNS = [
    ("id_mutation", "transaction_id"),
    ("date_mutation", "sale_date"),
    ("valeur_fonciere", "sale_price"),
    ("prix_m2", "price_per_sqm"),
    ("type_local", "property_type"),
    ("surface_reelle_bati", "living_area"),
    ("surface_terrain", "land_area"),
    ("nombre_pieces_principales", "rooms"),
    ("code_postal", "postal_code"),
    ("nom_commune", "city_name"),
    ("code_departement", "department"),
    ("longitude", "longitude"),
    ("latitude", "latitude"),
]
SERVING_TABLE = "transactions"
POINT_SRID = 4326

# Collection scope of the sales files and area polygons.
SCOPE_DEPARTMENTS = ["22", "29", "35", "56"]

# Landed object names: dvf_{department}_{year}.csv, optionally .gz.
LANDED_FILE_PATTERN = r"dvf_([0-9A-Za-z]+)_([0-9]{4})\.csv(\.gz)?"

# Department column candidates of a polygon layer, in priority order; the
# fallback is the first column whose upper-cased name contains "DEP".
DEPARTMENT_COLUMN_CANDIDATES = ["INSEE_DEP", "CODE_DEP", "DEP", "DEPARTEMENT", "DEPCOM"]
DEPARTMENT_COLUMN_HINT = "DEP"

# Layer files accepted in an extracted archive tree (case-insensitive).
LAYER_SUFFIXES = [".gpkg", ".shp"]

# ---------------------------------------------------------------------------
# Spark types
# ---------------------------------------------------------------------------

RAW_SALES_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in RAW_SALES_COLUMNS]
)

# Typed columns after conversion; columns not listed stay text.
TYPED_COLUMNS = {
    "valeur_fonciere": T.DoubleType(),
    "surface_reelle_bati": T.DoubleType(),
    "longitude": T.DoubleType(),
    "latitude": T.DoubleType(),
    "surface_terrain": T.DoubleType(),
    "nombre_pieces_principales": T.IntegerType(),
}

CLEAN_SCHEMA = T.StructType(
    [
        T.StructField("id_mutation", T.StringType()),
        T.StructField("date_mutation", T.DateType()),
        T.StructField("valeur_fonciere", T.DoubleType()),
        T.StructField("prix_m2", T.DoubleType()),
        T.StructField("type_local", T.StringType()),
        T.StructField("surface_reelle_bati", T.DoubleType()),
        T.StructField("surface_terrain", T.DoubleType()),
        T.StructField("nombre_pieces_principales", T.IntegerType()),
        T.StructField("code_postal", T.StringType()),
        T.StructField("nom_commune", T.StringType()),
        T.StructField("code_departement", T.StringType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("surface_totale_bati", T.DoubleType()),
        T.StructField("surface_totale_terrain", T.DoubleType()),
        T.StructField("natures_culture", T.ArrayType(T.StringType())),
    ]
)
