"""DuckDB SQL equal in result to each registered query (the correctness
oracle). Tables of the driver are views of the same names."""

from __future__ import annotations

from parcelle.sources.adapter import RAW_SALES_SQL

RAW = f"raw_sales AS ({RAW_SALES_SQL})"

TYPED = """typed AS (
  SELECT id_mutation,
         CAST(try_strptime(date_mutation, '%Y-%m-%d') AS DATE) AS date_mutation,
         TRY_CAST(valeur_fonciere AS DOUBLE) AS valeur_fonciere,
         type_local,
         TRY_CAST(surface_reelle_bati AS DOUBLE) AS surface_reelle_bati,
         TRY_CAST(surface_terrain AS DOUBLE) AS surface_terrain,
         nature_culture,
         TRY_CAST(nombre_pieces_principales AS INTEGER) AS nombre_pieces_principales,
         code_postal, nom_commune, code_departement,
         TRY_CAST(longitude AS DOUBLE) AS longitude,
         TRY_CAST(latitude AS DOUBLE) AS latitude
  FROM raw_sales)"""

BLD_LINES = """bld_lines AS (
  SELECT id_mutation, date_mutation, valeur_fonciere, lower(trim(type_local)) AS type_local,
         surface_reelle_bati, surface_terrain, nature_culture, nombre_pieces_principales,
         code_postal, nom_commune, code_departement, longitude, latitude,
         valeur_fonciere / NULLIF(surface_reelle_bati, 0) AS prix_m2
  FROM typed
  WHERE type_local IS NOT NULL AND valeur_fonciere IS NOT NULL AND surface_reelle_bati IS NOT NULL
    AND valeur_fonciere / NULLIF(surface_reelle_bati, 0) BETWEEN 100 AND 20000)"""

LAND_LINES = """land_lines AS (
  SELECT id_mutation, date_mutation, valeur_fonciere, type_local,
         surface_reelle_bati, surface_terrain, lower(trim(nature_culture)) AS nature_culture,
         nombre_pieces_principales, code_postal, nom_commune, code_departement, longitude, latitude,
         valeur_fonciere / NULLIF(surface_terrain, 0) AS prix_m2_terrain
  FROM typed
  WHERE type_local IS NULL AND valeur_fonciere IS NOT NULL AND surface_terrain IS NOT NULL
    AND valeur_fonciere / NULLIF(surface_terrain, 0) BETWEEN 0.5 AND 1000)"""

BUILDINGS = """buildings AS (
  SELECT id_mutation, date_mutation, valeur_fonciere, code_postal, nom_commune, code_departement,
         type_local, nombre_pieces_principales,
         sum(surface_reelle_bati) AS surface_totale_bati,
         max(surface_terrain) AS surface_terrain,
         avg(longitude) AS longitude, avg(latitude) AS latitude,
         valeur_fonciere / NULLIF(sum(surface_reelle_bati), 0) AS prix_m2,
         sum(surface_reelle_bati) AS surface_reelle_bati
  FROM bld_lines
  GROUP BY id_mutation, date_mutation, valeur_fonciere, code_postal, nom_commune, code_departement,
           type_local, nombre_pieces_principales)"""

LAND = """land AS (
  SELECT id_mutation, date_mutation, valeur_fonciere, code_postal, nom_commune, code_departement,
         sum(surface_terrain) AS surface_totale_terrain,
         avg(longitude) AS longitude, avg(latitude) AS latitude,
         coalesce(list_sort(list(nature_culture) FILTER (WHERE nature_culture IS NOT NULL)),
                  CAST([] AS VARCHAR[])) AS natures_culture,
         valeur_fonciere / NULLIF(sum(surface_terrain), 0) AS prix_m2,
         'terrain' AS type_local,
         CAST(NULL AS DOUBLE) AS surface_reelle_bati,
         sum(surface_terrain) AS surface_terrain
  FROM land_lines
  GROUP BY id_mutation, date_mutation, valeur_fonciere, code_postal, nom_commune, code_departement)"""

CLEAN = """clean AS (
  SELECT id_mutation, date_mutation, valeur_fonciere, prix_m2, type_local, surface_reelle_bati,
         surface_terrain, nombre_pieces_principales, code_postal, nom_commune, code_departement,
         longitude, latitude, surface_totale_bati,
         CAST(NULL AS DOUBLE) AS surface_totale_terrain,
         CAST(NULL AS VARCHAR[]) AS natures_culture
  FROM buildings
  UNION ALL
  SELECT id_mutation, date_mutation, valeur_fonciere, prix_m2, type_local, surface_reelle_bati,
         surface_terrain, CAST(NULL AS INTEGER) AS nombre_pieces_principales, code_postal,
         nom_commune, code_departement, longitude, latitude,
         CAST(NULL AS DOUBLE) AS surface_totale_bati, surface_totale_terrain, natures_culture
  FROM land)"""

SERVING = """serving AS (
  SELECT id_mutation AS transaction_id, date_mutation AS sale_date, valeur_fonciere AS sale_price,
         prix_m2 AS price_per_sqm, type_local AS property_type, surface_reelle_bati AS living_area,
         surface_terrain AS land_area, nombre_pieces_principales AS rooms,
         code_postal AS postal_code, nom_commune AS city_name, code_departement AS department,
         longitude, latitude
  FROM clean)"""


def with_(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


SALES_CTES = (RAW, TYPED, BLD_LINES, LAND_LINES, BUILDINGS, LAND, CLEAN)

ORACLE: dict[str, str] = {
    "type_sales": with_(RAW, TYPED, body="SELECT * FROM typed"),
    "normalise_text": with_(RAW, body="""
        SELECT id_mutation, lower(trim(type_local)) AS type_local,
               lower(trim(nature_culture)) AS nature_culture
        FROM raw_sales"""),
    "price_per_m2": with_(RAW, TYPED, body="""
        SELECT id_mutation, type_local,
               valeur_fonciere / NULLIF(surface_reelle_bati, 0) AS prix_m2,
               valeur_fonciere / NULLIF(surface_terrain, 0) AS prix_m2_terrain
        FROM typed"""),
    "split_buildings": with_(RAW, TYPED, body="SELECT * FROM typed WHERE type_local IS NOT NULL"),
    "split_land": with_(RAW, TYPED, body="SELECT * FROM typed WHERE type_local IS NULL"),
    "required_fields": with_(RAW, TYPED, body="""
        SELECT *, CASE WHEN type_local IS NOT NULL THEN 'building' ELSE 'land' END AS branch
        FROM typed
        WHERE valeur_fonciere IS NOT NULL
          AND ((type_local IS NOT NULL AND surface_reelle_bati IS NOT NULL)
               OR (type_local IS NULL AND surface_terrain IS NOT NULL))"""),
    "outliers_building": with_(RAW, TYPED, BLD_LINES, body="SELECT * FROM bld_lines"),
    "outliers_land": with_(RAW, TYPED, LAND_LINES, body="SELECT * FROM land_lines"),
    "building_sales": with_(RAW, TYPED, BLD_LINES, BUILDINGS, body="SELECT * FROM buildings"),
    "land_sales": with_(RAW, TYPED, LAND_LINES, LAND, body="SELECT * FROM land"),
    "land_natures": with_(RAW, TYPED, LAND_LINES, LAND, body="""
        SELECT id_mutation, date_mutation, valeur_fonciere, code_postal, nom_commune,
               code_departement, natures_culture
        FROM land"""),
    "clean_sales": with_(*SALES_CTES, body="SELECT * FROM clean"),
    "serving_sales": with_(*SALES_CTES, SERVING, body="SELECT * FROM serving"),
    "sale_points": with_(*SALES_CTES, SERVING, body="""
        SELECT *, 'SRID=4326;POINT(' || CAST(longitude AS VARCHAR) || ' '
                  || CAST(latitude AS VARCHAR) || ')' AS coordinates
        FROM serving"""),
    "row_metrics": with_(*SALES_CTES, body="""
        SELECT 'row_count_raw' AS metric, count(*) AS value FROM raw_sales
        UNION ALL
        SELECT 'row_count_transformed' AS metric, count(*) AS value FROM clean"""),
}

ORACLE["conform_columns"] = with_(RAW, body="""
    SELECT id_mutation, date_mutation, valeur_fonciere, type_local, surface_reelle_bati,
           CAST(NULL AS VARCHAR) AS surface_terrain, CAST(NULL AS VARCHAR) AS nature_culture,
           CAST(NULL AS VARCHAR) AS nombre_pieces_principales, code_postal,
           CAST(NULL AS VARCHAR) AS nom_commune, CAST(NULL AS VARCHAR) AS code_departement,
           CAST(NULL AS VARCHAR) AS longitude, CAST(NULL AS VARCHAR) AS latitude
    FROM raw_sales""")

# -- sources and sinks --------------------------------------------------------

LANDED = """landed AS (
  SELECT *, code_departement AS departement, substr(date_mutation, 1, 4) AS annee,
         'dvf_' || code_departement || '_' || substr(date_mutation, 1, 4) || '.csv'
         || CASE WHEN CAST(substr(date_mutation, 1, 4) AS INTEGER) % 2 = 0 THEN '.gz' ELSE '' END
         AS fichier
  FROM raw_sales)"""

MISSING = """expected AS (
  SELECT d AS departement, CAST(y AS VARCHAR) AS annee
  FROM (VALUES ('22'), ('29'), ('35'), ('56')) scope(d),
       (SELECT unnest(generate_series(min(year(o_orderdate)), max(year(o_orderdate)))) AS y
        FROM orders) years),
missing AS (
  SELECT departement, annee FROM expected e
  WHERE NOT EXISTS (SELECT 1 FROM landed l
                    WHERE l.departement = e.departement AND l.annee = e.annee))"""

SCOPE = "('22', '29', '35', '56')"

RECORDS = """records AS (
  SELECT r_name AS reg_name, lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS dep_code,
         n_name AS dep_name, n_regionkey AS "geo.region_key", n_nationkey AS "geo.nation_key",
         [lpad(CAST(n_nationkey AS VARCHAR), 2, '0'), CAST(n_regionkey AS VARCHAR)] AS codes,
         CASE WHEN n_nationkey % 2 = 0 THEN n_name END AS "extra.note"
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def _layer(column: str, code: str) -> str:
    return f"""layer AS (
  SELECT {code} AS "{column}", n_name AS "NOM", 'Polygon' AS "geometry.type",
         [[[x0, y0], [x0 + 0.125, y0], [x0 + 0.125, y0 + 0.125], [x0, y0 + 0.125], [x0, y0]]]
           AS "geometry.coordinates"
  FROM (SELECT *, -5e0 + n_nationkey * 0.125e0 AS x0, 47e0 + n_regionkey * 0.125e0 AS y0
        FROM nation) n)"""


CODE = "lpad(CAST(n_nationkey AS VARCHAR), 2, '0')"

ORACLE.update({
    "scan_csv": with_(RAW, body="SELECT * FROM raw_sales"),
    "scan_parquet": """
        SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate) FROM orders""",
    "landing_manifest": with_(RAW, LANDED, body="""
        SELECT DISTINCT departement, annee, fichier,
               CASE WHEN fichier LIKE '%.gz' THEN 'csv.gz' ELSE 'csv' END AS format,
               fichier NOT LIKE '%.gz' AS decompressed
        FROM landed"""),
    "landing_versions": with_(RAW, body="""
        SELECT * REPLACE (CASE WHEN code_departement = '05' THEN nom_commune || ' 2' ELSE nom_commune END AS nom_commune)
        FROM raw_sales"""),
    "scan_csv_headers": with_(RAW, body="""
        SELECT * REPLACE (
            CASE WHEN CAST(code_departement AS INTEGER) % 2 = 1 THEN longitude END AS longitude,
            CASE WHEN CAST(code_departement AS INTEGER) % 2 = 1 THEN latitude END AS latitude)
        FROM raw_sales"""),
    "scan_csv_defaults": """
        SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_brand, CAST(p_size AS VARCHAR) AS p_size FROM part""",
    "scan_gz_partitions": with_(RAW, body="SELECT * FROM raw_sales"),
    "file_name_columns": with_(RAW, LANDED, body="SELECT * FROM landed"),
    "missing_partitions": with_(RAW, LANDED, MISSING, body="SELECT * FROM missing"),
    "manifest_summary": with_(RAW, LANDED, MISSING, body="""
        SELECT (SELECT count(DISTINCT fichier) FROM landed) AS files_count,
               (SELECT count(DISTINCT fichier) FROM landed) AS success_count,
               (SELECT count(*) FROM missing) AS failure_count"""),
    "dataset_metadata": with_(RAW, LANDED, body="""
        SELECT list_sort(list(DISTINCT departement)) AS departements,
               list_sort(list(DISTINCT annee)) AS annees,
               list_sort(list(DISTINCT fichier)) AS fichiers,
               count(*) AS nombre_enregistrements,
               ['id_mutation', 'date_mutation', 'valeur_fonciere', 'type_local',
                'surface_reelle_bati', 'surface_terrain', 'nature_culture',
                'nombre_pieces_principales', 'code_postal', 'nom_commune', 'code_departement',
                'longitude', 'latitude'] AS colonnes
        FROM landed"""),
    "sink_parquet": with_(*SALES_CTES, body="SELECT * FROM clean"),
    "sink_append": with_(RAW, TYPED, body="SELECT * FROM typed UNION ALL SELECT * FROM typed"),
    "sink_dated": with_(RAW, TYPED, BLD_LINES, BUILDINGS, body="SELECT * FROM buildings"),
    "sink_csv_nested": with_(RAW, TYPED, LAND_LINES, LAND, body="""
        SELECT * REPLACE (CAST(to_json(natures_culture) AS VARCHAR) AS natures_culture)
        FROM land"""),
    "sink_json": with_(*SALES_CTES, body="SELECT * FROM clean"),
    "jdbc_roundtrip": with_(*SALES_CTES, SERVING, body="""
        SELECT *, 'SRID=4326;POINT(' || CAST(longitude AS VARCHAR) || ' '
                  || CAST(latitude AS VARCHAR) || ')' AS coordinates
        FROM serving"""),
    "jdbc_filter": with_(*SALES_CTES, SERVING, body="""
        SELECT *, 'SRID=4326;POINT(' || CAST(longitude AS VARCHAR) || ' '
                  || CAST(latitude AS VARCHAR) || ')' AS coordinates
        FROM serving WHERE property_type = 'terrain'"""),
    "json_pages": with_(RECORDS, body="SELECT * FROM records"),
    "json_pages_complete": """
        SELECT count(*) AS fetched, count(*) AS total_count, true AS complete
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "flatten_json": """
        SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS "props.k" FROM events""",
    "region_equals": with_(RECORDS, body="SELECT * FROM records WHERE reg_name = 'EUROPE'"),
    "scan_geojson": with_(_layer("CODE_DEP", CODE), body="SELECT * FROM layer"),
    "region_filter": with_(_layer("CODE_DEP", CODE),
                           body=f'SELECT * FROM layer WHERE "CODE_DEP" IN {SCOPE}'),
    "region_filter_prefix": with_(_layer("DEPCOM", f"{CODE} || '001'"), body="""
        SELECT * FROM layer
        WHERE starts_with("DEPCOM", '22') OR starts_with("DEPCOM", '29')
           OR starts_with("DEPCOM", '35') OR starts_with("DEPCOM", '56')"""),
    "region_filter_all": with_(_layer("DEP", f"'X' || {CODE}"), body="SELECT * FROM layer"),
})

ORACLE["stream_clean_sales"] = with_(*SALES_CTES, body="SELECT * FROM clean")

ORACLE["sink_geojson"] = ORACLE["region_filter"]
ORACLE["job_report"] = with_(*SALES_CTES, body="""
    SELECT 'success' AS status, 'SalesJob' AS job_name,
           (SELECT count(*) FROM raw_sales) AS row_count_raw,
           (SELECT count(*) FROM clean) AS row_count_transformed""")

# -- integrity, rejected lines, metadata, collection outputs -------------------

FLAGGED = """flagged AS (
  SELECT *, CASE WHEN fichier NOT LIKE '%.gz' THEN NULL
                 WHEN departement = '01' THEN 'cut before the end of member 1'
                 WHEN departement = '02' THEN 'wrong checksum in member 1' END AS decompression_error,
         fichier LIKE '%.gz' AND departement = '03' AS emptied
  FROM landed)"""

ORACLE["landing_integrity"] = with_(RAW, LANDED, FLAGGED, body="""
    SELECT DISTINCT departement, annee, fichier,
           CASE WHEN fichier LIKE '%.gz' THEN 'csv.gz' ELSE 'csv' END AS format,
           fichier NOT LIKE '%.gz' AS decompressed, decompression_error
    FROM flagged""")
ORACLE["landing_sound_lines"] = with_(RAW, LANDED, FLAGGED, body="""
    SELECT * EXCLUDE (decompression_error, emptied) FROM flagged WHERE decompression_error IS NULL AND NOT emptied""")
ORACLE["landing_metadata"] = with_(RAW, LANDED, FLAGGED, """files AS (
    SELECT fichier, departement, annee, CASE WHEN fichier LIKE '%.gz' THEN 'csv.gz' ELSE 'csv' END AS format,
           fichier NOT LIKE '%.gz' AS decompressed, decompression_error,
           count(*) FILTER (WHERE decompression_error IS NULL AND NOT emptied) AS nombre_lignes
    FROM flagged GROUP BY ALL)""", body="""
    SELECT count(*) AS nombre_fichiers, sum(nombre_lignes)::BIGINT AS nombre_lignes, 0::BIGINT AS nombre_rejets,
           count(decompression_error) AS fichiers_endommages,
           list(concat_ws('|', fichier, departement, annee, format, decompressed::VARCHAR, coalesce(decompression_error, ''),
                          nombre_lignes::VARCHAR, '0') ORDER BY fichier) AS fichiers,
           'files by department' AS source, ['1992', '1998'] AS annees_demandees
    FROM files""")

_FIELDS = [f"coalesce({c}, '')" for c in (
    "id_mutation", "date_mutation", "valeur_fonciere", "type_local", "surface_reelle_bati", "surface_terrain", "nature_culture",
    "nombre_pieces_principales", "code_postal", "nom_commune", "code_departement", "longitude", "latitude")]
_QUOTED = [_FIELDS[0], "'\"' || " + _FIELDS[1], *_FIELDS[2:]]
ORACLE["rejected_lines"] = with_(RAW, body=f"""
    SELECT '01' AS departement, '2020' AS annee, 'dvf_01_2020.csv' AS fichier,
           CASE right(code_postal, 1) WHEN '7' THEN concat_ws(',', {", ".join(_FIELDS[:-2])})
                                      WHEN '8' THEN concat_ws(',', {", ".join(_FIELDS)}, 'more')
                                      ELSE concat_ws(',', {", ".join(_QUOTED)}) END AS line,
           CASE right(code_postal, 1) WHEN '7' THEN 'too few fields' WHEN '8' THEN 'too many fields' ELSE 'open quote' END AS reason
    FROM raw_sales WHERE right(code_postal, 1) IN ('7', '8', '9')""")
ORACLE["kept_lines"] = with_(RAW, body="SELECT * FROM raw_sales WHERE right(code_postal, 1) NOT IN ('7', '8', '9')")
ORACLE["line_counts"] = with_(RAW, body="""
    SELECT count(*) FILTER (WHERE right(code_postal, 1) NOT IN ('7', '8', '9')) AS kept,
           count(*) FILTER (WHERE right(code_postal, 1) IN ('7', '8', '9')) AS rejected, count(*) AS read
    FROM raw_sales""")

NAME_TREE = """tree AS (
  SELECT r_name || '/' || n_name || CASE n_nationkey % 3 WHEN 0 THEN '.txt' WHEN 1 THEN '.SHP' ELSE '.gpkg' END AS path
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""
ORACLE["find_layer_file"] = with_(NAME_TREE, body="""
    SELECT min(path) AS path FROM tree WHERE lower(path) LIKE '%.gpkg' OR lower(path) LIKE '%.shp'""")
ORACLE["listing_text"] = with_(NAME_TREE, body="SELECT path FROM tree")
ORACLE["outputs_records_csv"] = with_(RECORDS, body="""
    SELECT reg_name, dep_code, dep_name, "geo.region_key"::VARCHAR AS "geo.region_key", "geo.nation_key"::VARCHAR AS "geo.nation_key",
           to_json(codes)::VARCHAR AS codes, "extra.note"
    FROM records""")
ORACLE["outputs_records_json"] = ORACLE["json_pages"]
ORACLE["outputs_records_metadata"] = with_(RECORDS, body="""
    SELECT count(*) AS nombre_enregistrements, 'records api' AS source, ['EUROPE', 'ASIA'] AS regions,
           ['reg_name', 'dep_code', 'dep_name', 'geo.region_key', 'geo.nation_key', 'codes', 'extra.note'] AS colonnes
    FROM records""")
ORACLE["outputs_layer"] = ORACLE["scan_geojson"]
ORACLE["outputs_landing"] = with_(RAW, LANDED, MISSING, body="""
    SELECT DISTINCT departement, annee, fichier, 'successful' AS list FROM landed
    UNION ALL SELECT departement, annee, NULL, 'failed' FROM missing""")


# -- geometry and published outputs --------------------------------------------

# The inverse conic projection with its published constants: cone constant,
# radius, northing of the apex, eccentricity squared.
ORACLE["layer_to_degrees"] = """
WITH k AS (SELECT 0.7256077650532682e0 AS n, 11754255.42609601e0 AS c, 12655612.049875995e0 AS ys,
                  2 / 298.257222101e0 - 1 / (298.257222101e0 * 298.257222101e0) AS e2),
corners AS (
  SELECT n_name, i AS corner,
         100000e0 + n_nationkey * 40000e0 + CASE WHEN i IN (1, 2) THEN 20000e0 ELSE 0e0 END AS x,
         6100000e0 + n_regionkey * 200000e0 + CASE WHEN i IN (2, 3) THEN 20000e0 ELSE 0e0 END AS y
  FROM nation, (SELECT unnest([0, 1, 2, 3, 4]) AS i) t),
polar AS (
  SELECT n_name, corner, n, e2, atan2(x - 700000, ys - y) / n AS turn,
         -ln(sqrt((x - 700000) * (x - 700000) + (ys - y) * (ys - y)) / c) / n AS iso
  FROM corners, k),
conformal AS (SELECT *, atan((exp(iso) - exp(-iso)) / 2) AS u FROM polar)
SELECT n_name AS "NOM", 4326 AS srid, corner, round(3 + degrees(turn), 7) AS longitude,
       round(degrees(u + (e2 / 2 + 5 * e2 ** 2 / 24 + e2 ** 3 / 12 + 13 * e2 ** 4 / 360) * sin(2 * u)
                       + (7 * e2 ** 2 / 48 + 29 * e2 ** 3 / 240 + 811 * e2 ** 4 / 11520) * sin(4 * u)
                       + (7 * e2 ** 3 / 120 + 81 * e2 ** 4 / 1120) * sin(6 * u)
                       + 4279 * e2 ** 4 / 161280 * sin(8 * u)), 7) AS latitude
FROM conformal"""


def _bytes(x: str) -> str:
    return f"hex(CAST(CAST({x} AS DOUBLE) AS BIT)::BLOB)"


ORACLE["sale_points_wkb"] = with_(*SALES_CTES, SERVING, body=f"""
    SELECT transaction_id, property_type, rooms, '0020000001000010E6' || {_bytes("longitude")} || {_bytes("latitude")} AS ewkb
    FROM serving""")
ORACLE["layer_wkb"] = with_(_layer("CODE_DEP", CODE), body=f"""
    SELECT "CODE_DEP", '00000000030000000100000005' || string_agg({_bytes("p[1]")} || {_bytes("p[2]")}, '' ORDER BY i) AS wkb
    FROM (SELECT "CODE_DEP", unnest("geometry.coordinates"[1]) AS p, unnest(range(5)) AS i FROM layer)
    GROUP BY "CODE_DEP" """)
ORACLE["sales_in_areas"] = with_(*SALES_CTES, SERVING, body=f"""
    SELECT transaction_id, property_type, rooms, longitude, latitude, {CODE} AS "CODE_DEP", n_name AS "NOM"
    FROM serving JOIN (SELECT *, -5e0 + n_nationkey * 0.125e0 AS x0, 47e0 + n_regionkey * 0.125e0 AS y0 FROM nation) n
      ON longitude >= x0 AND longitude < x0 + 0.125 AND latitude >= y0 AND latitude < y0 + 0.125""")
ORACLE["sink_published"] = with_(*SALES_CTES, body="SELECT * FROM clean")
