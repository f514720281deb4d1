"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame
computed over the whole driver tables (or data Spark derives from them)."""

from __future__ import annotations

import gzip
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelle.functions.lambert import to_degrees
from parcelle.functions.nested import flatten, parse_json_column
from parcelle.functions.typing import normalise_text, ratio
from parcelle.functions.wkb import point_wkb, polygon_wkb
from parcelle.operators.aggregate import building_sales, land_sales
from parcelle.operators.conform import conform_columns
from parcelle.operators.filters import (
    prepare_buildings,
    prepare_land,
    required_fields,
    sale_lines,
    split_buildings,
    split_land,
)
from parcelle.operators.spatial import points_in_areas
from parcelle.plans.areas import find_layer_file, region_filter
from parcelle.plans.clean import clean_sales, sale_points, serving_sales, typed_sales
from parcelle.plans.job import SalesJob, report_frame, run_job
from parcelle.plans.landing import (
    dataset_metadata,
    expected_grid,
    integrity_errors,
    land_files,
    landing_manifest,
    landing_metadata,
    manifest_summary,
    missing_partitions,
    read_landed,
    read_rejected,
    slices_of,
    with_decompression_errors,
)
from parcelle.plans.outputs import save_landing, save_layer, save_listing, save_records
from parcelle.plans.records import (
    area_records,
    land_layer,
    polygon_layer,
    records_in_region,
    write_pages,
)
from parcelle.schema import (
    CLEAN_SCHEMA,
    LAND_KEYS,
    LAND_TYPE_LABEL,
    POINT_SRID,
    RAW_SALES_SCHEMA,
    SCOPE_DEPARTMENTS,
)
from parcelle.session import scratch_path
from parcelle.sinks.files import (
    EXTRACT_DATE,
    nested_as_json,
    put_bytes,
    stored_bytes,
    write,
    write_csv,
    write_dated,
    write_json,
)
from parcelle.sinks.geojson import write_geojson
from parcelle.sinks.published import publish, read_published, stage
from parcelle.sources.adapter import raw_sales, table
from parcelle.sources.files import RAW_TEXT_OPTIONS, read, read_sales
from parcelle.sources.jdbc import derby_memory, read_table, string_column_types, write_table
from parcelle.sources.json_records import page_records, pages_complete, read_geojson, read_pages
from parcelle.streaming.landed import clean_new_files, read_cleaned

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return register


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_sales(raw_sales(spark, sf_dir))


# -- projections and scalar functions ---------------------------------------

@query("type_sales")
def q_type_sales(spark, sf_dir):
    return _typed(spark, sf_dir)


@query("normalise_text")
def q_normalise_text(spark, sf_dir):
    return raw_sales(spark, sf_dir).select(
        "id_mutation",
        normalise_text("type_local").alias("type_local"),
        normalise_text("nature_culture").alias("nature_culture"),
    )


@query("price_per_m2")
def q_price_per_m2(spark, sf_dir):
    return _typed(spark, sf_dir).select(
        "id_mutation",
        "type_local",
        ratio("valeur_fonciere", "surface_reelle_bati").alias("prix_m2"),
        ratio("valeur_fonciere", "surface_terrain").alias("prix_m2_terrain"),
    )


@query("conform_columns")
def q_conform_columns(spark, sf_dir):
    # The unit-test fixture's six columns; the other seven become typed NULLs.
    six = raw_sales(spark, sf_dir).select(
        "id_mutation", "date_mutation", "valeur_fonciere", "surface_reelle_bati",
        "type_local", "code_postal",
    )
    return conform_columns(six, RAW_SALES_SCHEMA)


# -- filters ------------------------------------------------------------------

@query("split_buildings")
def q_split_buildings(spark, sf_dir):
    return split_buildings(_typed(spark, sf_dir))


@query("split_land")
def q_split_land(spark, sf_dir):
    return split_land(_typed(spark, sf_dir))


@query("required_fields")
def q_required_fields(spark, sf_dir):
    return required_fields(_typed(spark, sf_dir))


@query("outliers_building")
def q_outliers_building(spark, sf_dir):
    return prepare_buildings(_typed(spark, sf_dir))


@query("outliers_land")
def q_outliers_land(spark, sf_dir):
    return prepare_land(_typed(spark, sf_dir))


# -- aggregations and the flagship -------------------------------------------

@query("building_sales")
def q_building_sales(spark, sf_dir):
    return building_sales(sale_lines(_typed(spark, sf_dir), land=False))


@query("land_sales")
def q_land_sales(spark, sf_dir):
    return land_sales(sale_lines(_typed(spark, sf_dir), buildings=False))


@query("land_natures")
def q_land_natures(spark, sf_dir):
    return land_sales(sale_lines(_typed(spark, sf_dir), buildings=False)).select(
        *LAND_KEYS, "natures_culture")


@query("clean_sales")
def q_clean_sales(spark, sf_dir):
    return clean_sales(raw_sales(spark, sf_dir))


@query("serving_sales")
def q_serving_sales(spark, sf_dir):
    return serving_sales(clean_sales(raw_sales(spark, sf_dir)))


@query("sale_points")
def q_sale_points(spark, sf_dir):
    return sale_points(serving_sales(clean_sales(raw_sales(spark, sf_dir))))


@query("row_metrics")
def q_row_metrics(spark, sf_dir):
    raw_seen, clean_seen = Observation("raw"), Observation("clean")
    raw = raw_sales(spark, sf_dir).observe(raw_seen, F.count(F.lit(1)).alias("row_count_raw"))
    clean = clean_sales(raw).observe(clean_seen, F.count(F.lit(1)).alias("row_count_transformed"))
    write(clean, scratch_path(spark, "observed-clean"), format="parquet")
    return spark.createDataFrame(list({**raw_seen.get, **clean_seen.get}.items()), "metric string, value long")


# -- sources and sinks --------------------------------------------------------
# Every query below writes its intermediate files under a fresh folder of the
# shared checkpoint folder (spark.checkpoint.dir), then reads them back.

def _even_year() -> Column:
    return F.substring(F.col("date_mutation"), 1, 4).cast("int") % 2 == 0


def _landed_root(spark, sf_dir) -> str:
    root = scratch_path(spark, "landing")
    lines = stored_bytes(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet")
    land_files(raw_sales(spark, sf_dir), root, gzip=_even_year(),
               stage=scratch_path(spark, "landing-stage"), stage_slices=slices_of(lines))
    return root


@query("scan_csv")
def q_scan_csv(spark, sf_dir):
    path = scratch_path(spark, "raw-csv")
    write_csv(raw_sales(spark, sf_dir), path)
    return read(spark, path, "csv", options=RAW_TEXT_OPTIONS, schema=RAW_SALES_SCHEMA)


@query("scan_parquet")
def q_scan_parquet(spark, sf_dir):
    orders = read(spark, f"{sf_dir}/orders.parquet", "parquet")
    return orders.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


@query("scan_gz_partitions")
def q_scan_gz_partitions(spark, sf_dir):
    return read_landed(spark, _landed_root(spark, sf_dir)).select(*RAW_SALES_SCHEMA.names)


@query("file_name_columns")
def q_file_name_columns(spark, sf_dir):
    return read_landed(spark, _landed_root(spark, sf_dir))


@query("landing_manifest")
def q_landing_manifest(spark, sf_dir):
    return landing_manifest(spark, _landed_root(spark, sf_dir)).drop("taille")


@query("landing_versions")
def q_landing_versions(spark, sf_dir):
    """Two landing runs: the second replaces the files of one department by
    compressed ones with other town names."""
    root, raw = scratch_path(spark, "landing-versions"), raw_sales(spark, sf_dir)
    land_files(raw, root, run="1")
    again = raw.where("code_departement = '05'").withColumn("nom_commune", F.concat("nom_commune", F.lit(" 2")))
    land_files(again, root, gzip=F.lit(True), run="2")
    return read_sales(spark, root)


@query("scan_csv_headers")
def q_scan_csv_headers(spark, sf_dir):
    """Landed files whose columns are in another order, with others between,
    and lacking two in one of the files."""
    root, raw = scratch_path(spark, "headers"), raw_sales(spark, sf_dir)
    odd = F.col("code_departement").cast("int") % 2 == 1
    shuffled = raw.where(odd).select(F.lit("x").alias("numero"), *reversed(raw.columns), F.lit("y").alias("adresse"))
    write_csv(shuffled, f"{root}/dvf_01_2019.csv")
    write_csv(raw.where(~odd).drop("longitude", "latitude"), f"{root}/dvf_02_2019.csv")
    return read_sales(spark, root)


@query("scan_csv_defaults")
def q_scan_csv_defaults(spark, sf_dir):
    path = scratch_path(spark, "default-csv")
    write(table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size"), path, format="csv", options={"header": "true"})
    return read(spark, path).select(*[F.col(c).cast("string") for c in ("p_partkey", "p_brand", "p_size")])


def _expected(spark, sf_dir) -> DataFrame:
    # The collection scope's departments over every year of the sales.
    departments = spark.createDataFrame([(d,) for d in SCOPE_DEPARTMENTS], "departement string")
    lo, hi = table(spark, sf_dir, "orders").agg(
        F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).first()
    return expected_grid(departments, [str(y) for y in range(lo, hi + 1)])


@query("missing_partitions")
def q_missing_partitions(spark, sf_dir):
    manifest = landing_manifest(spark, _landed_root(spark, sf_dir))
    return missing_partitions(_expected(spark, sf_dir), manifest)


@query("manifest_summary")
def q_manifest_summary(spark, sf_dir):
    manifest = landing_manifest(spark, _landed_root(spark, sf_dir))
    return manifest_summary(manifest, missing_partitions(_expected(spark, sf_dir), manifest))


@query("dataset_metadata")
def q_dataset_metadata(spark, sf_dir):
    return dataset_metadata(read_landed(spark, _landed_root(spark, sf_dir)), with_time=False)


# What is wrong with the landed files of a department in ``_damaged_root``.
CUT_DEPARTMENT, FLIPPED_DEPARTMENT, EMPTY_DEPARTMENT = "01", "02", "03"


def _damaged_root(spark, sf_dir) -> str:
    """A landing in which the compressed files of three departments are cut
    half way, have a wrong bit in the checksum, or are valid and empty."""
    root = _landed_root(spark, sf_dir)
    packed = landing_manifest(spark, root).where("not decompressed").select("fichier", "departement")
    parts = integrity_errors(spark, root).join(packed, "fichier").where(
        F.col("departement").isin(CUT_DEPARTMENT, FLIPPED_DEPARTMENT, EMPTY_DEPARTMENT)).select("path", "departement").collect()
    for r in parts:  # the parts of three departments
        content = bytes(spark.read.format("binaryFile").load(r["path"]).first()["content"])
        put_bytes(spark, r["path"], {
            CUT_DEPARTMENT: content[:len(content) // 2],
            FLIPPED_DEPARTMENT: content[:-8] + bytes([content[-8] ^ 1]) + content[-7:],
            EMPTY_DEPARTMENT: gzip.compress(b""),
        }[r["departement"]])
    return root


@query("landing_integrity")
def q_landing_integrity(spark, sf_dir):
    root = _damaged_root(spark, sf_dir)
    return with_decompression_errors(spark, root, landing_manifest(spark, root)).drop("taille")


@query("landing_sound_lines")
def q_landing_sound_lines(spark, sf_dir):
    """Lines of the files that decode to their end: none of a damaged file."""
    return read_landed(spark, _damaged_root(spark, sf_dir), only_sound=True)


@query("landing_metadata")
def q_landing_metadata(spark, sf_dir):
    root = _damaged_root(spark, sf_dir)
    out = landing_metadata(spark, root, source="files by department", scope={"annees_demandees": ["1992", "1998"]}, with_time=False)
    # A record as text, without the stored size, which depends on the writer.
    names = ["fichier", "departement", "annee", "format", "decompressed", "decompression_error", "nombre_lignes", "nombre_rejets"]
    texts = F.transform("fichiers", lambda f: F.concat_ws("|", *(F.coalesce(f[n].cast("string"), F.lit("")) for n in names)))
    return out.drop("taille_totale").withColumn("fichiers", texts)


def _malformed_root(spark, sf_dir) -> str:
    """Landed lines of which some lack their last two fields, have one more,
    or leave a quote open in the second field."""
    root, raw = scratch_path(spark, "malformed"), raw_sales(spark, sf_dir)
    fields = [F.coalesce(F.col(c), F.lit("")) for c in raw.columns]
    last = F.substring("code_postal", -1, 1)
    line = F.when(last == "7", F.concat_ws(",", *fields[:-2])).when(last == "8", F.concat_ws(",", *fields, F.lit("more"))).when(
        last == "9", F.concat_ws(",", fields[0], F.concat(F.lit('"'), fields[1]), *fields[2:])).otherwise(F.concat_ws(",", *fields))
    # One column that holds whole lines, named by the header line, unquoted.
    lines = raw.select(line.alias(",".join(raw.columns)))
    write(lines, f"{root}/dvf_01_2020.csv", format="csv", options={
        "header": "true", "sep": "\u0001", "quote": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    return root


@query("rejected_lines")
def q_rejected_lines(spark, sf_dir):
    return read_rejected(spark, _malformed_root(spark, sf_dir))


@query("kept_lines")
def q_kept_lines(spark, sf_dir):
    return read_sales(spark, _malformed_root(spark, sf_dir))


@query("line_counts")
def q_line_counts(spark, sf_dir):
    """kept + rejected = read, of one landing; read counts lines of text."""
    root = _malformed_root(spark, sf_dir)
    kept, rejected = read_sales(spark, root).agg(F.count("id_mutation").alias("kept")), read_rejected(spark, root)
    text = spark.read.option("recursiveFileLookup", "true").text(root).where(~F.col("value").startswith("id_mutation,"))
    counts = [kept.select("kept").first()[0], rejected.count(), text.count()]
    return spark.createDataFrame([tuple(counts)], "kept long, rejected long, read long")


@query("sink_parquet")
def q_sink_parquet(spark, sf_dir):
    path = scratch_path(spark, "clean-parquet")
    write(clean_sales(raw_sales(spark, sf_dir)), path, format="parquet")
    return spark.read.parquet(path)


@query("sink_append")
def q_sink_append(spark, sf_dir):
    path = scratch_path(spark, "typed-append")
    typed = _typed(spark, sf_dir)
    write(typed, path, format="parquet", mode="overwrite")
    write(typed, path, format="parquet", mode="append")
    return spark.read.parquet(path)


@query("sink_dated")
def q_sink_dated(spark, sf_dir):
    path = scratch_path(spark, "dated")
    today = spark.range(1).select(F.date_format(F.current_date(), "yyyyMMdd")).first()[0]
    write_dated(building_sales(sale_lines(_typed(spark, sf_dir), land=False)), path, date=today)
    return (spark.read.parquet(path)
            .filter(F.col(EXTRACT_DATE).cast("string") == today).drop(EXTRACT_DATE))


@query("sink_csv_nested")
def q_sink_csv_nested(spark, sf_dir):
    path = scratch_path(spark, "land-csv")
    land = land_sales(sale_lines(_typed(spark, sf_dir), buildings=False))
    write_csv(land, path)
    return read(spark, path, "csv", options=RAW_TEXT_OPTIONS,
                schema=nested_as_json(land).schema)


@query("sink_json")
def q_sink_json(spark, sf_dir):
    path = scratch_path(spark, "clean-json")
    write_json(clean_sales(raw_sales(spark, sf_dir)), path)
    return read(spark, path, "json", schema=CLEAN_SCHEMA)


def _jdbc_loaded(spark, sf_dir):
    target = derby_memory(f"parcelle_{uuid.uuid4().hex[:10]}")
    points = sale_points(serving_sales(clean_sales(raw_sales(spark, sf_dir))))
    write_table(points, target, column_types=string_column_types(points))
    return target


@query("jdbc_roundtrip")
def q_jdbc_roundtrip(spark, sf_dir):
    target = _jdbc_loaded(spark, sf_dir)
    return read_table(spark, target, partition_column="sale_price", num_partitions=4)


@query("jdbc_filter")
def q_jdbc_filter(spark, sf_dir):
    target = _jdbc_loaded(spark, sf_dir)
    return read_table(spark, target, where=F.col("property_type") == F.lit(LAND_TYPE_LABEL))


# -- paged area records -------------------------------------------------------

PAGE_SIZE_FIXTURE = 10


def _pages(spark, sf_dir):
    records = area_records(spark, sf_dir)
    root = scratch_path(spark, "pages")
    write_pages(records, root, PAGE_SIZE_FIXTURE,
                F.floor(F.col("_key") / PAGE_SIZE_FIXTURE))
    schema = T.StructType([
        T.StructField("total_count", T.LongType()),
        T.StructField("results", T.ArrayType(records.schema["record"].dataType)),
    ])
    return read_pages(spark, root, schema=schema)


@query("json_pages")
def q_json_pages(spark, sf_dir):
    return flatten(page_records(_pages(spark, sf_dir)))


@query("json_pages_complete")
def q_json_pages_complete(spark, sf_dir):
    return pages_complete(_pages(spark, sf_dir))


@query("flatten_json")
def q_flatten_json(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "props")
    return flatten(parse_json_column(events, "props"))


@query("region_equals")
def q_region_equals(spark, sf_dir):
    return records_in_region(flatten(page_records(_pages(spark, sf_dir))), "EUROPE")


# -- area polygons ------------------------------------------------------------

def _code() -> Column:
    return F.lpad(F.col("n_nationkey").cast("string"), 2, "0")


def _layer(spark, sf_dir, column: str, code: Column):
    root = scratch_path(spark, "layer")
    land_layer(polygon_layer(spark, sf_dir, column, code), root)
    return read_geojson(spark, root)


@query("scan_geojson")
def q_scan_geojson(spark, sf_dir):
    return flatten(_layer(spark, sf_dir, "CODE_DEP", _code()))


@query("region_filter")
def q_region_filter(spark, sf_dir):
    return flatten(region_filter(_layer(spark, sf_dir, "CODE_DEP", _code()), SCOPE_DEPARTMENTS))


@query("region_filter_prefix")
def q_region_filter_prefix(spark, sf_dir):
    layer = _layer(spark, sf_dir, "DEPCOM", F.concat(_code(), F.lit("001")))
    return flatten(region_filter(layer, SCOPE_DEPARTMENTS))


@query("region_filter_all")
def q_region_filter_all(spark, sf_dir):
    layer = _layer(spark, sf_dir, "DEP", F.concat(F.lit("X"), _code()))
    return flatten(region_filter(layer, SCOPE_DEPARTMENTS))


@query("sink_geojson")
def q_sink_geojson(spark, sf_dir):
    kept = region_filter(_layer(spark, sf_dir, "CODE_DEP", _code()), SCOPE_DEPARTMENTS)
    path = scratch_path(spark, "geojson-out")
    write_geojson(kept, path)
    return flatten(read_geojson(spark, path))


@query("find_layer_file")
def q_find_layer_file(spark, sf_dir):
    """A tree with a folder per region and a file per nation, some of them
    layers; the first layer's path below the root."""
    root = scratch_path(spark, "tree")
    _name_tree(spark, sf_dir, root)
    return find_layer_file(spark, root).select(F.col("relative").alias("path"))


def _name_tree(spark, sf_dir, root):
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    for r in nations.select("n_nationkey", "n_name", "r_name").collect():  # file names: one per nation
        suffix = (".txt", ".SHP", ".gpkg")[r["n_nationkey"] % 3]
        put_bytes(spark, f"{root}/{r['r_name']}/{r['n_name']}{suffix}", r["n_name"].encode())


@query("listing_text")
def q_listing_text(spark, sf_dir):
    tree, out = scratch_path(spark, "listed-tree"), scratch_path(spark, "listing")
    _name_tree(spark, sf_dir, tree)
    save_listing(spark, tree, out)
    return spark.read.text(f"{out}/listing").select(F.col("value").alias("path"))


# -- collection outputs -------------------------------------------------------

SCOPE = {"regions": ["EUROPE", "ASIA"]}


def _records_saved(spark, sf_dir):
    root = scratch_path(spark, "records-out")
    save_records(flatten(page_records(_pages(spark, sf_dir))), root, source="records api", scope=SCOPE)
    return root


@query("outputs_records_csv")
def q_outputs_records_csv(spark, sf_dir):
    return read(spark, f"{_records_saved(spark, sf_dir)}/csv", "csv", options=RAW_TEXT_OPTIONS | {"recursiveFileLookup": "false"}).drop(
        EXTRACT_DATE)


@query("outputs_records_json")
def q_outputs_records_json(spark, sf_dir):
    return spark.read.json(f"{_records_saved(spark, sf_dir)}/json").drop(EXTRACT_DATE)


@query("outputs_records_metadata")
def q_outputs_records_metadata(spark, sf_dir):
    return spark.read.json(f"{_records_saved(spark, sf_dir)}/metadata").drop(EXTRACT_DATE, "date_extraction")


@query("outputs_layer")
def q_outputs_layer(spark, sf_dir):
    root = scratch_path(spark, "layer-out")
    save_layer(_layer(spark, sf_dir, "CODE_DEP", _code()), root, source="layer", scope=SCOPE)
    return flatten(read_geojson(spark, f"{root}/geojson").drop(EXTRACT_DATE))


@query("outputs_landing")
def q_outputs_landing(spark, sf_dir):
    """Success and failure lists as they are read back from their files."""
    landing, root = _landed_root(spark, sf_dir), scratch_path(spark, "landing-out")
    manifest = landing_manifest(spark, landing)
    save_landing(manifest, missing_partitions(_expected(spark, sf_dir), manifest), read_landed(spark, landing), root)
    schema = "departement string, annee string, fichier string"
    lists = [spark.read.schema(schema).json(f"{root}/{name}").withColumn("list", F.lit(name)) for name in ("successful", "failed")]
    return lists[0].unionByName(lists[1]).drop(EXTRACT_DATE)


# -- geometry -----------------------------------------------------------------

METRES = 20_000.0


@query("layer_to_degrees")
def q_layer_to_degrees(spark, sf_dir):
    """A layer in Lambert-93 metres, landed and read back, in degrees: one
    row per corner."""
    x0 = F.lit(100_000.0) + F.col("n_nationkey") * 40_000.0
    y0 = F.lit(6_100_000.0) + F.col("n_regionkey") * 200_000.0
    corner = lambda i, j: F.array(x0 + i * METRES, y0 + j * METRES)
    ring = F.array(corner(0, 0), corner(1, 0), corner(1, 1), corner(0, 1), corner(0, 0))
    square = F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))
    root = scratch_path(spark, "lambert")
    land_layer(table(spark, sf_dir, "nation").select(F.col("n_name").alias("NOM"), square.alias("geometry")), root)
    corners = to_degrees(read_geojson(spark, root)).select(
        "NOM", "srid", F.posexplode(F.flatten("geometry.coordinates")).alias("corner", "p"))
    return corners.select("NOM", "srid", "corner", F.round(F.col("p")[0], 7).alias("longitude"), F.round(F.col("p")[1], 7).alias("latitude"))


@query("sale_points_wkb")
def q_sale_points_wkb(spark, sf_dir):
    sales = serving_sales(clean_sales(raw_sales(spark, sf_dir)))
    wkb = point_wkb(F.col("longitude"), F.col("latitude"), POINT_SRID)
    return sales.select("transaction_id", "property_type", "rooms", F.hex(wkb).alias("ewkb"))


@query("layer_wkb")
def q_layer_wkb(spark, sf_dir):
    layer = polygon_layer(spark, sf_dir, "CODE_DEP", _code())
    return layer.select("CODE_DEP", F.hex(polygon_wkb(F.col("geometry.coordinates"))).alias("wkb"))


@query("sales_in_areas")
def q_sales_in_areas(spark, sf_dir):
    sales = serving_sales(clean_sales(raw_sales(spark, sf_dir))).select(
        "transaction_id", "property_type", "rooms", "longitude", "latitude")
    return points_in_areas(sales, _layer(spark, sf_dir, "CODE_DEP", _code()), "longitude", "latitude")


@query("sink_published")
def q_sink_published(spark, sf_dir):
    """Two versions are published; then a writer dies before it commits. The
    raw lines that all three writers read are joined and written once."""
    root, lines = scratch_path(spark, "published"), scratch_path(spark, "published-lines")
    write(raw_sales(spark, sf_dir), lines, format="parquet")
    raw = read(spark, lines, "parquet", schema=RAW_SALES_SCHEMA)
    publish(building_sales(sale_lines(typed_sales(raw), land=False)), root)
    publish(clean_sales(raw), root)
    stage(clean_sales(raw).limit(10), root)
    return read_published(spark, root)


# -- job ----------------------------------------------------------------------

@query("job_report")
def q_job_report(spark, sf_dir):
    job = SalesJob(spark, source=_landed_root(spark, sf_dir),
                   output=scratch_path(spark, "job-clean"))
    return report_frame(spark, run_job(job)).drop("seconds")


# -- incremental --------------------------------------------------------------

@query("stream_clean_sales")
def q_stream_clean_sales(spark, sf_dir):
    root = _landed_root(spark, sf_dir)
    out = scratch_path(spark, "stream-clean")
    clean_new_files(spark, root, out, checkpoint=scratch_path(spark, "stream-ckpt"))
    return read_cleaned(spark, out)
