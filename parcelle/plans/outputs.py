"""The outputs each collection leaves behind, written in one call: data in
the formats consumers read, plus a one-row metadata record, all under a
date-stamped partition so earlier extractions stay readable."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelle.plans.landing import dataset_metadata
from parcelle.sinks.files import nested_as_json, write_dated, write_listing
from parcelle.sources.files import list_files
from parcelle.sinks.geojson import feature_json


def save_records(records: DataFrame, root: str, source: str | None = None,
                 scope: dict | None = None) -> None:
    """Flattened records as CSV (nested values as JSON text) and JSON, and
    their metadata (count, columns, scope, source, extraction time)."""
    write_dated(nested_as_json(records), f"{root}/csv", format="csv",
                options={"header": "true"})
    write_dated(records, f"{root}/json", format="json")
    write_dated(dataset_metadata(records, source=source, scope=scope), f"{root}/metadata",
                format="json")


def save_layer(layer: DataFrame, root: str, source: str | None = None,
               scope: dict | None = None, geometry: str = "geometry") -> None:
    """Features as GeoJSON lines and the layer's metadata."""
    write_dated(layer.select(feature_json(layer, geometry).alias("value")), f"{root}/geojson",
                format="text")
    write_dated(dataset_metadata(layer.drop(geometry), source=source, scope=scope),
                f"{root}/metadata", format="json")


def save_landing(manifest: DataFrame, missing: DataFrame, landed: DataFrame,
                 root: str, scope: dict | None = None) -> None:
    """Success list (manifest), failure list (missing pairs) and the landed
    dataset's metadata."""
    write_dated(manifest, f"{root}/successful", format="json")
    write_dated(missing, f"{root}/failed", format="json")
    write_dated(dataset_metadata(landed, scope=scope), f"{root}/metadata", format="json")


def save_listing(spark: SparkSession, tree: str, root: str) -> None:
    """The files of an extracted tree as a text listing."""
    write_listing(list_files(spark, tree), tree, f"{root}/listing")
