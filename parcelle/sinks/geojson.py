"""GeoJSON sink: one Feature per line (GeoJSON text sequence)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def feature_json(df: DataFrame, geometry: str = "geometry") -> Column:
    props = [c for c in df.columns if c != geometry]
    return F.to_json(F.struct(
        F.lit("Feature").alias("type"),
        F.col(geometry).alias("geometry"),
        F.struct(*[F.col(f"`{c}`") for c in props]).alias("properties"),
    ))


def write_geojson(df: DataFrame, path: str, geometry: str = "geometry",
                  mode: str = "overwrite") -> None:
    """Write features as text, one Feature object per line; every task
    writes its own part (no single-file collection through one task)."""
    df.select(feature_json(df, geometry).alias("value")).write.mode(mode).text(path)
