"""The cleaning job as one lazy plan: raw sale lines -> cleansed sales ->
serving table with point geometry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.functions.typing import ewkt_point, type_sales
from parcelle.operators.aggregate import aggregate_sales
from parcelle.operators.conform import conform_columns
from parcelle.operators.filters import sale_lines
from parcelle.schema import RAW_SALES_SCHEMA, SERVING_COLUMNS


def typed_sales(raw: DataFrame) -> DataFrame:
    """Raw lines conformed to the full raw schema, then typed."""
    return type_sales(conform_columns(raw, RAW_SALES_SCHEMA))


def clean_sales(raw: DataFrame, natures_as: str = "list") -> DataFrame:
    """Cleansed sales: aggregated buildings and aggregated land in one table
    (columns a kind lacks are NULL), canonical order.

    One read of the source feeds both kinds: a single filter and a single
    two-level aggregation, instead of two branches each re-reading (and,
    over the driver tables, re-joining) the raw lines. ``natures_as`` picks
    the land-use list (default) or its compact (value, n) form.
    """
    return aggregate_sales(sale_lines(typed_sales(raw)), natures_as=natures_as)


def serving_sales(clean: DataFrame) -> DataFrame:
    """Rename to the serving schema of table ``transactions``."""
    return clean.select(*[F.col(src).alias(dst) for src, dst in SERVING_COLUMNS])


def sale_points(serving: DataFrame) -> DataFrame:
    """Add ``coordinates`` (EWKT point) when both coordinates exist in the
    schema; decided at plan time from the column list."""
    if {"longitude", "latitude"} <= set(serving.columns):
        return serving.withColumn("coordinates", ewkt_point("longitude", "latitude"))
    return serving
