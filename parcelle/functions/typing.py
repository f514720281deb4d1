"""Text-to-type conversion and small derived columns.

Raw values are text that may be unusable ("null", "12,5", "15/01/2023", a
zero surface). Spark 4 runs ANSI by default, where a plain cast or division
raises on such values; the ``try_`` family returns NULL instead, which is
what a cleaning job needs, without turning ANSI off for the whole session.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelle.schema import DATE_FORMAT, POINT_SRID, TYPED_COLUMNS


def to_date_or_null(c: Column | str, fmt: str = DATE_FORMAT) -> Column:
    return F.try_to_date(F.col(c) if isinstance(c, str) else c, fmt)


def normalise_text(c: Column | str) -> Column:
    """Trim surrounding spaces and lower-case."""
    return F.lower(F.trim(F.col(c) if isinstance(c, str) else c))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """numerator / denominator, NULL when either is NULL or the divisor is 0."""
    n = F.col(numerator) if isinstance(numerator, str) else numerator
    d = F.col(denominator) if isinstance(denominator, str) else denominator
    return F.try_divide(n, d)


def type_sales(raw: DataFrame) -> DataFrame:
    """Convert the numeric and date columns of raw sale lines in one projection.

    Columns absent from ``raw`` are left alone (see ``conform_columns``).
    """
    conversions = {
        name: F.col(name).try_cast(dtype)
        for name, dtype in TYPED_COLUMNS.items()
        if name in raw.columns
    }
    if "date_mutation" in raw.columns:
        conversions["date_mutation"] = to_date_or_null("date_mutation")
    return raw.withColumns(conversions)


def ewkt_point(lon: Column | str, lat: Column | str, srid: int = POINT_SRID) -> Column:
    """Extended WKT point ``SRID=4326;POINT(lon lat)``; NULL if a coordinate is.

    PostGIS reads EWKT text into a geometry column; Spark has no point
    constructor, so the geometry travels as text.
    """
    x = F.col(lon) if isinstance(lon, str) else lon
    y = F.col(lat) if isinstance(lat, str) else lat
    return F.concat(
        F.lit(f"SRID={srid};POINT("), x.cast("string"), F.lit(" "), y.cast("string"), F.lit(")")
    )
