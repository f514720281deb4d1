"""Conform a frame to an expected schema: add absent columns as typed NULLs
and project in canonical order. Works on the schema only (no data pass)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelle.schema import RAW_SALES_SCHEMA


def conform_columns(df: DataFrame, schema: T.StructType = RAW_SALES_SCHEMA,
                    keep_extra: bool = False) -> DataFrame:
    """Add every field of ``schema`` missing from ``df`` as a NULL of the
    field's type, then order the columns as in ``schema``.

    Extra columns are dropped unless ``keep_extra`` (then they follow).
    """
    present = set(df.columns)
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in present}
    out = df.withColumns(missing) if missing else df
    ordered = [f.name for f in schema.fields]
    if keep_extra:
        ordered += [c for c in df.columns if c not in set(ordered)]
    return out.select(*ordered)
