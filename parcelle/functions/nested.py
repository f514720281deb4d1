"""Nested JSON helpers: schema inference over a whole text column and
flattening of structs into dotted columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def infer_json_schema(df: DataFrame, column: str) -> str:
    """DDL schema merged over every row of a JSON text column.

    Parsing to VARIANT and merging with ``schema_of_variant_agg`` is one
    distributed aggregation (partial per task, merge of small schema
    strings); only the final schema string reaches the driver.
    """
    ddl = df.select(F.schema_of_variant_agg(F.try_parse_json(F.col(column))).alias("s")).first()["s"]
    return variant_ddl_to_struct(ddl)


def variant_ddl_to_struct(ddl: str) -> str:
    """``OBJECT<k: BIGINT>`` -> ``STRUCT<k: BIGINT>`` (from_json DDL)."""
    keys = re.split(r"(`(?:[^`]|``)*`)", ddl)  # quoted key names stay as they are
    return "".join(k if i % 2 else re.sub(r"\bOBJECT<", "STRUCT<", k) for i, k in enumerate(keys))


def parse_json_column(df: DataFrame, column: str, schema: str | T.DataType | None = None) -> DataFrame:
    """Replace a JSON text column by its parsed struct (schema inferred over
    the whole column when not given). A malformed text becomes NULL; the row
    stays."""
    s = schema if schema is not None else infer_json_schema(df, column)
    return df.withColumn(column, F.from_json(F.col(column), s))


def _leaves(dtype: T.StructType, path: tuple[str, ...]) -> list[tuple[str, Column]]:
    out: list[tuple[str, Column]] = []
    for f in dtype.fields:
        at = (*path, f.name)
        if isinstance(f.dataType, T.StructType) and f.dataType.fields:
            out += _leaves(f.dataType, at)
        else:
            quoted = ".".join("`" + p.replace("`", "``") + "`" for p in at)
            out.append((".".join(at), F.col(quoted)))
    return out


def flatten(df: DataFrame) -> DataFrame:
    """Structs become dotted leaf columns (``geo.region_key``); arrays and
    scalars stay whole. Schema-only work, one projection."""
    return df.select(*[c.alias(name) for name, c in _leaves(df.schema, ())])
