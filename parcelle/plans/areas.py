"""Area polygons: department column detection, the department filter
cascade, and picking the layer file in an extracted tree."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from parcelle.schema import (
    DEPARTMENT_COLUMN_CANDIDATES,
    DEPARTMENT_COLUMN_HINT,
    LAYER_SUFFIXES,
    SCOPE_DEPARTMENTS,
)
from parcelle.sinks.files import below
from parcelle.sources.files import list_files


def find_department_column(columns: list[str]) -> str | None:
    """First known department column (exact name, priority order), else the
    first column whose upper-cased name contains the hint. Schema only."""
    for name in DEPARTMENT_COLUMN_CANDIDATES:
        if name in columns:
            return name
    for name in columns:
        if DEPARTMENT_COLUMN_HINT in name.upper():
            return name
    return None


def exact_match(column: str, departments: list[str]):
    return F.col(f"`{column}`").cast("string").isin(list(departments))


def prefix_match(column: str, departments: list[str]):
    text = F.col(f"`{column}`").cast("string")
    return reduce(lambda a, b: a | b, [text.startswith(d) for d in departments])


def region_filter(layer: DataFrame, departments: list[str] = SCOPE_DEPARTMENTS,
                  column: str | None = None) -> DataFrame:
    """Keep the features of the given departments, with the fallbacks:

    1. department code equal to one of ``departments`` (compared as text);
    2. if nothing matched, codes starting with one of them;
    3. if still nothing, no department column, or a column whose type cannot
       be compared with text: all rows. A failing task is an error.

    The two match counts come from one aggregation pass (two numbers to the
    driver); the chosen predicate then runs as a plain pushed filter.
    """
    col = column or find_department_column(layer.columns)
    if col is None:
        return layer
    try:
        exact, prefix = layer.agg(
            F.count_if(exact_match(col, departments)),
            F.count_if(prefix_match(col, departments)),
        ).first()
    except AnalysisException:  # a column that cannot be compared: keep everything
        return layer
    if exact:
        return layer.filter(exact_match(col, departments))
    if prefix:
        return layer.filter(prefix_match(col, departments))
    return layer


def layer_files(spark: SparkSession, root: str, suffixes: list[str] = LAYER_SUFFIXES) -> DataFrame:
    """Files of the tree whose lower-cased path ends with a layer suffix."""
    files = list_files(spark, root)
    lowered = F.lower(F.col("path"))
    return files.filter(reduce(lambda a, b: a | b, [lowered.endswith(s.lower()) for s in suffixes]))


def find_layer_file(spark: SparkSession, root: str, suffixes: list[str] = LAYER_SUFFIXES) -> DataFrame:
    """One row: the first layer file by path order (deterministic), and its
    path below ``root``."""
    return layer_files(spark, root, suffixes).agg(F.min("path").alias("path")).filter(
        F.col("path").isNotNull()).withColumn("relative", below(F.col("path"), root))


def layer_file_path(spark: SparkSession, root: str, suffixes: list[str] = LAYER_SUFFIXES) -> str:
    """The layer file's path; raises when the tree holds none."""
    rows = find_layer_file(spark, root, suffixes).collect()
    if not rows:
        raise FileNotFoundError(f"no {' or '.join(suffixes)} file under {root}")
    return rows[0]["path"]
