"""Per-sale aggregation: several raw lines of one sale become one row.

Buildings group by the sale plus its property type and rooms (one sale can
give several building rows, each with the full price); land groups by the
sale alone and lists its land uses. Both kinds go through one aggregation
over one read of the lines: a land line has a NULL type and NULL rooms, so
the building key reduces to the land key for it.

Sums and means are exact integer sums (``functions.exact_sum``), so the same
lines give the same bits under any partitioning. Only algebraic aggregates
(sum, max, count) cross the shuffle, so Spark combines them map-side: a sale holding a third of all lines is reduced to
one partial row per input partition before anything moves.

The land-use list is the one holistic aggregate. It is built in two levels:
lines are first counted per (sale, land use) — also map-side combined — and
only the short list of distinct (land use, count) pairs is collected per
sale. The full list (duplicates kept, NULLs skipped, sorted) is expanded
from those pairs in the final projection; no task buffers the raw lines of
a hot sale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelle.functions.exact_sum import mean, merged, partial, total
from parcelle.functions.typing import ratio
from parcelle.schema import BUILDING_KEYS, CLEAN_COLUMNS, LAND_KEYS, LAND_TYPE_LABEL

SALE_KEYS = BUILDING_KEYS  # land lines carry NULL type and rooms


def expand_counts(pairs: str = "_natures") -> Column:
    """Sorted list with duplicates from an array of (value, n) structs."""
    return F.flatten(
        F.transform(
            F.array_sort(F.col(pairs)),
            lambda p: F.array_repeat(p["value"], p["n"].cast("int")),
        )
    )


SUMMED = {"_bati": "surface_reelle_bati", "_terrain_sum": "surface_terrain", "_lon": "longitude", "_lat": "latitude"}


def _per_sale(lines: DataFrame, natures: bool) -> DataFrame:
    sums = [part for name, column in SUMMED.items() for part in partial(column, name)]
    if natures:
        lines = lines.groupBy(*SALE_KEYS, "nature_culture").agg(
            *sums, F.max("surface_terrain").alias("surface_terrain"), F.count(F.lit(1)).alias("_lines"))
        sums = [part for name in SUMMED for part in merged(name)]
        pair = F.struct(F.col("nature_culture").alias("value"), F.col("_lines").alias("n"))
        listed = [F.collect_list(F.when(F.col("nature_culture").isNotNull(), pair)).alias("_natures")]
    else:
        listed = [F.first(F.lit(None).cast("array<struct<value:string,n:bigint>>")).alias("_natures")]
    per_sale = lines.groupBy(*SALE_KEYS).agg(*sums, F.max("surface_terrain").alias("_terrain_max"), *listed)
    return per_sale.select(
        *SALE_KEYS, total("_bati").alias("_bati"), "_terrain_max", total("_terrain_sum").alias("_terrain_sum"),
        mean("_lon").alias("longitude"), mean("_lat").alias("latitude"), "_natures")


def aggregate_sales(lines: DataFrame, natures: bool = True,
                    natures_as: str = "list") -> DataFrame:
    """Cleansed sales (canonical 16 columns) from ``sale_lines`` output.

    Buildings: summed built surface (also as ``surface_reelle_bati``), the
    largest land surface, price per m2 on the summed surface. Land: summed
    land surface (also as ``surface_terrain``), land-use list, type
    ``terrain``, price per m2 on the summed land. Coordinates are averaged.
    ``natures=False`` (building lines only) skips the list level.

    ``natures_as="counts"`` keeps the land uses as sorted (value, n) pairs
    instead of the expanded list: the same information, bounded by the
    number of distinct uses even for a sale with billions of lines.
    """
    if natures_as not in ("list", "counts"):
        raise ValueError("natures_as is 'list' or 'counts'")
    listed = expand_counts("_natures") if natures_as == "list" else F.array_sort("_natures")
    land = F.col("type_local").isNull()
    per_sale = _per_sale(lines, natures)
    out = per_sale.withColumns({
        "type_local": F.coalesce(F.col("type_local"), F.lit(LAND_TYPE_LABEL)),
        "surface_totale_bati": F.when(~land, F.col("_bati")),
        "surface_reelle_bati": F.when(~land, F.col("_bati")),
        "surface_terrain": F.when(land, F.col("_terrain_sum")).otherwise(F.col("_terrain_max")),
        "surface_totale_terrain": F.when(land, F.col("_terrain_sum")),
        "natures_culture": F.when(land, listed),
        "prix_m2": ratio("valeur_fonciere",
                         F.when(land, F.col("_terrain_sum")).otherwise(F.col("_bati"))),
    })
    return out.select(*CLEAN_COLUMNS)


BUILDING_SALE_COLUMNS = BUILDING_KEYS + [
    "surface_totale_bati", "surface_terrain", "longitude", "latitude", "prix_m2",
    "surface_reelle_bati",
]
LAND_SALE_COLUMNS = LAND_KEYS + [
    "surface_totale_terrain", "longitude", "latitude", "natures_culture", "prix_m2",
    "type_local", "surface_reelle_bati", "surface_terrain",
]


def building_sales(lines: DataFrame) -> DataFrame:
    """Aggregated building sales from building ``sale_lines``."""
    return aggregate_sales(lines, natures=False).select(*BUILDING_SALE_COLUMNS)


def land_sales(lines: DataFrame) -> DataFrame:
    """Aggregated land sales from land ``sale_lines``."""
    return aggregate_sales(lines, natures=True).select(*LAND_SALE_COLUMNS)
