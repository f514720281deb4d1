"""Row filters of the cleaning job.

All are plain Column predicates, so Catalyst merges consecutive filters into
one and pushes the null checks into the Parquet scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelle.functions.typing import normalise_text, ratio
from parcelle.schema import BUILDING_PRICE_M2_BOUNDS, LAND_KEYS, LAND_PRICE_M2_BOUNDS


def is_building() -> Column:
    return F.col("type_local").isNotNull()


def split_buildings(typed: DataFrame) -> DataFrame:
    """Lines describing a building (a property type is given)."""
    return typed.filter(is_building())


def split_land(typed: DataFrame) -> DataFrame:
    """Lines describing bare land (no property type)."""
    return typed.filter(~is_building())


def all_present(*columns: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Keep rows where every named column is non-NULL."""
    return df.filter(all_present(*columns))


def within(c: Column | str, bounds: tuple[float, float]) -> Column:
    """Inclusive range test; NULL (no ratio) counts as outside."""
    col = F.col(c) if isinstance(c, str) else c
    return col.between(bounds[0], bounds[1])


def building_line_ok() -> Column:
    """A building line with price and built surface whose per-line price per
    m2 (whole sale price over this line's surface) is inside the bounds.
    The test is per raw line, before lines are summed: it decides which
    lines count."""
    return (is_building() & all_present("valeur_fonciere", "surface_reelle_bati")
            & within(ratio("valeur_fonciere", "surface_reelle_bati"), BUILDING_PRICE_M2_BOUNDS))


def land_line_ok() -> Column:
    """A land line with price and land surface, price per m2 in bounds."""
    return (~is_building() & all_present("valeur_fonciere", "surface_terrain")
            & within(ratio("valeur_fonciere", "surface_terrain"), LAND_PRICE_M2_BOUNDS))


def prepare_buildings(typed: DataFrame) -> DataFrame:
    """Kept building lines, type normalised, with their price per m2."""
    return typed.filter(building_line_ok()).withColumns({
        "type_local": normalise_text("type_local"),
        "prix_m2": ratio("valeur_fonciere", "surface_reelle_bati"),
    })


def prepare_land(typed: DataFrame) -> DataFrame:
    """Kept land lines, land use normalised, with their price per m2."""
    return typed.filter(land_line_ok()).withColumns({
        "nature_culture": normalise_text("nature_culture"),
        "prix_m2_terrain": ratio("valeur_fonciere", "surface_terrain"),
    })


def sale_lines(typed: DataFrame, buildings: bool = True, land: bool = True) -> DataFrame:
    """Kept lines of the chosen kinds in one pass, on a common shape:

    ``type_local`` normalised (NULL marks land), rooms only for buildings,
    ``nature_culture`` normalised only for land, built surface only for
    buildings. One filter and one projection over a single read of the
    source, whatever the kinds.
    """
    conds = ([building_line_ok()] if buildings else []) + ([land_line_ok()] if land else [])
    if not conds:
        raise ValueError("choose buildings, land or both")
    b = is_building()
    return typed.filter(reduce(lambda x, y: x | y, conds)).select(
        *LAND_KEYS,
        normalise_text("type_local").alias("type_local"),
        F.when(b, F.col("nombre_pieces_principales")).alias("nombre_pieces_principales"),
        F.when(~b, normalise_text("nature_culture")).alias("nature_culture"),
        F.when(b, F.col("surface_reelle_bati")).alias("surface_reelle_bati"),
        "surface_terrain",
        "longitude",
        "latitude",
    )


def required_fields(typed: DataFrame) -> DataFrame:
    """Lines of either kind that carry the fields their kind needs, tagged
    with their branch ("building" / "land")."""
    building = is_building() & all_present("valeur_fonciere", "surface_reelle_bati")
    land = ~is_building() & all_present("valeur_fonciere", "surface_terrain")
    return typed.filter(building | land).withColumn(
        "branch", F.when(is_building(), F.lit("building")).otherwise(F.lit("land"))
    )
