"""Points in areas: an equi-join on grid cells, then a ray test.

An area is entered under the cells that its bounding box touches, on the grid
level where that is at most ``SPAN`` + 1 cells a side, so a large area has no
more cells than a small one. A point has one cell on each level that the layer
uses. Cells with over ``HOT_POINTS`` points are split into parts by a hash of
the points' columns, with the areas of these cells entered under each part. What the cells bring
together is tested exactly with column functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPAN = 8
HOT_POINTS = 1_000_000


def rings_of(geometry: Column, kind: T.StructType) -> Column:
    """All rings of a (multi-)polygon's GeoJSON coordinates; under the
    even-odd rule holes and parts need no telling apart."""
    depth, inner = 0, kind["coordinates"].dataType
    while isinstance(inner, T.ArrayType):
        depth, inner = depth + 1, inner.elementType
    if depth not in (3, 4):
        raise TypeError("coordinates are those of polygons or multi-polygons")
    found = geometry["coordinates"].cast("array<" * depth + "double" + ">" * depth)
    return F.flatten(found) if depth == 4 else found


def contains(rings: Column, x: Column, y: Column) -> Column:
    """Whether a ray from the point crosses the rings an odd number of times.
    Of an axis-parallel box the lower and left sides count as inside."""
    def crossings(ring: Column) -> Column:
        def crosses(a: Column, b: Column) -> Column:
            at = a[0] + (y - a[1]) / F.when(b[1] != a[1], b[1] - a[1]) * (b[0] - a[0])
            return F.coalesce(((a[1] > y) != (b[1] > y)) & (x < at), F.lit(False)).cast("int")

        edges = F.zip_with(F.slice(ring, 1, F.size(ring) - 1), F.slice(ring, 2, F.size(ring) - 1), crosses)
        return F.aggregate(edges, F.lit(0), lambda s, e: s + e)

    return F.aggregate(F.transform(F.filter(rings, lambda r: F.size(r) > 1), crossings), F.lit(0), lambda s, e: s + e) % 2 == 1


def _cell(value: Column, level: Column) -> Column:
    return F.floor(value * F.pow(F.lit(2.0), -level)).cast("long")


def points_in_areas(points: DataFrame, areas: DataFrame, x: str, y: str, geometry: str = "geometry",
                    hot_points: int = HOT_POINTS) -> DataFrame:
    """Every point with every area that holds it: the points' columns, then
    the areas' other columns. Points without finite coordinates and points in
    no area have no row; a NULL or empty area holds none."""
    rings = rings_of(F.col(geometry), areas.schema[geometry].dataType)
    clash = set(points.columns) & (set(areas.columns) - {geometry})
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    corners = F.flatten("__rings")
    axis = lambda i: F.transform(corners, lambda p: p[i])
    boxes = areas.withColumn("__rings", rings).withColumns({
        "__x0": F.array_min(axis(0)), "__x1": F.array_max(axis(0)), "__y0": F.array_min(axis(1)), "__y1": F.array_max(axis(1))})
    side = F.greatest(F.col("__x1") - F.col("__x0"), F.col("__y1") - F.col("__y0"), F.lit(2.0**-40)) / SPAN
    boxes = boxes.where("__x0 is not null").withColumn("__level", F.ceil(F.log2(side)).cast("int"))
    span = lambda lo, hi: F.explode(F.sequence(_cell(F.col(lo), F.col("__level")), _cell(F.col(hi), F.col("__level"))))
    cells = boxes.withColumn("__cx", span("__x0", "__x1")).withColumn("__cy", span("__y0", "__y1"))

    levels = sorted(r[0] for r in boxes.select("__level").distinct().collect())  # at most one per power of two
    finite = points.where(F.abs(F.col(x)) < float("inf")).where(F.abs(F.col(y)) < float("inf"))
    placed = finite.withColumn("__level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>"))).withColumns({
        "__cx": _cell(F.col(x), F.col("__level")), "__cy": _cell(F.col(y), F.col("__level"))})
    key = ["__level", "__cx", "__cy"]
    hot = placed.groupBy(*key).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > hot_points)
    hot = hot.select(*key, F.ceil(F.col("__n") / hot_points).cast("int").alias("__parts"))
    parts = F.coalesce("__parts", F.lit(1))
    cells = cells.join(hot, key, "left").withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("__parts")
    # By content, not by chance: a task that runs again deals its rows alike.
    content = [F.col(c) for c in points.columns if "map<" not in points.schema[c].dataType.simpleString()]
    spread = F.pmod(F.xxhash64(*content), parts).cast("int")
    placed = placed.join(F.broadcast(hot), key, "left").withColumn("__part", spread).drop("__parts")
    met = placed.join(cells.drop("__x0", "__x1", "__y0", "__y1", geometry), [*key, "__part"])
    return met.where(contains(F.col("__rings"), F.col(x), F.col(y))).drop(*key, "__part", "__rings")

