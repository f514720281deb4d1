"""Projection, binary geometry, and points in areas, against plain Python."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from parcelle.functions import lambert
from parcelle.functions.wkb import double_hex, multi_polygon_wkb, point_wkb, polygon_wkb
from parcelle.operators.spatial import points_in_areas


def forward(lon, lat):
    """Longitude and latitude to Lambert-93."""
    turn = lambert.CONE * math.radians(lon - lambert.CENTRAL_MERIDIAN)
    far = lambert.RADIUS * math.exp(-lambert.CONE * lambert._isometric(math.radians(lat)))
    return lambert.FALSE_EASTING + far * math.sin(turn), lambert.APEX - far * math.cos(turn)


def metres_apart(a, b):
    return 6.4e6 * math.hypot(math.radians(a[1] - b[1]), math.radians(a[0] - b[0]) * math.cos(math.radians(a[1])))


def degrees(spark, points):
    df = spark.createDataFrame(points, "x double, y double")
    return [tuple(r) for r in df.select(lambert.longitude(F.col("x"), F.col("y")), lambert.latitude(F.col("x"), F.col("y"))).collect()]


def test_published_constants_of_the_projection():
    """As the mapping agency prints them."""
    assert abs(lambert.CONE - 0.7256077650) < 1e-10
    assert abs(lambert.RADIUS - 11754255.426) < 1e-3 and abs(lambert.APEX - 12655612.050) < 1e-3


def test_points_of_the_whole_country_within_a_millimetre(spark):
    rng = random.Random(1)
    where = [(3.0, 46.5), (3.0, 44.0), (3.0, 49.0), (-5.15, 48.4), (9.56, 42.9), (2.35, 48.85)]
    where += [(rng.uniform(-5.5, 10), rng.uniform(41, 51.5)) for _ in range(300)]
    got = degrees(spark, [forward(*p) for p in where])
    assert max(metres_apart(a, b) for a, b in zip(where, got, strict=True)) < 1e-3
    assert metres_apart(degrees(spark, [(700000.0, 6600000.0)])[0], (3.0, 46.5)) < 1e-3   # the origin


def test_layers_of_any_nesting(spark):
    p = lambda lon, lat, *rest: [*forward(lon, lat), *rest]
    ring = [p(1, 45), p(2, 45), p(2, 46), p(1, 45)]
    kinds = {"array<double>": (p(2, 47), [2.0, 47.0]), "array<array<double>>": (ring, None), "array<array<array<double>>>": ([ring], None),
             "array<array<array<array<double>>>>": ([[ring], [ring, ring]], None)}
    for kind, (value, want) in kinds.items():
        schema = f"id int, geometry struct<type:string,coordinates:{kind}>, srid int"
        out = lambert.to_degrees(spark.createDataFrame([(1, ("T", value), 2154), (2, None, 2154)], schema)).orderBy("id").collect()
        got = out[0]["geometry"]["coordinates"]
        while isinstance(got[0], list):
            got = got[-1] if isinstance(got[0][0], list) else got[0]
            want = want or [1.0, 45.0]
        assert metres_apart(got, want) < 1e-3 and out[0]["srid"] == 4326 and out[0]["geometry"]["type"] == "T"
        assert out[1]["geometry"] is None
    high = spark.createDataFrame([(("Point", p(2, 47, 120.5)),)], "geometry struct<type:string,coordinates:array<double>>")
    assert lambert.to_degrees(high).first()["geometry"]["coordinates"][2] == 120.5
    with pytest.raises(TypeError):
        lambert.to_degrees(spark.createDataFrame([(("Point", "x"),)], "geometry struct<type:string,coordinates:string>"))


def test_doubles_as_bytes(spark):
    rng = random.Random(1)
    values = [0.0, -0.0, 1.0, -1.0, 0.1, 8.0, math.nextafter(8, 0), math.nextafter(8, 9), 5e-324, 2.0**-1022, math.nextafter(2.0**-1022, 0),
              1.7976931348623157e308, math.inf, -math.inf] + [struct.unpack(">d", rng.randbytes(8))[0] for _ in range(2000)]
    values = [v for v in values if v == v]
    df = spark.createDataFrame([(v,) for v in values], "x double").select("x", double_hex(F.col("x")).alias("h"))
    assert all(r["h"] == struct.pack(">d", r["x"]).hex().upper() for r in df.collect())
    nan = spark.range(1).select(double_hex(F.lit(math.nan)), double_hex(F.lit(None).cast("double"))).first()
    assert math.isnan(struct.unpack(">d", bytes.fromhex(nan[0]))[0]) and nan[1] is None


def parse(data):
    """Well-known binary in plain Python: (type, srid, coordinates)."""
    at = 0

    def take(form):
        nonlocal at
        out = struct.unpack_from(">" + form, data, at)
        at += struct.calcsize(">" + form)
        return out if len(out) > 1 else out[0]

    def geometry():
        assert take("B") == 0
        kind, srid = take("I"), None
        if kind & 0x20000000:
            kind, srid = kind & ~0x20000000, take("I")
        if kind == 1:
            return kind, srid, take("dd")
        if kind == 3:
            return kind, srid, [[take("dd") for _ in range(take("I"))] for _ in range(take("I"))]
        return kind, srid, [geometry() for _ in range(take("I"))]

    out = geometry()
    assert at == len(data)
    return out


RINGS = [[[0.1, 0.0], [4.0, 0.0], [4.0, 4.25], [0.1, 0.0]], [[1.0, 0.5], [2.0, 0.5], [2.0, 1.0], [1.0, 0.5]]]


def test_geometry_round_trips(spark):
    df = spark.createDataFrame([(2.35, 48.85, RINGS, [RINGS, RINGS[:1]])],
                               "x double, y double, rings array<array<array<double>>>, parts array<array<array<array<double>>>>")
    x, y, rings, parts = (F.col(c) for c in ("x", "y", "rings", "parts"))
    row = df.select(point_wkb(x, y), point_wkb(x, y, 4326), polygon_wkb(rings, 4326), multi_polygon_wkb(parts, 2154),
                    point_wkb(x, F.lit(None).cast("double")), polygon_wkb(rings)).first()
    as_pairs = lambda r: [[tuple(p) for p in ring] for ring in r]
    assert parse(row[0]) == (1, None, (2.35, 48.85)) and parse(row[1]) == (1, 4326, (2.35, 48.85))
    assert parse(row[2]) == (3, 4326, as_pairs(RINGS)) and row[4] is None
    assert parse(row[3]) == (6, 2154, [(3, None, as_pairs(RINGS)), (3, None, as_pairs(RINGS[:1]))])
    spark.conf.set("spark.sql.geospatial.enabled", "true")
    try:  # Spark reads them back
        back = spark.createDataFrame([(bytes(row[0]),), (bytes(row[5]),)], "g binary").select(
            F.expr("st_asbinary(st_geomfromwkb(g))").alias("g")).collect()
    finally:
        spark.conf.unset("spark.sql.geospatial.enabled")
    assert [parse(bytes(r["g"])) for r in back] == [parse(row[0]), parse(row[5])]


def inside(rings, x, y):
    odd = False
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:], strict=False):
            if (ay > y) != (by > y) and x < ax + (y - ay) / (by - ay) * (bx - ax):
                odd = not odd
    return odd


def star(rng, x, y, size, n=9):
    out = [[x + size * rng.uniform(0.3, 1) * math.cos(2 * math.pi * i / n), y + size * rng.uniform(0.3, 1) * math.sin(2 * math.pi * i / n)]
           for i in range(n)]
    return [*out, out[0]]


AREAS = "area int, geometry struct<type:string,coordinates:array<array<array<array<double>>>>>"


@pytest.mark.parametrize("hot", [10**9, 5])
def test_points_in_areas_equal_brute_force(spark, hot):
    rng = random.Random(4)
    shapes = []
    for i in range(30):
        x, y, size = rng.uniform(-3, 3), rng.uniform(-3, 3), 10 ** rng.uniform(-2.5, 0.7)
        shapes.append((i, [[star(rng, x, y, size), star(rng, x, y, size / 4)]] + ([[star(rng, x + 1, y, size)]] if i % 3 == 0 else [])))
    areas = spark.createDataFrame([(i, ("MultiPolygon", s)) for i, s in shapes] + [(98, None), (99, ("MultiPolygon", []))], AREAS)
    points = [(i, rng.uniform(-4, 4), rng.uniform(-4, 4)) for i in range(500)] + [(1000 + i, 0.5, 0.5) for i in range(60)]
    points += [(2000 + i, *s[0][0][i % 9]) for i, s in shapes] + [(3000, None, 1.0), (3001, math.nan, 1.0), (3002, math.inf, 0.0), (0, 0.5, 0.5)]
    df = spark.createDataFrame(points, "id int, x double, y double")
    got = sorted((r["id"], r["x"], r["area"]) for r in points_in_areas(df, areas, "x", "y", hot_points=hot).collect())
    want = sorted((i, x, a) for i, x, y in points if x is not None and math.isfinite(x)
                  for a, parts in shapes if inside([r for p in parts for r in p], x, y))
    assert got == want and len(got) > 100


def test_no_cross_join_and_no_area(spark):
    areas = spark.createDataFrame([(1, ("MultiPolygon", [[star(random.Random(1), 0, 0, 1)]]))], AREAS)
    points = spark.range(10).select(F.col("id"), (F.col("id") / 10).alias("x"), F.lit(0.0).alias("y"))
    out = points_in_areas(points, areas, "x", "y")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert out.columns == ["id", "x", "y", "area"]
    assert points_in_areas(points, areas.limit(0), "x", "y").collect() == []
    with pytest.raises(ValueError, match="both sides"):
        points_in_areas(points.withColumn("area", F.lit(1)), areas, "x", "y")
