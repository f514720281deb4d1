"""Lambert-93 (EPSG:2154) to longitude and latitude (EPSG:4326), in closed
form with column functions.

Inverse of the Lambert conformal conic with two standard parallels on GRS80:
the angle around the apex gives the longitude, the distance from it the
isometric latitude, and the conformal latitude becomes the geodetic one by its
series in the eccentricity (to e^8, under 0.1 mm). No iteration, no library,
no Python per row. RGF93 and WGS84 are taken as one datum, as is usual.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SOURCE_SRID, TARGET_SRID = 2154, 4326

# GRS80 and the projection's parameters (degrees, metres).
SEMI_MAJOR = 6378137.0
INVERSE_FLATTENING = 298.257222101
CENTRAL_MERIDIAN, LATITUDE_OF_ORIGIN = 3.0, 46.5
PARALLELS = (44.0, 49.0)
FALSE_EASTING, FALSE_NORTHING = 700000.0, 6600000.0

E2 = 2 / INVERSE_FLATTENING - 1 / INVERSE_FLATTENING**2
E = math.sqrt(E2)


def _isometric(lat: float) -> float:
    return math.asinh(math.tan(lat)) - E * math.atanh(E * math.sin(lat))


def _cone() -> tuple[float, float, float]:
    """Cone constant, its radius at the equator, northing of the apex."""
    first, second = (math.radians(p) for p in PARALLELS)
    width = lambda lat: SEMI_MAJOR * math.cos(lat) / math.sqrt(1 - E2 * math.sin(lat) ** 2)
    n = math.log(width(second) / width(first)) / (_isometric(first) - _isometric(second))
    radius = width(first) * math.exp(n * _isometric(first)) / n
    return n, radius, FALSE_NORTHING + radius * math.exp(-n * _isometric(math.radians(LATITUDE_OF_ORIGIN)))


CONE, RADIUS, APEX = _cone()
#: The series from conformal to geodetic latitude, by sin(2k x).
SERIES = (
    E2 / 2 + 5 * E2**2 / 24 + E2**3 / 12 + 13 * E2**4 / 360,
    7 * E2**2 / 48 + 29 * E2**3 / 240 + 811 * E2**4 / 11520,
    7 * E2**3 / 120 + 81 * E2**4 / 1120,
    4279 * E2**4 / 161280,
)


def longitude(x: Column, y: Column) -> Column:
    return F.lit(CENTRAL_MERIDIAN) + F.degrees(F.atan2(x - FALSE_EASTING, F.lit(APEX) - y) / CONE)


def latitude(x: Column, y: Column) -> Column:
    far = F.sqrt((x - FALSE_EASTING) * (x - FALSE_EASTING) + (F.lit(APEX) - y) * (F.lit(APEX) - y))
    conformal = F.atan(F.sinh(-F.log(far / RADIUS) / CONE))
    out = conformal
    for k, factor in enumerate(SERIES, 1):
        out = out + factor * F.sin(2 * k * conformal)
    return F.degrees(out)


def position(p: Column) -> Column:
    """A GeoJSON position [x, y, ...]; what follows is kept."""
    x, y = F.get(p, F.lit(0)), F.get(p, F.lit(1))
    flat = F.array(longitude(x, y), latitude(x, y))
    return F.when(p.isNotNull(), F.concat(flat, F.slice(p, 3, F.greatest(F.size(p) - 2, F.lit(0)))))


def coordinates(c: Column, kind: T.DataType) -> Column:
    """Coordinates nested to any depth: a position, or arrays of such."""
    if not isinstance(kind, T.ArrayType):
        raise TypeError(f"coordinates are arrays of numbers, not {kind.simpleString()}")
    if isinstance(kind.elementType, T.ArrayType):
        return F.transform(c, lambda inner: coordinates(inner, kind.elementType))
    return position(c.cast("array<double>"))


def to_degrees(layer: DataFrame, geometry: str = "geometry") -> DataFrame:
    """A layer in Lambert-93 metres in degrees, with its ``srid``. A NULL
    geometry stays NULL."""
    kind = layer.schema[geometry].dataType
    moved = coordinates(F.col(geometry)["coordinates"], kind["coordinates"].dataType)
    return layer.withColumn(geometry, F.when(F.col(geometry).isNotNull(), F.col(geometry).withField("coordinates", moved))).withColumn(
        "srid", F.lit(TARGET_SRID))
