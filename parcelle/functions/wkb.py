"""Points and polygons as well-known binary, built from column functions.

Big-endian WKB, and EWKB where a reference system is given. Spark cannot cast
a double to its eight bytes, so they are computed: exponent and fraction by
exact scaling with powers of two.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Geometry type codes, and the flag of a reference system.
POINT, POLYGON, MULTI_POLYGON = 1, 3, 6
HAS_SRID = 0x20000000
_SUBNORMAL = 2.0**537
_SIGN = -(1 << 63)


def _two(power: Column) -> Column:
    return F.pow(F.lit(2.0), power)


def double_hex(value: Column) -> Column:
    """The IEEE 754 bytes of a double, most significant first, in hex."""
    size = F.abs(value)
    near = F.floor(F.log2(size))
    # The logarithm rounds: it may be one off next to a power of two.
    power = F.when(size >= _two(near + 1), near + 1).when(size < _two(near), near - 1).otherwise(near)
    power = F.least(F.greatest(power, F.lit(-1022)), F.lit(1023))
    fraction = ((size * _two(-power) - 1) * float(1 << 52)).cast("long")
    normal = (power + 1023) * (1 << 52) + fraction
    tiny = (size * _SUBNORMAL * _SUBNORMAL).cast("long")
    bits = (
        F.when(size == 0, F.lit(0).cast("long")).when(size < 2.0**-1022, tiny)
        .when(size == float("inf"), F.lit(0x7FF << 52)).otherwise(normal.cast("long"))
    )
    negative = (value < 0) | ((value == 0) & value.cast("string").startswith("-"))  # -0.0, too
    signed = F.when(negative, bits.bitwiseOR(F.lit(_SIGN).cast("long"))).otherwise(bits)
    return F.when(F.isnan(value), F.lit("7FF8000000000000")).otherwise(F.lpad(F.hex(signed), 16, "0"))


def _int_hex(value: Column) -> Column:
    return F.lpad(F.hex(value.cast("long")), 8, "0")


def _head(kind: int, srid: int | None) -> Column:
    return F.lit(f"00{kind | (HAS_SRID if srid else 0):08X}" + (f"{srid:08X}" if srid else ""))


def point_wkb(x: Column, y: Column, srid: int | None = None) -> Column:
    """A point; NULL if a coordinate is."""
    return F.unhex(F.concat(_head(POINT, srid), double_hex(x), double_hex(y)))


def _rings(rings: Column) -> Column:
    points = lambda ring: F.array_join(F.transform(ring, lambda p: F.concat(double_hex(p[0]), double_hex(p[1]))), "")
    return F.concat(_int_hex(F.size(rings)), F.array_join(F.transform(rings, lambda r: F.concat(_int_hex(F.size(r)), points(r))), ""))


def polygon_wkb(rings: Column, srid: int | None = None) -> Column:
    """A polygon from GeoJSON coordinates (arrays of rings of positions);
    only x and y are kept."""
    return F.unhex(F.concat(_head(POLYGON, srid), _rings(rings)))


def multi_polygon_wkb(polygons: Column, srid: int | None = None) -> Column:
    """A multi-polygon from GeoJSON coordinates; only the whole carries the
    reference system."""
    parts = F.transform(polygons, lambda rings: F.concat(_head(POLYGON, None), _rings(rings)))
    return F.unhex(F.concat(_head(MULTI_POLYGON, srid), _int_hex(F.size(polygons)), F.array_join(parts, "")))
