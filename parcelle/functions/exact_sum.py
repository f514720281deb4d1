"""Sums and means of doubles that do not depend on the order of rows.

Floating-point addition rounds after every step, so the last bits of a plain
``sum`` change with partitioning, with retries and with skew splitting. Here
every value is cut, without rounding, into integers: the whole part, and the
first and the second 32 binary digits behind the point. Integer sums are exact
in any order and combine map-side like any sum; the double is formed once, from
the exact totals. Digits beyond the 64th behind the point are cut off each
value (2^-64, about 5e-20), which does not depend on order either.

NULLs are skipped; a group without values is NULL. NaN and infinite values
decide the result as in a plain sum. Values of 2^62 or more are added plainly
(and with them the order counts again). A whole part's total beyond 64 bits is
an error, as for any integer sum.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = 32
_SCALE = float(1 << DIGITS)
_MASK = (1 << DIGITS) - 1
_LIMIT = float(1 << 62)

PARTS = ("whole", "high", "low", "odd", "n")


def parts(value: Column | str) -> dict[str, Column]:
    """What is to be summed for a value, by part."""
    x = F.col(value) if isinstance(value, str) else value
    x = x.cast("double")
    # NULL for a value that is no such number, so that no part counts it.
    plain = F.when(F.abs(x) < _LIMIT, x)
    whole = plain.cast("long")
    rest = (plain - whole.cast("double")) * _SCALE
    high = rest.cast("long")
    low = ((rest - high.cast("double")) * _SCALE).cast("long")
    odd = F.when(x.isNotNull() & (F.isnan(x) | (F.abs(x) >= _LIMIT)), x)
    return {"whole": whole, "high": high, "low": low, "odd": odd, "n": x}


def partial(value: Column | str, name: str) -> list[Column]:
    """The aggregates of a value, named after ``name``; ``merged`` sums them
    again, ``total`` and ``mean`` read them."""
    found = parts(value)
    return [*(F.sum(found[p]).alias(f"{name}_{p}") for p in PARTS[:-1]), F.count(found["n"]).alias(f"{name}_n")]


def merged(name: str) -> list[Column]:
    """The aggregates of several groups' aggregates."""
    return [F.sum(f"{name}_{p}").alias(f"{name}_{p}") for p in PARTS]


def total(name: str) -> Column:
    """The sum, from its aggregates."""
    whole, high, low = (F.coalesce(F.col(f"{name}_{p}"), F.lit(0)).cast("long") for p in PARTS[:3])

    def magnitude(sign: int) -> tuple[Column, Column]:
        """Digits of the total times ``sign``, carried: whole part (may be
        negative, then the sign is wrong) and the rest."""
        lower = sign * low
        middle = sign * high + F.shiftright(lower, DIGITS)
        upper = sign * whole + F.shiftright(middle, DIGITS)
        mask = F.lit(_MASK).cast("long")
        digits = middle.bitwiseAND(mask).cast("double") / _SCALE + lower.bitwiseAND(mask).cast("double") / _SCALE / _SCALE
        return upper, upper.cast("double") + digits

    upper, positive = magnitude(1)
    exact = F.when(upper >= 0, positive).otherwise(-magnitude(-1)[1])
    odd = F.col(f"{name}_odd")
    return F.when(F.col(f"{name}_n") > 0, F.when(odd.isNull(), exact).otherwise(odd + exact))


def mean(name: str) -> Column:
    """The sum divided by the number of values."""
    return F.try_divide(total(name), F.col(f"{name}_n"))
