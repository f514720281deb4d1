"""Sums that do not depend on order, against exact fractions."""

import math
import random
from fractions import Fraction
from functools import reduce
from operator import add

import pytest
from pyspark.sql import functions as F

from parcelle.functions.exact_sum import mean, merged, partial, total
from parcelle.operators.aggregate import building_sales, land_sales
from parcelle.operators.filters import sale_lines
from parcelle.plans.clean import typed_sales
from parcelle.sources.adapter import raw_sales


def summed(spark, rows, partitions=4, levels=1):
    df = spark.createDataFrame(rows, "k int, x double").repartition(partitions)
    if levels == 2:
        parts = df.groupBy("k", F.spark_partition_id().alias("p")).agg(*partial("x", "s")).groupBy("k").agg(*merged("s"))
    else:
        parts = df.groupBy("k").agg(*partial("x", "s"))
    return {r["k"]: (r["t"], r["m"]) for r in parts.select("k", total("s").alias("t"), mean("s").alias("m")).collect()}


def bits(value):
    return None if value is None else value.hex() if not math.isnan(value) else "nan"


def cut(x):
    """A value without the digits beyond the 64th behind the point."""
    return Fraction(int(Fraction(x) * 2**64), 2**64)


@pytest.mark.parametrize("seed", range(3))
def test_equals_exact_fractions(spark, seed):
    rng = random.Random(seed)
    draw = [lambda: rng.uniform(-5, 5), lambda: rng.uniform(-1, 1) * 10 ** rng.randint(-12, 15), lambda: rng.choice([0.1, -0.1, 0.3]),
            lambda: rng.uniform(0, 1) * 2.0**-50]
    rows = [(k, draw[k % 4]()) for k in range(8) for _ in range(rng.randint(1, 400))]
    got = summed(spark, rows, levels=1 + seed % 2)
    for k in range(8):
        own = [x for j, x in rows if j == k]
        want = float(sum(map(cut, own)))
        assert math.isclose(got[k][0], want, rel_tol=2**-52, abs_tol=0), (k, got[k][0], want)
        assert got[k][1] == got[k][0] / len(own)


def test_same_bits_in_any_order(spark):
    rng = random.Random(7)
    rows = [(0, rng.uniform(-5, 52) * 10 ** rng.randint(-6, 6)) for _ in range(5000)]
    plain, exact = set(), set()
    for partitions in (1, 3, 8, 16):
        rng.shuffle(rows)
        exact.add(tuple(map(bits, summed(spark, rows, partitions, levels=1 + partitions % 2)[0])))
        plain.add(reduce(add, (x for _, x in rows)))   # the built-in sum compensates
    assert len(exact) == 1 and len(plain) > 1


def test_cancelling_and_tiny_totals(spark):
    rows = [(0, 1e15), (0, 0.1), (0, -1e15), (1, 2.0**-60), (1, -(2.0**-59)), (2, -0.5), (2, 0.25), (3, 0.0), (3, -0.0),
            (4, 2.0**-70), (5, -1.0), (5, 2.0**-53), (6, float(2**61)), (6, -0.5)]
    got = summed(spark, rows)
    assert got[0][0] == float(cut(0.1)) and got[1][0] == -(2.0**-60) and got[2][0] == -0.25 and got[3][0] == 0.0
    assert got[4][0] == 0.0 and got[5][0] == -1.0 + 2.0**-53 and got[6][0] == float(2**61)


def test_nulls_and_values_that_are_no_numbers(spark):
    inf, nan = math.inf, math.nan
    rows = [(0, None), (1, None), (1, 2.5), (2, inf), (2, 1.0), (3, inf), (3, -inf), (4, nan), (4, 1.0), (5, 1e300), (5, 1.0), (6, -inf)]
    got = {k: tuple(map(bits, v)) for k, v in summed(spark, rows).items()}
    assert got[0] == (None, None) and got[1] == (bits(2.5), bits(2.5))
    assert got[2][0] == bits(inf) and got[3][0] == "nan" and got[4][0] == "nan" and got[5][0] == bits(1e300) and got[6][0] == bits(-inf)


def test_sales_are_the_same_under_any_partitioning(spark, sf_small):
    """Surfaces and coordinates that are not on a binary grid."""
    raw = raw_sales(spark, sf_small)
    off = F.pmod(F.xxhash64("id_mutation", "nature_culture", "surface_terrain"), F.lit(99_991)) / 99_991.0
    raw = raw.withColumns({c: (F.col(c).cast("double") + off).cast("string") for c in (
        "surface_reelle_bati", "surface_terrain", "longitude", "latitude")}).where("valeur_fonciere <> 'null'")
    seen = set()
    for n in (1, 7, 32):
        lines = typed_sales(raw.repartition(n, F.rand(n)))
        out = [building_sales(sale_lines(lines, land=False)), land_sales(sale_lines(lines, buildings=False))]
        sums = [df.agg(F.count("*"), F.sum(F.xxhash64(*[F.col(c) for c in df.columns]).cast("decimal(38,0)"))).first() for df in out]
        seen.add(tuple(map(tuple, sums)))
    assert len(seen) == 1 and next(iter(seen))[0][0] > 100
