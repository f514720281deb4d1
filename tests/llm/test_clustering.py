"""Centroid clustering on bit planes against plain integer arithmetic."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelle.llm import bitplanes
from parcelle.llm.common import written

SCHEMA = "vec_id long, embedding array<double>, cluster int, distance long, v string, planes int"


def brute(rows, k=16, rounds=3, seed="1"):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    def assign():
        return [min((distance(v, c), j) for j, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        now = assign()
        for j in range(len(centroids)):
            own = [v for (_, v), (_, c) in zip(kept, now, strict=True) if c == j]
            if own:
                centroids[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    now = assign()
    total = sum(d for d, _ in now)
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((-1 if i is None else i), c, d, sum(x for x, y in now if y == c), total, sha[c])
                  for (i, _), (d, c) in zip(kept, now, strict=True))


def run(spark, rows, **how):
    table = written(spark.createDataFrame([(i, v, 1, 2, "x", 3) for i, v in rows], SCHEMA), "vectors")
    out = bitplanes.cluster(table, **how)
    return sorted((-1 if r["vec_id"] is None else r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"],
                   r["inertia"], r["centroid_sha256"]) for r in out.collect())


def test_dot_products_of_planes_are_exact():
    rng = np.random.default_rng(1)
    for bits in (2, 5, 12, bitplanes.MAX_BITS):
        top = 1 << (bits - 1)
        a = rng.integers(-top, top, (40, 64))
        a[0], a[1], a[2] = -top, top - 1, 0
        planes = bitplanes.pack(a, bits)
        assert (bitplanes.unpack(planes) == a).all()
        assert (bitplanes.squares(planes) == (a * a).sum(axis=1)).all()
        for j in range(4):
            assert (bitplanes.dots(planes, planes[j]) == (a * a[j]).sum(axis=1)).all()


def test_planes_of_different_widths_multiply():
    a, c = np.full((1, 64), -3), np.full((1, 64), 100_000)
    assert bitplanes.dots(bitplanes.pack(a, 3), bitplanes.pack(c, 18)[0])[0] == -3 * 100_000 * 64


@pytest.mark.parametrize("seed", [0, 1])
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    centre = [[rng.uniform(-1, 1) for _ in range(64)] for _ in range(5)]
    rows = [(i, [x + rng.gauss(0, 0.2) for x in centre[i % 5]]) for i in range(120)]
    rows += [(200 + i, [0.25] * 64) for i in range(40)]                 # a hot vector
    rows += [(300, [float(i % 3) for i in range(64)]), (301, [-2000.5] * 64), (302, [2000.25] * 64)]
    rows += [(7, rows[7][1]), (8, [0.5] * 64), (None, [0.125] * 64)]    # repeated ids, a NULL id
    rows += [(400, None), (401, []), (402, [1.0] * 63), (403, [1.0] * 65), (404, [None] + [1.0] * 63),
             (405, [math.nan] + [1.0] * 63), (406, [1.0] * 63 + [-math.inf])]
    assert run(spark, rows) == brute(rows)


def test_ties_go_to_the_smaller_number(spark):
    rows = [(i, [1.0 if j == i % 2 else 0.0 for j in range(64)]) for i in range(12)] + [(50, [0.0] * 64)] * 3
    assert run(spark, rows, k=5, rounds=2) == brute(rows, k=5, rounds=2)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(1, [0.1] * 64), (2, [-0.1] * 64)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, [(1, None)]) == []


def test_too_large_a_component_is_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        run(spark, [(1, [1e9] + [0.0] * 63)])


def test_float_vectors_are_scaled_as_doubles(spark):
    x = F.array(*(F.lit(0.1).cast("float") for _ in range(64)))
    got = bitplanes.integers(spark.range(1).select(F.col("id").alias("vec_id"), x.alias("embedding"))).first()["v"]
    assert got == [math.floor(64 * float(np.float32(0.1)))] * 64
