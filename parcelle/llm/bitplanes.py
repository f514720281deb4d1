"""Centroid clustering on bit planes.

A vector's 64 integer components are transposed into bit planes: plane i holds
bit i of every component, one component per bit of a 64-bit word, and the last
plane holds the signs (two's complement). The dot product of two vectors is

    sum over planes i, j of  s_i * s_j * 2^(i+j) * popcount(x_i AND c_j)

with s = -1 for a sign plane and 1 otherwise, exactly, and a squared distance
is x.x - 2 x.c + c.c. Vectors are packed once and written; every round reads
the packed table, assigns each vector by AND-popcounts with the centroids'
planes, and adds the members up per task before one row per task and cluster
is shuffled.

Defined results: a vector that is NULL, not of 64 components, or with a
component that is NULL, NaN or infinite is left out. Equal distances go to the
centroid with the smaller number. Vectors with equal start hashes (repeated or
NULL ids; a NULL id hashes as empty) start in order of their components; equal
ones are one start each. Fewer vectors than centroids give as many centroids as there are vectors,
none gives an empty result. Repeated rows are clustered each. A component
outside [-2^26, 2^26) after scaling is an error, as distances would not fit
64 bits. At most ``k`` centroids and their sums come to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import written

WIDTH = 64
MAX_BITS = 27
#: Vectors that are compared with the centroids at a time.
BLOCK = 8192


def pack(values: np.ndarray, bits: int) -> np.ndarray:
    """(vector, plane) words of (vector, 64) integers in two's complement of
    ``bits`` bits."""
    out = np.empty((len(values), bits), np.uint64)
    for plane in range(bits):
        on = ((values >> plane) & 1).astype(np.uint8)
        out[:, plane] = np.packbits(on, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def unpack(planes: np.ndarray) -> np.ndarray:
    """The (vector, 64) integers of ``pack``."""
    out = np.zeros((len(planes), WIDTH), np.int64)
    for plane, weight in enumerate(plane_weights(planes.shape[1])):
        word = np.ascontiguousarray(planes[:, plane]).astype("<u8").view(np.uint8).reshape(-1, 8)
        out += weight * np.unpackbits(word, axis=1, bitorder="little").astype(np.int64)
    return out


def plane_weights(bits: int) -> list[int]:
    return [1 << i for i in range(bits - 1)] + [-(1 << (bits - 1))]


def dots(planes: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact dot products of packed vectors with one packed centroid."""
    out = np.zeros(len(planes), np.int64)
    for i, a in enumerate(plane_weights(planes.shape[1])):
        for j, b in enumerate(plane_weights(len(centroid))):
            if centroid[j]:
                out += a * b * np.bitwise_count(planes[:, i] & centroid[j]).astype(np.int64)
    return out


def squares(planes: np.ndarray) -> np.ndarray:
    """Exact squared lengths of packed vectors."""
    out, weights = np.zeros(len(planes), np.int64), plane_weights(planes.shape[1])
    for i, a in enumerate(weights):
        for j, b in enumerate(weights):
            out += a * b * np.bitwise_count(planes[:, i] & planes[:, j]).astype(np.int64)
    return out


def nearest(planes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cluster and squared distance of packed vectors; ties to the smaller."""
    length = squares(planes)
    own = squares(centroids)
    distance = np.stack([length - 2 * dots(planes, c) + own[k] for k, c in enumerate(centroids)], axis=1)
    cluster = distance.argmin(axis=1)
    return cluster, distance[np.arange(len(planes)), cluster]


def integers(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 64.0) -> DataFrame:
    """(vec_id, v) of the vectors kept: v holds floor(scale * component)."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.where(F.coalesce((F.size(F.col(vector_col)) == WIDTH) & good, F.lit(False)))
    limit = float(1 << (MAX_BITS - 1))

    def whole(x):
        y = F.floor(x * scale)
        wide = F.raise_error(F.lit("a component is too large for exact 64-bit distances")).cast("long")
        return F.when((x * scale >= -limit) & (x * scale < limit), y).otherwise(wide)

    return kept.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(v, whole).alias("v"))


def _arrays(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def packed(whole: DataFrame) -> DataFrame:
    """(vec_id, planes) of ``integers``, written; as many planes as the widest
    component of all vectors needs."""
    ends = whole.agg(F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    bits = 1 + max(1, *(int(x).bit_length() if x >= 0 else int(-x - 1).bit_length() for x in ends if x is not None), 1)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            planes = pack(_arrays(batch, "v", WIDTH).astype(np.int64), bits).view(np.int64)
            yield _batch(batch.column("vec_id"), planes)

    return written(whole.mapInArrow(apply, "vec_id long, planes array<long>"), "bitplanes")


def _batch(ids: pa.Array, planes: np.ndarray) -> pa.RecordBatch:
    ends = pa.array(np.arange(len(planes) + 1, dtype=np.int32) * planes.shape[1])
    return pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(ends, pa.array(planes.ravel()))], ["vec_id", "planes"])


def first_centroids(whole: DataFrame, k: int, seed: str) -> np.ndarray:
    """The ``k`` vectors whose hash of seed and id is smallest."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = whole.select(name.alias("name"), "v").orderBy("name", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64).reshape(-1, WIDTH)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            yield part, _arrays(part, "planes", len(part.column("planes")[0])).view(np.uint64)


def _moved(table: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: the floor of each cluster's mean."""
    k, bits = len(centroids), _bits(centroids)
    packed_centroids = pack(centroids, bits)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, WIDTH), np.int64), np.zeros(k, np.int64)
        for _, planes in _blocks(batches):
            cluster, _ = nearest(planes, packed_centroids)
            values = unpack(planes)
            for c in np.unique(cluster):
                sums[c] += values[cluster == c].sum(axis=0)
                counts[c] += int((cluster == c).sum())
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(counts[some]), pa.array(sums[some].tolist(), pa.list_(pa.int64()))],
            ["cluster", "n", "sums"])

    parts = table.mapInArrow(apply, "cluster int, n long, sums array<long>")
    totals = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(WIDTH)))
    out = centroids.copy()
    for row in totals.collect():
        out[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(WIDTH)]
    return out


def _bits(values: np.ndarray) -> int:
    return 1 + max(1, int(max(values.max(), -values.min() - 1)).bit_length())


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, seed: str = "1", id_col: str = "vec_id",
            vector_col: str = "embedding", scale: float = 64.0) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid,
    centroid_sha256) of each vector kept."""
    spark = vectors.sparkSession
    whole = integers(vectors, id_col, vector_col, scale)
    table = packed(whole)
    centroids = first_centroids(whole, k, seed)
    if not len(centroids):
        return spark.createDataFrame(
            [], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
                "centroid array<long>, centroid_sha256 string")
    for _ in range(rounds):
        centroids = _moved(table, centroids)
    final = pack(centroids, _bits(centroids))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, planes in _blocks(batches):
            number, distance = nearest(planes, final)
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    assigned = written(table.mapInArrow(apply, "vec_id long, cluster int, distance long"), "clusters")
    sums = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    rows = [(c, s, sum(sums.values()), centroids[c].tolist(),
             hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, s in sums.items()]
    about = spark.createDataFrame(
        rows, "cluster int, cluster_inertia long, inertia long, centroid array<long>, centroid_sha256 string")
    return assigned.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid", "centroid_sha256")
