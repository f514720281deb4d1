"""Session helpers: a tuned local session for tests and benches, and the
shared scratch folder every intermediate write goes to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter at scale as much as locally: AQE re-plans shuffle
# widths and splits skewed join partitions at run time.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Local runs only: the driver tables are single-row-group files, so each scan
# is one task. With the default 10 MB threshold Spark broadcasts even
# lineitem and the whole plan streams through that one task; a lower
# threshold keeps dimension-sized tables broadcast and gives the large joins
# the shuffle-join plan a cluster would pick anyway, spread over all cores.
#
# AQE's 64 MB advisory partition size would merge every shuffle of the
# sf0.1 data into one or two partitions; 16 MB keeps all cores busy.
LOCAL_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": str(512 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(16 * 1024 * 1024),
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8,
                  app: str = "parcelle") -> SparkSession:
    """Local session for tests and the bench (UI off, no server)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**SCALE_CONF, **LOCAL_CONF}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session. Only a local-mode
    session without one (tests) gets a fresh temporary folder; a cluster
    session without one is an error, since a machine-local folder is not
    visible to other executors.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a shared folder (HDFS, object store) "
            "for intermediate tables"
        )
    path = tempfile.mkdtemp(prefix="parcelle-ckpt-")
    sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for one write."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/parcelle/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Within: the session has these settings."""
    before = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within: what a write has shuffled goes from disk when the write ends.
    Spark keeps it until the driver's garbage collector finds the finished
    plan, so the shuffles of writes that follow each other would add up."""
    with settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        yield
