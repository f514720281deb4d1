"""Extract / transform / load as plain functions on DataFrames, a runner
that reports status and metrics, and failure wrapping.

Row counts are collected with ``Observation`` during the writes that run
anyway, so the lineage is not re-evaluated just to count it; the JDBC load
reads the written Parquet back instead of recomputing the cleaning.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from parcelle.plans.clean import clean_sales, sale_points, serving_sales
from parcelle.schema import CLEAN_SCHEMA, SERVING_TABLE
from parcelle.sinks.files import write
from parcelle.sources.files import read_sales, small_scans
from parcelle.sources.jdbc import JdbcTarget, write_table


class EtlJobError(Exception):
    """A job stage failed; the message carries status, error and job name."""


@dataclass
class SalesJob:
    spark: SparkSession
    source: str                      # folder of landed CSV / CSV.gz files
    output: str                      # cleansed Parquet folder
    jdbc: JdbcTarget | None = None   # serving database, optional
    table: str = SERVING_TABLE
    name: str = "SalesJob"
    column_types: str | None = None  # e.g. string_column_types(...) for VARCHAR text
    partition_by: list[str] | None = None  # e.g. ["code_departement"]: readers prune
    jdbc_partitions: int | None = None     # cap on concurrent database connections
    read_options: dict | None = None       # e.g. {"ignoreCorruptFiles": "true"}
    rebalance: int | None = None           # partitions after reading few large .gz files
    metrics: dict = field(default_factory=dict)

    def extract(self) -> DataFrame:
        self._raw_obs = Observation("raw")
        return read_sales(self.spark, self.source, self.read_options, self.rebalance).observe(
            self._raw_obs, F.count(F.lit(1)).alias("row_count_raw"))

    def transform(self, raw: DataFrame) -> DataFrame:
        return clean_sales(raw)

    def load(self, clean: DataFrame) -> None:
        out_obs = Observation("transformed")
        with small_scans(self.spark):
            write(clean.observe(out_obs, F.count(F.lit(1)).alias("row_count_transformed")),
                  self.output, format="parquet", partition_by=self.partition_by)
        self.metrics.update(out_obs.get)
        self.metrics.update(self._raw_obs.get if hasattr(self, "_raw_obs") else {})
        if self.jdbc is not None:
            # Known schema: partition discovery would type an all-NULL
            # partition column as void.
            written = self.spark.read.schema(CLEAN_SCHEMA).parquet(self.output)
            serving = sale_points(serving_sales(written))
            write_table(serving, self.jdbc, self.table, column_types=self.column_types,
                        num_partitions=self.jdbc_partitions)


def run_job(job) -> dict:
    """Run extract -> transform -> load; return ``{status, metrics,
    job_name}``. Any failure is re-raised as ``EtlJobError`` whose message
    holds ``ETL job failed`` and the cause, chained to the original."""
    name = getattr(job, "name", type(job).__name__)
    metrics = getattr(job, "metrics", {})
    try:
        metrics["extraction_start"] = time.time()
        raw = job.extract()
        metrics["extraction_end"] = metrics["transformation_start"] = time.time()
        clean = job.transform(raw)
        metrics["transformation_end"] = metrics["loading_start"] = time.time()
        job.load(clean)
        metrics["loading_end"] = time.time()
        return {"status": "success", "metrics": metrics, "job_name": name}
    except Exception as e:
        info = {"status": "failed", "error": str(e), "job_name": name}
        raise EtlJobError(f"ETL job failed: {info}") from e


def report_frame(spark: SparkSession, report: dict) -> DataFrame:
    """The run report as a one-row DataFrame."""
    m = report.get("metrics", {})
    return spark.createDataFrame(
        [(report["status"], report["job_name"], m.get("row_count_raw"),
          m.get("row_count_transformed"),
          (m.get("loading_end") or 0) - (m.get("extraction_start") or 0))],
        "status string, job_name string, row_count_raw long, row_count_transformed long, "
        "seconds double",
    )
