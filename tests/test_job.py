"""Extract / transform / load, the runner's report and failure wrapping."""

import gzip
import os
import uuid

import pytest

from parcelle.plans import job as job_module
from parcelle.plans.job import EtlJobError, SalesJob, report_frame, run_job
from parcelle.sinks.files import write_csv
from parcelle.sources.files import read_sales
from parcelle.sources.jdbc import derby_memory, read_table
from tests.test_clean import SIX_COLUMNS, SIX_ROWS


def _landed_six(spark, root):
    write_csv(spark.createDataFrame(SIX_ROWS, SIX_COLUMNS), f"{root}/dvf_22_2023.csv")
    return root


def test_extract_reads_six_lines(spark, tmp_dir):
    raw = read_sales(spark, _landed_six(spark, tmp_dir))
    assert raw.count() == 6
    assert "id_mutation" in raw.columns
    # keys stay text, spaces kept for the cleaning step
    assert {r["type_local"] for r in raw.collect()} >= {"  appartement  "}


def test_job_runs_and_loads_both_sinks(spark, tmp_dir):
    target = derby_memory(f"t{uuid.uuid4().hex[:8]}")
    job = SalesJob(spark, source=_landed_six(spark, f"{tmp_dir}/in"), output=f"{tmp_dir}/out",
                   jdbc=target, partition_by=["code_departement"], jdbc_partitions=2)
    report = run_job(job)
    assert report["status"] == "success"
    assert report["job_name"] == "SalesJob"
    assert report["metrics"]["row_count_raw"] == 6
    assert report["metrics"]["row_count_transformed"] == 3
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 3
    served = read_table(spark, target, "transactions")
    assert served.count() == 3
    assert "coordinates" in served.columns
    assert report_frame(spark, report).first()["status"] == "success"


def test_a_scan_task_of_the_job_reads_few_compressed_files(spark, tmp_dir, monkeypatch):
    """Compressed files were packed by their stored size up to 128 MB a task."""
    n, per_file = 160, 4 << 20  # what Spark adds to a file's size
    os.makedirs(f"{tmp_dir}/in")
    lines = [SIX_COLUMNS.names, *[["" if x is None else str(x) for x in row] for row in SIX_ROWS]]
    for i in range(n):
        with gzip.open(f"{tmp_dir}/in/dvf_{i:03}_2022.csv.gz", "wt") as f:
            f.writelines(",".join(line) + "\n" for line in lines)
    tasks, write = [], job_module.write

    def watched(df, *args, **options):
        tasks.append(read_sales(spark, f"{tmp_dir}/in").rdd.getNumPartitions())
        return write(df, *args, **options)

    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    monkeypatch.setattr(job_module, "write", watched)
    report = run_job(SalesJob(spark, source=f"{tmp_dir}/in", output=f"{tmp_dir}/out"))
    assert report["metrics"]["row_count_raw"] == 6 * n
    assert tasks[0] >= n * per_file / (16 << 20), tasks
    assert spark.conf.get(key) == before


def test_stages_run_in_order():
    calls = []

    class Fake:
        name = "Fake"
        metrics = {}

        def extract(self):
            calls.append("extract")
            return "raw"

        def transform(self, df):
            calls.append(("transform", df))
            return "clean"

        def load(self, df):
            calls.append(("load", df))

    report = run_job(Fake())
    assert calls == ["extract", ("transform", "raw"), ("load", "clean")]
    assert report["status"] == "success" and "metrics" in report


def test_failure_is_wrapped():
    class Broken:
        name = "Broken"

        def extract(self):
            raise ValueError("simulated extract error")

    with pytest.raises(EtlJobError) as info:
        run_job(Broken())
    assert "ETL job failed" in str(info.value)
    assert "simulated extract error" in str(info.value)
    assert isinstance(info.value.__cause__, ValueError)
