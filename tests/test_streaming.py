"""Incremental cleaning: two landing rounds give the batch result, and a
re-run with nothing new adds nothing."""

import pathlib
import time

from pyspark.sql import Row
from pyspark.sql import functions as F

from parcelle.plans.clean import clean_sales
from parcelle.plans.landing import land_files
from parcelle.sources.adapter import raw_sales
from parcelle.streaming.landed import _shares, clean_new_files, read_cleaned


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_two_rounds_equal_batch(spark, sf_small, tmp_dir):
    raw = raw_sales(spark, sf_small)
    early = F.substring("date_mutation", 1, 4) < "1998"
    root, out, ckpt = f"{tmp_dir}/land", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    land_files(raw.filter(early), root, run="1")
    clean_new_files(spark, root, out, ckpt)
    first = read_cleaned(spark, out).count()
    land_files(raw.filter(~early), root, gzip=F.lit(True), run="2")
    clean_new_files(spark, root, out, ckpt)
    clean_new_files(spark, root, out, ckpt)  # nothing new
    got = read_cleaned(spark, out)
    assert 0 < first < got.count()
    assert _rows(got) == _rows(clean_sales(raw))


def test_one_file_a_batch_and_a_replacing_run_equal_batch(spark, sf_small, tmp_dir):
    raw = raw_sales(spark, sf_small).filter(F.col("code_departement").isin("01", "05"))
    root, out, ckpt = f"{tmp_dir}/land", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    land_files(raw.repartition(3), root, run="1")
    clean_new_files(spark, root, out, ckpt, max_files_per_trigger=4)
    assert _rows(read_cleaned(spark, out)) == _rows(clean_sales(raw))
    land_files(raw, root, run="2")
    clean_new_files(spark, root, out, ckpt)
    assert _rows(read_cleaned(spark, out)) == _rows(clean_sales(raw))


def test_output_has_few_files_a_name(spark, sf_small, tmp_dir):
    raw = raw_sales(spark, sf_small).filter(F.col("code_departement").isin("01", "05"))
    root, out = f"{tmp_dir}/land", f"{tmp_dir}/out"
    land_files(raw, root, run="1")
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    try:
        clean_new_files(spark, root, out, f"{tmp_dir}/ckpt")
    finally:
        spark.conf.unset(name)
    names = list(pathlib.Path(out).glob("fichier=*"))
    assert names and all(len(list(n.glob("part-*"))) == 1 for n in names)
    assert _rows(read_cleaned(spark, out)) == _rows(clean_sales(raw))


def _shuffled_bytes(spark):
    """Bytes of the shuffle files that the session has on disk, by file."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    found = [pathlib.Path(files.apply(i).getPath()) for i in range(files.size())]
    sizes = {}
    for f in found:
        if f.name.startswith("shuffle_") and f.name.endswith(".data"):
            try:
                sizes[f.name] = f.stat().st_size
            except FileNotFoundError:
                pass
    return sizes


def test_a_batch_in_shares_equals_batch_and_its_shuffles_go(spark, sf_small, tmp_dir):
    raw = raw_sales(spark, sf_small).filter(F.col("code_departement").isin("01", "05"))
    root, out = f"{tmp_dir}/land", f"{tmp_dir}/out"
    even = F.substring("date_mutation", 1, 4).cast("int") % 2 == 0
    land_files(raw, root, gzip=even, run="1")
    before, deadline = _shuffled_bytes(spark), time.time() + 20
    clean_new_files(spark, root, out, f"{tmp_dir}/ckpt", share_bytes=30_000)
    # A write's shuffles are larger than those of listings; they are deleted in the background.
    left = lambda: {k: v for k, v in _shuffled_bytes(spark).items() if k not in before and v > 1_000}
    while (kept := left()) and time.time() < deadline:
        time.sleep(0.2)
    assert not kept
    assert _rows(read_cleaned(spark, out)) == _rows(clean_sales(raw))


def test_shares_hold_whole_names_up_to_their_size():
    files = [Row(path=f"/r/dvf_0{d}_2000.csv{gz}/part-{p}", length=n, logical=f"dvf_0{d}_2000.csv")
             for d, gz, p, n in [(1, "", 0, 60), (2, "", 0, 30), (1, "", 1, 50), (3, "", 0, 40), (4, "", 0, 31)]]
    paths = lambda *ks: [files[k]["path"] for k in ks]
    assert _shares(files, 100) == [paths(0, 2), paths(1, 3), paths(4)]  # the first name alone is larger
    packed = [Row(path=f"/r/dvf_0{d}_2000.csv.gz", length=10, logical=f"dvf_0{d}_2000.csv") for d in (1, 2)]
    assert [len(s) for s in _shares(packed, 100)] == [1, 1]  # they hold more text than bytes
    assert _shares([], 100) == []
