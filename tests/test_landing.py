"""Landed files: mixed plain / gzip scan, names, manifest, missing list."""

from pathlib import Path

from pyspark.sql import functions as F

from parcelle.plans import landing
from parcelle.plans.landing import (
    _sliced,
    dataset_metadata,
    expected_grid,
    land_files,
    landing_manifest,
    manifest_summary,
    missing_partitions,
    read_landed,
    slices_of,
)
from parcelle.sources.adapter import raw_sales
from parcelle.sources.files import landed_file_name


def _year():
    return F.substring("date_mutation", 1, 4)


def test_landing_round_trip_with_gaps(spark, sf_small, tmp_dir):
    raw = raw_sales(spark, sf_small)
    # Land two departments only; compress 1995 files.
    subset = raw.filter(F.col("code_departement").isin("01", "02"))
    land_files(subset, tmp_dir, gzip=_year() == "1995")
    landed = read_landed(spark, tmp_dir)
    assert landed.count() == subset.count()
    assert landed.filter(F.col("departement") != F.col("code_departement")).count() == 0
    assert landed.filter(F.col("annee") != _year()).count() == 0

    manifest = landing_manifest(spark, tmp_dir)
    rows = manifest.collect()
    assert {r["departement"] for r in rows} == {"01", "02"}
    gz = [r for r in rows if r["annee"] == "1995"]
    assert gz and all(r["format"] == "csv.gz" and not r["decompressed"] for r in gz)
    assert all(r["taille"] > 0 for r in rows)

    depts = spark.createDataFrame([("01",), ("02",), ("03",)], "departement string")
    grid = expected_grid(depts, ["1995", "1996", "2030"])
    missing = {(r["departement"], r["annee"]) for r in missing_partitions(grid, manifest).collect()}
    assert ("03", "1995") in missing and ("01", "2030") in missing
    assert ("01", "1995") not in missing
    summary = manifest_summary(manifest, missing_partitions(grid, manifest)).first()
    assert summary["files_count"] == len(rows)
    assert summary["failure_count"] == len(missing)

    meta = dataset_metadata(landed).first()
    assert meta["departements"] == ["01", "02"]
    assert meta["nombre_enregistrements"] == subset.count()
    assert meta["date_extraction"] is not None


def test_file_name_pattern(spark):
    df = spark.createDataFrame([("s3a://b/raw/dvf_22_2019.csv",),
                                ("/x/fichier=dvf_2A_2020.csv.gz/part-0.csv.gz",),
                                ("/x/other.csv",)], "p string")
    names = [r[0] for r in df.select(landed_file_name(F.col("p"))).collect()]
    assert names == ["dvf_22_2019.csv", "dvf_2A_2020.csv.gz", ""]


def test_metadata_of_records(spark):
    recs = spark.createDataFrame([("a", 1), ("b", 2)], "reg_name string, n int")
    meta = dataset_metadata(recs, source="api", scope={"regions": ["Bretagne"]}).first()
    assert meta["nombre_enregistrements"] == 2
    assert meta["colonnes"] == ["reg_name", "n"]
    assert meta["regions"] == ["Bretagne"] and meta["source"] == "api"


def test_corrupt_gzip_is_listed_and_skipped(spark, sf_small, tmp_dir):
    import os

    raw = raw_sales(spark, sf_small).filter(F.col("code_departement") == "03")
    land_files(raw, tmp_dir)
    bad_dir = os.path.join(tmp_dir, "fichier=dvf_99_2001.csv.gz")
    os.makedirs(bad_dir)
    with open(os.path.join(bad_dir, "part-0.csv.gz"), "wb") as f:
        f.write(b"not gzip at all")
    manifest = {r["fichier"]: r for r in landing_manifest(spark, tmp_dir).collect()}
    assert manifest["dvf_99_2001.csv.gz"]["decompressed"] is False
    assert manifest["dvf_99_2001.csv.gz"]["format"] == "csv.gz"
    from parcelle.sources.files import read_sales
    tolerant = read_sales(spark, tmp_dir, options={"ignoreCorruptFiles": "true"})
    assert tolerant.count() == raw.count()


def test_landing_rerun_does_not_duplicate(spark, sf_small, tmp_dir):
    raw = raw_sales(spark, sf_small).filter(F.col("code_departement") == "05")
    land_files(raw, tmp_dir, gzip=_year() == "1996")
    land_files(raw, tmp_dir, gzip=_year() == "1996")
    assert read_landed(spark, tmp_dir).count() == raw.count()


def test_unnamed_files_are_listed_and_read(spark, sf_small, tmp_dir):
    raw = raw_sales(spark, sf_small).limit(5)
    land_files(raw.withColumn("date_mutation", F.lit("15/01/2023")), tmp_dir, run="1")
    land_files(raw.withColumn("code_departement", F.lit(None).cast("string")), tmp_dir, run="2")
    manifest = landing_manifest(spark, tmp_dir).collect()
    assert len(manifest) >= 2 and all(r["departement"] is None and r["annee"] is None for r in manifest)
    landed = read_landed(spark, tmp_dir)
    assert landed.count() == 10
    assert {r[0] for r in landed.select("fichier").distinct().collect()} == {r["fichier"] for r in manifest}


def test_plain_and_gzip_of_one_name_count_once(spark, sf_small, tmp_dir):
    import gzip
    import os

    rows = ["id_mutation,valeur_fonciere,autre", "1,100,x", "2,200,y"]
    with open(os.path.join(tmp_dir, "dvf_22_2019.csv"), "w") as f:
        f.write("\n".join(rows))
    with gzip.open(os.path.join(tmp_dir, "dvf_22_2019.csv.gz"), "wt") as f:
        f.write("\n".join(rows))
    assert sorted((r["id_mutation"], r["valeur_fonciere"], r["latitude"]) for r in read_landed(spark, tmp_dir).collect()) == [
        ("1", "100", None), ("2", "200", None)]


def test_missing_key_column_is_an_error(spark, tmp_dir):
    import os

    import pytest

    from parcelle.sources.files import read_sales

    with open(os.path.join(tmp_dir, "dvf_22_2019.csv"), "w") as f:
        f.write("valeur_fonciere\n1\n")
    with pytest.raises(ValueError, match="id_mutation"):
        read_sales(spark, tmp_dir)


def test_decompression_error(spark, sf_small, tmp_dir):
    import os

    from parcelle.plans.landing import with_decompression_errors

    land_files(raw_sales(spark, sf_small).filter(F.col("code_departement") == "03"), tmp_dir, gzip=F.lit(True))
    with open(os.path.join(tmp_dir, "dvf_99_2001.csv.gz"), "wb") as f:
        f.write(b"not gzip at all")
    found = with_decompression_errors(spark, tmp_dir, landing_manifest(spark, tmp_dir)).collect()
    assert {r["fichier"] for r in found if r["decompression_error"]} == {"dvf_99_2001.csv.gz"}


def test_a_large_stage_is_landed_in_slices_and_removed(spark, sf_small, tmp_dir, monkeypatch):
    raw = raw_sales(spark, sf_small)
    odd = F.col("code_departement").cast("int") % 2 == 1
    whole, sliced, stage = f"{tmp_dir}/whole", f"{tmp_dir}/sliced", f"{tmp_dir}/stage"
    land_files(raw, whole, gzip=odd)
    monkeypatch.setattr(landing, "SLICE_BYTES", 1)
    for _ in range(2):  # a run that is made again replaces its files
        land_files(raw, sliced, gzip=odd, stage=stage, stage_slices=3)
    assert not Path(stage).exists()
    rows = lambda root: sorted(map(repr, read_landed(spark, root).collect()))
    assert rows(sliced) == rows(whole)
    names = lambda root: sorted(str(p.relative_to(root)) for p in Path(root).glob("run=1/*/fichier=*"))
    assert names(sliced) == names(whole)


def test_slices_of_sales_are_cut_before_the_joins(spark, sf_small):
    """Both sides of the join on the order's key are filtered below it."""
    plan = _sliced(raw_sales(spark, sf_small), "id_mutation", 1, 3)._jdf.queryExecution().optimizedPlan().toString()
    hashed = [line for line in plan.splitlines() if "xxhash64" in line]
    assert len(hashed) == 2 and {"l_orderkey", "o_orderkey"} == {k for k in ("l_orderkey", "o_orderkey") for line in hashed if k in line}
    assert all(plan.splitlines()[i + 1].strip(" :+-").startswith("Relation") for i, line in enumerate(plan.splitlines()) if line in hashed)


def test_slices_grow_with_the_stored_bytes_to_a_bound():
    assert [slices_of(n << 20) for n in (0, 1, 64, 127, 128, 10_000)] == [1, 1, 1, 1, 2, 4]
