"""Damaged compressed files, malformed lines, the header job, metadata."""

import gzip
import os
import random

import pytest
from pyspark.sql import functions as F

from parcelle.plans.landing import (
    integrity_errors,
    land_files,
    landing_manifest,
    landing_metadata,
    read_landed,
    read_rejected,
    with_decompression_errors,
)
from parcelle.sinks.files import put_bytes
from parcelle.sources import integrity
from parcelle.sources.adapter import raw_sales
from parcelle.sources.files import list_files, read_sales
from parcelle.sources.integrity import check_files, check_gzip

TEXT = "".join(f"{i},{i * i % 97}\n" for i in range(300)).encode()


def test_sound_files_of_one_or_more_members():
    one = gzip.compress(TEXT)
    assert check_gzip(one) == (1, len(TEXT), None)
    assert check_gzip(one + gzip.compress(b"") + one) == (3, 2 * len(TEXT), None)
    assert check_gzip(one + bytes(512)) == (1, len(TEXT), None)          # padding
    assert check_gzip(gzip.compress(b"")) == (1, 0, None)
    big = gzip.compress(random.Random(1).randbytes(3 * integrity.PIECE))  # several pieces
    assert check_gzip(big + one) == (2, 3 * integrity.PIECE + len(TEXT), None)


def test_kinds_of_damage_are_told_apart():
    one = gzip.compress(TEXT)
    assert check_gzip(b"") == (0, 0, integrity.EMPTY)
    assert check_gzip(b"not gzip at all")[2] == integrity.NOT_GZIP
    assert check_gzip(one + one[:40])[2] == integrity.CUT % 2
    assert check_gzip(one + b"junk")[2] == integrity.TRAILING % 1
    assert check_gzip(one[:-8] + bytes([one[-8] ^ 1]) + one[-7:])[2] == integrity.CHECKSUM % 1
    assert check_gzip(one[:-1] + bytes([one[-1] ^ 128]))[2] == integrity.LENGTH % 1


def test_every_cut_and_every_flipped_bit_is_found():
    one = gzip.compress(TEXT)
    assert all(check_gzip(one[:n])[2] for n in range(len(one)))
    for at in range(10, len(one)):   # behind the header, whose time and system are not protected
        for bit in range(8):
            bad = one[:at] + bytes([one[at] ^ 1 << bit]) + one[at + 1:]
            assert check_gzip(bad)[2] or gzip.decompress(bad) == TEXT, (at, bit)   # unused bits before the trailer


def _gz(root, name, content):
    with open(os.path.join(root, name), "wb") as f:
        f.write(content)


@pytest.fixture()
def damaged(spark, tmp_dir):
    header = b"id_mutation,valeur_fonciere\n"
    lines = b"".join(b"m%d,%d\n" % (i, i) for i in range(20_000))
    whole = gzip.compress(header + lines)
    _gz(tmp_dir, "dvf_01_2019.csv.gz", whole)
    _gz(tmp_dir, "dvf_02_2019.csv.gz", whole[:len(whole) // 2])
    _gz(tmp_dir, "dvf_03_2019.csv.gz", whole[:200] + bytes([whole[200] ^ 4]) + whole[201:])
    _gz(tmp_dir, "dvf_04_2019.csv.gz", gzip.compress(b""))
    _gz(tmp_dir, "dvf_05_2019.csv.gz", b"")
    _gz(tmp_dir, "dvf_06_2019.csv", header + b"x,1\n")
    return tmp_dir


def test_damaged_files_are_flagged_and_left_out(spark, damaged):
    found = {r["departement"]: r["decompression_error"]
             for r in with_decompression_errors(spark, damaged, landing_manifest(spark, damaged)).collect()}
    assert found["01"] is None and found["04"] is None and found["06"] is None
    assert found["02"] == integrity.CUT % 1 and "member 1" in found["03"]
    assert "05" not in found   # a file of no bytes is not listed, so its pair is in the missing list
    landed = read_landed(spark, damaged, only_sound=True)
    assert {r["departement"]: r["count"] for r in landed.groupBy("departement").count().collect()} == {"01": 20_000, "06": 1}
    meta = landing_metadata(spark, damaged, "here", {"departements_demandes": ["01"]}).first()
    assert (meta["nombre_fichiers"], meta["fichiers_endommages"], meta["nombre_lignes"]) == (5, 2, 20_001)
    files = {f["fichier"]: f for f in meta["fichiers"]}
    assert list(files) == sorted(files) and files["dvf_01_2019.csv.gz"]["taille"] == os.path.getsize(f"{damaged}/dvf_01_2019.csv.gz")
    assert (files["dvf_02_2019.csv.gz"]["nombre_lignes"], files["dvf_06_2019.csv"]["nombre_lignes"]) == (0, 1)
    assert meta["departements_demandes"] == ["01"] and meta["source"] == "here" and meta["taille_totale"] > 0


def test_files_too_large_for_a_row_are_read_by_spark(spark, damaged):
    listed = list_files(spark, damaged, "*.gz")
    small = {r["path"]: r["error"] is None for r in check_files(spark, listed).collect()}
    large = {r["path"]: r["error"] is None for r in check_files(spark, listed, in_row_bytes=0).collect()}
    assert large == small and sum(large.values()) == 2


def test_no_compressed_file_is_no_error(spark, sf_small, tmp_dir):
    land_files(raw_sales(spark, sf_small).where("code_departement = '07'"), tmp_dir)
    assert integrity_errors(spark, tmp_dir).count() == 0


LINES = """id_mutation,date_mutation,valeur_fonciere
a,2020-01-01,1
b,2020-01-02
c,2020-01-03,3,4
d,"2020-01-04,4
"e,2020-01-05,5
f,"2020,01",6
g,,
"h ""x"" y",2020-01-08,8
"""


def test_malformed_lines_go_to_the_side_channel(spark, tmp_dir):
    with open(f"{tmp_dir}/dvf_22_2020.csv", "w") as f:
        f.write(LINES)
    with open(f"{tmp_dir}/dvf_22_2021.csv", "w") as f:   # other columns, all lines good
        f.write("valeur_fonciere,id_mutation\n7,z\n")
    kept = read_sales(spark, tmp_dir)
    assert sorted(r["id_mutation"][0] for r in kept.select("id_mutation").collect()) == ['"', "a", "f", "g", "z"]
    bad = {r["line"][:2].strip('"')[0]: (r["fichier"], r["reason"]) for r in read_rejected(spark, tmp_dir).collect()}
    name = "dvf_22_2020.csv"
    assert bad == {"b": (name, "too few fields"), "c": (name, "too many fields"), "d": (name, "open quote"), "e": (name, "open quote")}
    assert kept.count() + read_rejected(spark, tmp_dir).count() == 9
    assert read_rejected(spark, tmp_dir).select("reason").distinct().count() == 3
    assert kept.where("valeur_fonciere is null").select("id_mutation").count() == 1   # pruned columns are counted alike


def _jobs(spark, group, action):
    spark.sparkContext.setJobGroup(group, group)
    try:
        action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_headers_need_a_fixed_number_of_jobs(spark, tmp_dir):
    jobs = []
    for n in (100, 400):   # more than 32 paths are listed by a job, per read
        root = f"{tmp_dir}/{n}"
        os.makedirs(root)
        for i in range(n):
            columns, row = ("id_mutation,valeur_fonciere", f"m{i},{i}") if i % 2 else ("valeur_fonciere,autre,id_mutation", f"{i},x,m{i}")
            with open(f"{root}/dvf_{i:03d}_2020.csv", "w") as f:
                f.write(f"{columns}\n{row}\n")
        out = []
        jobs.append(_jobs(spark, f"headers-{n}", lambda root=root: out.append(read_sales(spark, root))))
        rows = out[0].collect()
        assert len(rows) == n and all(r["id_mutation"] == f"m{r['valeur_fonciere']}" for r in rows)
    assert jobs[1] == jobs[0]


def test_put_bytes_overwrites(spark, tmp_dir):
    for content in (b"one", b"three"):
        put_bytes(spark, f"{tmp_dir}/x/name.bin", content)
    assert bytes(spark.read.format("binaryFile").load(f"{tmp_dir}/x/name.bin").first()["content"]) == b"three"
    assert spark.read.format("binaryFile").load(f"{tmp_dir}/x").select(F.element_at(F.split("path", "/"), -1)).first()[0] == "name.bin"
