"""Results do not depend on how scans split the input's files."""

import random
from collections import Counter

import pytest

import corpus_pipeline
from parcelle.llm import decontaminate, exact_dedup, licenses, near_dedup, pii, repeats
from parcelle.llm.common import read_table, written
from tests.llm.conftest import prose

SF = "/root/testdata/sf0.001"
#: All files in one partition, or one file in each.
SPLITS = [{"spark.sql.files.minPartitionNum": "1", "spark.sql.files.openCostInBytes": "0"},
          {"spark.sql.files.minPartitionNum": "8", "spark.sql.files.openCostInBytes": "4m"}]


@pytest.fixture(scope="module")
def files(spark):
    """Texts in several files: a passage and an address in some, near copies
    and copies, a licence line, an item of the benchmark."""
    rng = random.Random(11)
    passage, base = prose(rng, 80), prose(rng, 150)
    item = read_table(spark, SF, "benchmark").where("length(text) > 100").orderBy("item_id").first()["text"]
    rows = []
    for i in range(40):
        parts = [prose(rng, 30)]
        parts += [passage] * (i % 7 == 0) + [f"mail a{i}@b.org"] * (i % 5 == 0) + [item] * (i % 11 == 0)
        parts += ["\nReleased under the MIT License.\n"] * (i % 13 == 0)
        rows.append((i, f"d/{i}", base + f" {i}" if i % 9 == 4 else parts[0] if i % 9 == 5 and i < 6 else " ".join(parts), "en", "s", 1))
    df = spark.createDataFrame(rows, "doc_id long, path string, text string, lang string, source string, n_chars long")
    return written(df.repartition(5, "doc_id"), "files")


def outcome(df):
    return Counter(str(r) for r in df.drop("row").collect())


RUNS = {
    "op1": lambda s, d: decontaminate.contaminated(d, read_table(s, SF, "benchmark")),
    "op3": lambda s, d: exact_dedup.exact_dedup(d, block_bytes=16).select("doc_id", "keep_id", "group_size", "text_sha256"),
    "op4": lambda s, d: repeats.remove_repeats(d),
    "op5": lambda s, d: near_dedup.near_dedup(d),
    "op7": lambda s, d: pii.find_pii(d),
    "op9": lambda s, d: licenses.scan_licenses(d),
    "exact_dedup": lambda s, d: corpus_pipeline.drop_copies(s, d, SF),
    "near_dedup": lambda s, d: corpus_pipeline.drop_near_copies(s, d, SF),
    "decontamination": lambda s, d: corpus_pipeline.drop_contaminated(s, d, SF),
}


@pytest.mark.parametrize("name", RUNS)
def test_scans_that_split_the_files_differently(spark, files, monkeypatch, name):
    source = files.select("doc_id", "path", "text")
    kept = {k: spark.conf.get(k, None) for k in SPLITS[0]}
    turn = [0]

    def split(*args):
        out = written(*args)
        turn[0] += 1
        for k, v in SPLITS[turn[0] % 2].items():
            spark.conf.set(k, v)
        return out

    want = outcome(RUNS[name](spark, source))
    for module in (decontaminate, exact_dedup, licenses, near_dedup, pii, repeats, corpus_pipeline):
        monkeypatch.setattr(module, "written", split)
    try:
        assert outcome(RUNS[name](spark, source)) == want
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
