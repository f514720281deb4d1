"""The pipeline, stage by stage, and the registered queries."""

import random
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from parcelle.llm.common import WORKER_BYTES, read_table, written
from parcelle.llm.language_id import _floor
from parcelle.llm.queries import ORACLE_SQL, QUERIES
from parcelle.session import scratch_path
from tests.llm.conftest import table

SF = "/root/testdata/sf0.001"


def test_a_query_for_each_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert set(ORACLE_SQL) <= set(QUERIES)


def test_stages(spark):
    docs = read_table(spark, SF, "documents")
    kept = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        kept[name] = docs = written(stage(spark, docs, SF), name)
    columns = kept["documents"].columns
    ids = {name: {r[0] for r in df.select("doc_id").collect()} for name, df in kept.items()}
    order = ["documents", *[name for name, _ in corpus_pipeline.STAGES]]
    for before, after in zip(order, order[1:], strict=False):
        assert ids[after] <= ids[before]
        assert after == "packing" or kept[after].columns == columns
    assert len(ids["language_id"]) >= 0.97 * len(ids["documents"])
    lowered = kept["exact_dedup"].selectExpr("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') t")
    assert lowered.distinct().count() == len(ids["exact_dedup"])
    contaminated = {r[0] for r in QUERIES["op1_decontamination"](spark, SF).select("doc_id").collect()}
    assert not ids["decontamination"] & contaminated
    assert ids["near_dedup"] - contaminated == ids["decontamination"] == ids["packing"]


def test_stages_on_an_empty_table(spark):
    docs = written(read_table(spark, SF, "documents").where("false"), "none")
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), name)
        assert docs.count() == 0


SOUNDS = ("ka", "tze", "ou", "rri", "mba", "xo", "li", "ghu", "fje", "psy")


@pytest.mark.parametrize("k", [2, 4, 10])
def test_language_stage_keeps_clean_texts_of_any_number_of_languages(spark, k):
    rng = random.Random(k)
    word = lambda s: "".join(rng.choices([s, s[::-1], s[0] + "a"], k=3))
    rows = [(i, " ".join(word(SOUNDS[i % k]) for _ in range(20)), f"l{i % k}") for i in range(40 * k)]
    rows += [(9000, " ".join(word(SOUNDS[i % 2]) for i in range(30)), None), (9001, "12 34 !", "l0"), (9002, None, "l0")]
    kept = {r[0] for r in corpus_pipeline.identify_language(spark, table(spark, rows), SF).select("doc_id").collect()}
    assert not kept & {9001, 9002}
    assert len(kept) >= 0.98 * 40 * k and 9000 in kept   # a text in two languages is told apart, too


def test_language_stage_without_labels_is_an_error(spark):
    with pytest.raises(ValueError, match="no document has a language"):
        corpus_pipeline.identify_language(spark, table(spark, [(1, "some words", None), (2, "", None)]), SF)
    nothing = table(spark, [(1, None, None), (2, " 12 ", None)])
    assert corpus_pipeline.identify_language(spark, nothing, SF).count() == 0


def test_language_floor_lies_between_chance_and_labelled_scores():
    for k in (2, 4, 10):
        p = np.full((50, k), 0.1 / (k - 1))
        p[:, 0] = 0.9
        floor = _floor(p, np.zeros(50, np.int64))
        assert 1 / k < floor < 1 / k + 0.1
    assert _floor(np.full((3, 4), 0.25), np.ones(3, np.int64)) == 0.25   # none right


def test_row_numbers_are_one_a_row_and_the_same_in_every_scan(spark, tmp_dir):
    rows = [(i % 7, f"text {i}", "en") for i in range(500)]
    table(spark, rows).repartition(5).write.option("parquet.block.size", 1024).parquet(f"{tmp_dir}/docs")
    docs = corpus_pipeline._numbered(spark.read.parquet(f"{tmp_dir}/docs"))
    first = {r["__row"]: r["text"] for r in docs.select("__row", "text").collect()}
    assert len(first) == 500
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        again = docs.where("text > 'text 2'").select("__row", "text").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert again and all(first[r["__row"]] == r["text"] for r in again)
    made = corpus_pipeline._numbered(spark.createDataFrame(rows, "doc_id long, text string, lang string"))   # from no file
    assert made.select("__row").distinct().count() == 500


def test_the_language_stage_hands_its_workers_small_batches(spark, monkeypatch):
    """Batches of 10,000 texts filled the workers, which live on beside the
    stages that follow."""
    key, seen, write = "spark.sql.execution.arrow.maxBytesPerBatch", [], corpus_pipeline.written

    def watched(df, name, **options):
        seen.append(("ArrowEvalPython" in df._jdf.queryExecution().executedPlan().toString(), spark.conf.get(key)))
        return write(df, name, **options)

    monkeypatch.setattr(corpus_pipeline, "written", watched)
    kept = corpus_pipeline.identify_language(spark, read_table(spark, SF, "documents"), SF)
    assert (True, str(WORKER_BYTES)) in seen and (True, spark.conf.get(key)) not in seen
    assert "ArrowEvalPython" not in kept._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("stage", [corpus_pipeline.drop_copies, corpus_pipeline.drop_near_copies, corpus_pipeline.drop_contaminated])
def test_a_stage_that_drops_rows_neither_copies_nor_shuffles_the_texts(spark, stage):
    scratch = Path(scratch_path(spark, "x").removeprefix("file:")).parent
    before = set(scratch.glob("*")) if scratch.exists() else set()
    kept = stage(spark, read_table(spark, SF, "documents"), SF)
    assert 0 < kept.count() < 200
    for folder in set(scratch.glob("*")) - before:
        assert "text" not in spark.read.parquet(str(folder)).columns, folder
    assert "SortMergeJoin" not in kept._jdf.queryExecution().executedPlan().toString()
