"""Published outputs: readers see whole versions only."""

import pytest
from pyspark.sql import functions as F

from parcelle import queries
from parcelle.sinks import published
from parcelle.sinks.published import commit, current, publish, read_published, stage, versions


def frame(spark, tag, n=20):
    return spark.range(n).select("id", F.lit(tag).alias("tag"))


def tags(df):
    return {(r["tag"], r["count"]) for r in df.groupBy("tag").count().collect()}


def test_a_writer_that_dies_before_its_commit_is_not_seen(spark, tmp_dir):
    root = f"{tmp_dir}/out"
    with pytest.raises(FileNotFoundError):
        read_published(spark, root)
    assert publish(frame(spark, "a"), root) == 1
    half = frame(spark, "b").withColumn("id", F.when(F.col("id") < 15, F.col("id")).otherwise(F.raise_error(F.lit("dies"))))
    with pytest.raises(Exception, match="dies"):
        publish(half, root)                       # dies while it writes
    stage(frame(spark, "c"), root)                # dies between data and record
    assert tags(read_published(spark, root)) == {("a", 20)}
    assert publish(frame(spark, "d", 5), root) == 2
    assert tags(read_published(spark, root)) == {("d", 5)}
    assert tags(read_published(spark, root, version=1)) == {("a", 20)}
    with pytest.raises(FileNotFoundError):
        current(spark, root, version=7)


def test_a_reader_keeps_the_version_it_began_with(spark, tmp_dir):
    publish(frame(spark, "a"), tmp_dir)
    before = read_published(spark, tmp_dir)
    publish(frame(spark, "b"), tmp_dir)
    assert tags(before) == {("a", 20)} and tags(read_published(spark, tmp_dir)) == {("b", 20)}


def test_a_taken_number_is_not_overwritten(spark, tmp_dir, monkeypatch):
    publish(frame(spark, "a"), tmp_dir)
    first, second = stage(frame(spark, "b"), tmp_dir), stage(frame(spark, "c"), tmp_dir)
    seen = versions(spark, tmp_dir)
    assert commit(spark, tmp_dir, first) == 2
    stale = iter([seen])                          # the other writer looked before that commit
    monkeypatch.setattr(published, "versions", lambda s, r: next(stale, None) or versions(s, r))
    assert commit(spark, tmp_dir, second) == 3
    assert versions(spark, tmp_dir)[2] == first and tags(read_published(spark, tmp_dir)) == {("c", 20)}


def test_formats_and_partitions(spark, tmp_dir):
    publish(frame(spark, "a"), tmp_dir, format="csv", options={"header": "true"}, partition_by=["tag"])
    assert tags(read_published(spark, tmp_dir, format="csv", header="true")) == {("a", 20)}


def test_the_writers_share_one_join(spark, sf_small, monkeypatch):
    read = []

    def seen(df, root):
        read.append(df.inputFiles())
        return published.publish(df, root)

    monkeypatch.setattr(queries, "publish", seen)
    assert queries.REGISTRY["sink_published"](spark, sf_small).count() > 0
    assert len(read) == 2 and all("published-lines" in path for files in read for path in files)
