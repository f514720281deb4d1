"""The training-data pipeline over ``documents``: language ID, exact dedup,
MinHash near-dedup, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and
reread as the next stage's docs. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.llm import decontaminate, exact_dedup, language_id, near_dedup, packing
from parcelle.llm.common import by_place, held_out, read_table, rows_in, small_batches, written
from parcelle.llm.queries import tokenizer_file

_numbered = by_place


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of numbered ``docs`` whose number is not in ``dropped``; few
    numbers go to the texts, so these are not shuffled."""
    dropped = written(dropped.select(F.col("row").alias("__row")).distinct(), "dropped")
    return rows_in(docs, dropped, "left_anti", "__row").drop("__row")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in no language, or that the model tells hardly better
    than by chance. Documents without any label to learn from are an error."""
    model = language_id.fit(docs, ~held_out(F.col("doc_id")))
    if model is None and not docs.where(F.col("text").rlike("\\p{L}")).isEmpty():
        raise ValueError("no document has a language to learn from: the stage would reject all of them")
    docs = _numbered(docs)
    found = language_id.identify(docs.select("__row", "text"), model, prefix="__")
    kept = (F.col("__lang_pred") != language_id.UNKNOWN) & (F.col("__score") >= (model.floor if model else 0.0))
    with small_batches(spark):
        rejected = written(found.where(~kept).select(F.col("__row").alias("row")), "rejected")
    return _without(docs, rejected)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of equal texts."""
    docs = _numbered(docs)
    return _without(docs, exact_dedup.exact_dedup(docs, row_col="__row").where("not kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies (five-word shingles,
    similarity 0.8)."""
    docs = _numbered(docs)
    return _without(docs, near_dedup.near_dedup(docs, words=5, percent=80, side=10, row_col="__row").where("not kept"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents with a passage of the benchmark."""
    docs = _numbered(docs)
    found = decontaminate.contaminated(docs, read_table(spark, sf_dir, "benchmark"), row_col="__row")
    return _without(docs, found)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed pieces with their token ids."""
    with small_batches(spark):  # the tokens are written within
        return packing.pack(docs, tokenizer_file(), end_id=2)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack_documents),
]

#: The network and the tokenizer are not SQL; the tests hold the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
