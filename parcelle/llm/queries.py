"""The operators applied to the whole driver tables, and their DuckDB SQL.

Each query is thin: it reads its table, calls its operator with production
parameters and derives the digest columns from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.llm import bitplanes, decontaminate, exact_dedup, language_id, licenses, near_dedup, packing, pii, quality, ranked_search, repeats, token_counts, toxicity
from parcelle.llm.common import by_place, held_out, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return exact_dedup.exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE_SQL["op3_exact_dedup"] = """
WITH d AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return packing.pack(docs, tokenizer_file(), end_id=2).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs, ~held_out(F.col("doc_id")))
    out = language_id.identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return token_counts.token_counts(docs, tokenizer_file("piece_bpe_32k.model"))


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = quality.fit(docs, labels, ~held_out(F.col("doc_id")))
    return quality.score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return near_dedup.near_dedup(docs).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    items = read_table(spark, sf_dir, "benchmark")
    return decontaminate.contaminated(docs, items).drop("row")


#: The similarity of every item-sized window that holds a shingle of the item,
#: wherever it starts; no fingerprints.
ORACLE_SQL["op1_decontamination"] = """
WITH words AS (
    SELECT 'd' AS kind, doc_id AS id, list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
    FROM documents
    UNION ALL
    SELECT 'b', item_id, list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')
    FROM benchmark),
places AS (SELECT kind, id, w, len(w) AS n, unnest(range(0, len(w) - 4)) AS pos FROM words WHERE len(w) >= 5),
shingles AS (
    SELECT kind, id, n, pos, w[pos + 1] || ' ' || w[pos + 2] || ' ' || w[pos + 3] || ' ' || w[pos + 4] || ' ' || w[pos + 5] AS s
    FROM places),
in_item AS (SELECT id AS item_id, s, count(*) AS n_item FROM shingles WHERE kind = 'b' GROUP BY ALL),
sizes AS (SELECT item_id, sum(n_item) AS n_item FROM in_item GROUP BY ALL),
hits AS (
    SELECT DISTINCT d.id AS doc_id, b.id AS item_id, b.n AS length, d.n AS doc_n, d.pos, d.s
    FROM shingles d JOIN shingles b ON d.kind = 'd' AND b.kind = 'b' AND d.s = b.s),
aligned AS (
    SELECT DISTINCT d.id AS doc_id, b.id AS item_id, greatest(0, least(d.pos - b.pos, d.n - b.n)) AS start, true AS aligned
    FROM shingles d JOIN shingles b ON d.kind = 'd' AND b.kind = 'b' AND d.s = b.s),
windows AS (
    SELECT DISTINCT doc_id, item_id, length, doc_n,
           unnest(range(greatest(0, least(pos - length + 5, doc_n - length)), least(pos, greatest(0, doc_n - length)) + 1)) AS start
    FROM hits),
in_window AS (
    SELECT v.doc_id, v.item_id, v.start, v.length, v.doc_n, h.s, count(*) AS n_window
    FROM windows v JOIN hits h ON h.doc_id = v.doc_id AND h.item_id = v.item_id
        AND h.pos >= v.start AND h.pos < v.start + v.length - 4
    GROUP BY ALL),
shared AS (
    SELECT doc_id, item_id, start, length, sum(least(n_window, n_item)) AS shared, least(length, doc_n) - 4 AS n_window
    FROM in_window JOIN in_item USING (item_id, s) GROUP BY doc_id, item_id, start, length, doc_n),
scored AS (
    SELECT doc_id, item_id, start, length, shared::DOUBLE / (n_window + n_item - shared)::DOUBLE AS similarity
    FROM shared JOIN sizes USING (item_id))
SELECT doc_id, item_id, start::INTEGER AS start, length::INTEGER AS n_words, similarity
FROM scored LEFT JOIN aligned USING (doc_id, item_id, start) WHERE similarity >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, coalesce(aligned, false) DESC, start) = 1
"""


@query
def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = by_place(read_table(spark, sf_dir, "documents"))
    return repeats.remove_repeats(docs, row_col="__row").select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(read_table(spark, sf_dir, "documents"))
    # The kind is bound outside the lambda: a second parameter would be the position in the array.
    of = lambda kind: F.filter("base", lambda s: s["kind"] == kind)
    counts = [F.size(of(i)).cast("long").alias(f"n_{name}") for i, name in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.joined("base"), 256).alias("base_sha256"), pii.joined("spans").alias("spans"))


@query
def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree: the source is the top directory, then
    directories of a thousand and of fifty neighbouring ids."""
    docs = read_table(spark, sf_dir, "documents")
    path = F.concat_ws(
        "/", "source", F.floor(F.col("doc_id") / 1000).cast("string"), F.floor(F.col("doc_id") / 50).cast("string"),
        F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    found = licenses.scan_licenses(docs.select(path.alias("path"), "text"))
    return found.withColumn("doc_id", F.regexp_extract("path", r"([0-9]+)\.txt$", 1).try_cast("long")).drop("row")


@query
def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return ranked_search.ranked(docs, read_table(spark, sf_dir, "benchmark"), k=10)


ORACLE_SQL["op11_search"] = """
WITH terms AS (
    SELECT kind, id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark)),
postings AS (SELECT id, term, count(*) AS tf FROM terms WHERE kind = 'd' GROUP BY ALL),
lengths AS (SELECT id, sum(tf)::BIGINT AS n FROM postings GROUP BY ALL),
totals AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS big_l FROM lengths),
weights AS (
    SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM postings, totals GROUP BY term, big_n),
scores AS (
    SELECT b.id AS item_id, p.id AS doc_id,
           sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * big_n) // big_l))))::BIGINT AS score
    FROM (SELECT DISTINCT id, term FROM terms WHERE kind = 'b') b JOIN postings p USING (term)
    JOIN weights USING (term) JOIN lengths l ON l.id = p.id, totals
    GROUP BY ALL)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""


@query
def op12_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitplanes.cluster(read_table(spark, sf_dir, "embeddings")).drop("centroid")


def _clustering_sql(k: int = 16, rounds: int = 3) -> str:
    """Every round as a chain of common table expressions."""
    parts = [f"""
good AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, vec_id,
           list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
parts AS MATERIALIZED (SELECT rid, unnest(v) AS x, unnest(range(64)) AS p FROM good),
c0 AS MATERIALIZED (
    SELECT c, unnest(v) AS x, unnest(range(64)) AS p
    FROM (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR), v) - 1 AS c, v FROM good) WHERE c < {k})"""]
    for i in range(rounds + 1):
        parts.append(f"""
a{i} AS MATERIALIZED (
    SELECT rid, c, sum((s.x - t.x) * (s.x - t.x))::BIGINT AS distance
    FROM parts s JOIN c{i} t USING (p) GROUP BY rid, c
    QUALIFY row_number() OVER (PARTITION BY rid ORDER BY distance, c) = 1)""")
        if i < rounds:
            parts.append(f"""
c{i + 1} AS MATERIALIZED (
    SELECT o.c, o.p, coalesce(m.x, o.x) AS x FROM c{i} o LEFT JOIN (
        SELECT c, p, CASE WHEN sum(x) >= 0 THEN sum(x)::BIGINT // count(*)
                          ELSE -((-sum(x)::BIGINT + count(*) - 1) // count(*)) END AS x
        FROM a{i} JOIN parts USING (rid) GROUP BY c, p) m USING (c, p))""")
    return f"""WITH {",".join(parts)}
SELECT vec_id, a.c::INTEGER AS "cluster", distance, (sum(distance) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} a JOIN good USING (rid)
JOIN (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY p)) AS centroid_sha256 FROM c{rounds} GROUP BY c) h ON h.c = a.c
"""


ORACLE_SQL["op12_clustering"] = _clustering_sql()


@query
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    held = held_out(F.col("doc_id"), parts=3, part=1)
    model = toxicity.fit(docs, labels, ~held)
    return toxicity.score(docs, model).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
