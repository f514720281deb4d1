"""Ranked lexical search over an index with per-term geometric blocking.

Documents are cut into shards of a bounded number of postings; nothing is
shuffled by term, so a term in a third of all documents is spread over all
shards. Inside a shard every term's posting list is clustered by the
similarity of its documents (their term vectors, randomly projected) into
blocks of about ``BLOCK_DOCS``, and each block stores the coordinatewise
maximum of its documents' impacts, rounded up to a byte. A query walks its
terms' lists; a block, or a whole list tail, is skipped only if the exact
upper bound from these maxima is below the current k-th best score. All other
documents are scored exactly in integers, so results equal a full scan.

Scores: a term's weight is floor(1000 ln((2N+2)/(2df+1))), a document's impact
of a term is (10^9 tf) div (1000 tf + 8 m) with m = 10 + (90 n N) div L, and a
score is the sum of weight x impact over the query's distinct terms. N counts
the documents with a term, L all their terms, over all documents.

``forward`` (terms of each document), ``statistics``, ``build`` (the index, one
row per shard), ``floors`` and ``search`` are separate; ``ranked`` chains them for a set of
queries, in blocks of at most ``QUERY_TERMS`` distinct terms, whose documents'
other terms are not indexed. Every shard starts from a lower bound of the k-th
score, taken from an exact search of about ``SEED_DOCS`` documents, drawn by a
hash of their contents.

Defined results: a NULL or empty text has no terms and is never found; a query
without terms, or whose terms occur nowhere, gives no row; a query that
repeats is answered each time. Equal scores go by ascending doc_id (NULL
last); repeated rows of a document are ranked each. Whole texts are read,
however long. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelle.llm.common import written

#: Bounds of a shard: documents, postings, and documents x terms held at once.
SHARD_DOCS = 2048
SHARD_POSTINGS = 250_000
SHARD_CELLS = 16_000_000
BLOCK_DOCS = 128
#: A list this short is one block without a summary: its documents are scored
#: wherever the list as a whole is not skipped.
SHORT_LIST = 16
PROJECTION = 24
QUERY_TERMS = 200_000
#: Documents whose scores bound each query's k-th best score from below.
SEED_DOCS = 8192
#: Impacts are below 10^6; a summary's step rounds up to 1/255 of that.
STEP = 3922

_TERM_BYTES = frozenset([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
_FOLD = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if b in _TERM_BYTES else 0x20 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    """Maximal runs of digits, letters and all characters beyond ASCII; A-Z
    lower-cased."""
    return text.encode().translate(_FOLD).split()


class Statistics(NamedTuple):
    documents: int
    terms: int
    weights: np.ndarray  # by term id


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *(len(r) for r in rows)]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, kind))


def forward(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, terms, tf): length in terms, and the ids and counts of the
    terms of ``vocabulary`` in each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            sizes, ids, tfs = [], [], []
            for text in batch.column("text").to_pylist():
                words = terms_of(text or "")
                sizes.append(len(words))
                found = np.array([known[w] for w in words if w in known], np.int32)
                found, tf = np.unique(found, return_counts=True)
                ids.append(found.astype(np.int32))
                tfs.append(tf.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), _lists(ids, pa.int32()), _lists(tfs, pa.int32())],
                ["doc_id", "n", "terms", "tf"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(apply, "doc_id long, n long, terms array<int>, tf array<int>")


def statistics(table: DataFrame, size: int) -> Statistics:
    """Counts over all documents of ``forward``; ``size`` is the vocabulary's."""
    count, total = table.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(size, np.int64)
    for row in table.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        df[row["t"]] = row["count"]
    weights = [math.floor(1000 * math.log((2 * count + 2) / (2 * int(x) + 1))) if x else 0 for x in df]
    return Statistics(count, total, np.array(weights, np.int64))


def impacts(n: np.ndarray, tf: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """Impact of each count ``tf`` in a document of ``n`` terms."""
    lengths, of = np.unique(n, return_inverse=True)
    m = np.array([10 + 90 * int(x) * documents // max(1, terms) for x in lengths], np.int64)
    return (1_000_000_000 * tf.astype(np.int64)) // (1000 * tf.astype(np.int64) + 8 * m[of])


def _ranges(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All positions of the (non-empty) ranges, and where each range begins
    among them."""
    sizes = stop - start
    cuts = np.cumsum(sizes) - sizes
    return np.repeat(start - cuts, sizes) + np.arange(sizes.sum()), cuts


class Shard:
    """A blocked index over some documents.

    ``terms`` are the term ids that occur (columns), ``peak`` their largest
    impacts in steps, ``begin``/``column``/``impact`` the documents' vectors;
    list t has the blocks
    ``lists[t]:lists[t + 1]``, block b the documents
    ``docs[block[b]:block[b + 1]]`` and the summary (columns ``where``, maxima
    ``top``) at ``summary[b]:summary[b + 1]``, which is empty in short lists.
    """

    PARTS = {
        "doc_id": np.int64, "null_id": np.uint8, "terms": np.int32, "peak": np.uint8, "begin": np.int64,
        "column": np.uint16, "impact": np.int32, "lists": np.int64, "block": np.int64, "docs": np.uint16,
        "summary": np.int64, "where": np.uint16, "top": np.uint8,
    }
    #: Parts that hold columns: two bytes each where there are few enough.
    COLUMNS = ("column", "where")

    def __init__(self, parts: dict[str, np.ndarray]):
        self.__dict__.update(parts)

    @classmethod
    def of(cls, doc_id: np.ndarray, null_id: np.ndarray, sizes: np.ndarray, term: np.ndarray, impact: np.ndarray) -> Shard:
        """Index documents with ``sizes`` postings (``term``, ``impact``) each."""
        terms, column = np.unique(term, return_inverse=True)
        begin = np.concatenate([[0], np.cumsum(sizes)])
        of = np.repeat(np.arange(len(sizes)), sizes)
        level = np.zeros((len(sizes), len(terms)), np.uint8)
        level[of, column] = np.maximum(1, -(-impact // STEP))
        near = cls._projected(level)
        order = np.lexsort((of, column))
        ends = np.concatenate([[0], np.cumsum(np.bincount(column, minlength=len(terms)))])
        lists, block, docs, summary, where, top = [0], [0], [], [0], [], []
        for t in range(len(terms)):
            members = of[order[ends[t]:ends[t + 1]]]
            for part in cls._clustered(members, near):
                most = level[part].max(axis=0) if len(members) > SHORT_LIST else level[0, :0]
                some = np.flatnonzero(most)
                docs.append(part)
                block.append(block[-1] + len(part))
                where.append(some)
                top.append(most[some])
                summary.append(summary[-1] + len(some))
            lists.append(len(block) - 1)
        join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        parts = {"doc_id": doc_id, "null_id": null_id, "terms": terms, "peak": level.max(axis=0), "begin": begin,
                 "column": column, "impact": impact, "lists": lists, "block": block, "docs": join(docs),
                 "summary": summary, "where": join(where), "top": join(top)}
        return cls({k: np.asarray(parts[k]).astype(kind) for k, kind in cls._kinds(len(terms)).items()})

    @classmethod
    def _kinds(cls, columns: int) -> dict[str, type]:
        return cls.PARTS if columns <= 1 << 16 else cls.PARTS | dict.fromkeys(cls.COLUMNS, np.int32)

    @staticmethod
    def _projected(level: np.ndarray) -> np.ndarray:
        """Documents' vectors, rare terms weighing more, projected to a few
        dimensions and brought to unit length."""
        present = np.maximum(1, (level > 0).sum(axis=0))
        rng = np.random.default_rng(3)
        onto = rng.standard_normal((level.shape[1], PROJECTION)).astype(np.float32)
        onto *= np.log1p(len(level) / present).astype(np.float32)[:, None]
        near = level.astype(np.float32) @ onto
        return near / np.maximum(1e-9, np.linalg.norm(near, axis=1, keepdims=True))

    @staticmethod
    def _clustered(members: np.ndarray, near: np.ndarray) -> list[np.ndarray]:
        """The members around the nearest of evenly spaced ones."""
        n = -(-len(members) // BLOCK_DOCS)
        if n == 1:
            return [members]
        own = near[members]
        centres = own[np.linspace(0, len(members) - 1, n).astype(np.int64)]
        best = (own @ centres.T).argmax(axis=1)
        order = np.argsort(best, kind="stable")
        cuts = np.flatnonzero(np.diff(best[order])) + 1
        return np.split(members[order], cuts)

    def to_row(self) -> dict[str, bytes]:
        return {k: getattr(self, k).tobytes() for k in self.PARTS}

    @classmethod
    def from_row(cls, row: dict[str, bytes]) -> Shard:
        kinds = cls._kinds(len(row["terms"]) // np.dtype(cls.PARTS["terms"]).itemsize)
        return cls({k: np.frombuffer(row[k], kind) for k, kind in kinds.items()})

    def bounds(self, blocks: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Exact upper bounds of the scores in ``blocks``, which have
        summaries."""
        at, cuts = _ranges(self.summary[blocks], self.summary[blocks + 1])
        return np.add.reduceat(weight[self.where[at]] * self.top[at].astype(np.int64), cuts) * STEP

    def scores(self, docs: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Exact scores of ``docs``."""
        at, cuts = _ranges(self.begin[docs], self.begin[docs + 1])
        return np.add.reduceat(weight[self.column[at]] * self.impact[at].astype(np.int64), cuts)

    def search(self, query: np.ndarray, weights: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents and scores of the k best of at least ``floor``, and how
        many documents were scored. ``query`` holds distinct term ids."""
        at = np.searchsorted(self.terms, query)
        at = at[(at < len(self.terms)) & (self.terms[np.minimum(at, len(self.terms) - 1)] == query)] if len(self.terms) else at[:0]
        weight = np.zeros(len(self.terms), np.int64)
        weight[at] = weights[self.terms[at]]
        at = at[weight[at] > 0]
        best_doc, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
        seen = np.zeros(len(self.doc_id), bool)
        # A list's own bound: its weight times the largest impact there is.
        most = weight[at] * self.peak[at].astype(np.int64) * STEP
        order = np.argsort(-most, kind="stable")
        at, most = at[order], most[order]
        left = np.cumsum(most[::-1])[::-1] if len(most) else most
        threshold = max(1, floor)
        for i, t in enumerate(at):
            if left[i] < threshold:
                break  # documents in none of the lists before cannot reach it
            blocks = np.arange(self.lists[t], self.lists[t + 1])
            bound = self.bounds(blocks, weight) if self.summary[blocks[0]] < self.summary[blocks[0] + 1] else left[i:i + 1]
            turn = np.argsort(-bound, kind="stable")
            step = 1
            while len(turn):
                turn = turn[bound[turn] >= threshold]
                now, turn = turn[:step], turn[step:]
                step *= 4
                if not len(now):
                    break
                docs = np.concatenate([self.docs[self.block[b]:self.block[b + 1]] for b in blocks[now]])
                docs = docs[~seen[docs]].astype(np.int64)
                if not len(docs):
                    continue
                seen[docs] = True
                score = self.scores(docs, weight)
                good = score >= threshold
                best_doc, best = np.concatenate([best_doc, docs[good]]), np.concatenate([best, score[good]])
                if len(best) > k:
                    keep = np.lexsort((best_doc, self.doc_id[best_doc], self.null_id[best_doc], -best))[:k]
                    best_doc, best = best_doc[keep], best[keep]
                if len(best) == k:
                    threshold = max(threshold, int(best.min()))
        return best_doc, best, int(seen.sum())


def _shards(batches: Iterator[pa.RecordBatch], documents: int, total: int, size: int) -> Iterator[Shard]:
    """Shards over batches of ``forward``; ``size`` is the vocabulary's."""
    held: list[tuple] = []
    docs = postings = columns = 0
    seen = np.zeros(size, bool)

    def finished() -> Shard:
        ids, nulls, n, sizes, term, tf = (np.concatenate(x) for x in zip(*held, strict=True))
        return Shard.of(ids, nulls, sizes, term, impacts(np.repeat(n, sizes), tf, documents, total))

    for batch in batches:
        sizes = pc.list_value_length(batch.column("terms")).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = batch.column("doc_id")
        nulls = ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8)
        ids, n = pc.fill_null(ids, 0).to_numpy(), batch.column("n").to_numpy()
        term, tf = (batch.column(c).flatten().to_numpy() for c in ("terms", "tf"))
        for d in np.flatnonzero(sizes > 0).tolist():
            own = slice(ends[d], ends[d + 1])
            columns += int((~seen[term[own]]).sum())
            postings += int(sizes[d])
            if docs and (docs == SHARD_DOCS or postings > SHARD_POSTINGS or (docs + 1) * columns > SHARD_CELLS):
                yield finished()
                held, docs, postings, columns = [], 0, int(sizes[d]), int(sizes[d])
                seen[:] = False
            seen[term[own]] = True
            held.append((ids[d:d + 1], nulls[d:d + 1], n[d:d + 1], sizes[d:d + 1], term[own], tf[own]))
            docs += 1
    if docs:
        yield finished()


def build(table: DataFrame, known: Statistics) -> DataFrame:
    """The index over ``forward``: one row per shard, written."""
    documents, total, size = known.documents, known.terms, len(known.weights)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches, documents, total, size):
            row = shard.to_row()
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(shard.doc_id)], pa.int64()), *(pa.array([row[k]], pa.binary()) for k in Shard.PARTS)],
                ["n_docs", *Shard.PARTS])

    schema = "n_docs long, " + ", ".join(f"`{k}` binary" for k in Shard.PARTS)
    return written(table.mapInArrow(apply, schema), "search_index", file_rows=4)


FOUND = "query int, doc_id long, score long, scored long"


def _found(shard: Shard, queries: list[np.ndarray], weights: np.ndarray, k: int, floors: list[int]) -> pa.RecordBatch:
    """The k best of each query in a shard, as rows of ``FOUND``."""
    number, doc, score, nulls, scored = [], [], [], [], []
    for q, terms in enumerate(queries):
        docs, values, many = shard.search(terms, weights, k, floors[q])
        number.append(np.full(len(docs), q, np.int32))
        doc.append(shard.doc_id[docs])
        nulls.append(shard.null_id[docs].astype(bool))
        score.append(values)
        scored.append(np.full(len(docs), many, np.int64))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(number)), pa.array(np.concatenate(doc), mask=np.concatenate(nulls)),
         pa.array(np.concatenate(score)), pa.array(np.concatenate(scored))],
        ["query", "doc_id", "score", "scored"])


def search(index: DataFrame, queries: list[np.ndarray], weights: np.ndarray, k: int, floors: list[int] | None = None) -> DataFrame:
    """(query, doc_id, score, scored): of each shard the k best documents of
    each query, by its number, that reach ``floors``."""
    shared = index.sparkSession.sparkContext.broadcast((queries, weights, floors or [1] * len(queries)))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weight, least = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_buffer() for name in Shard.PARTS}
                yield _found(Shard.from_row(row), asked, weight, k, least)

    return index.mapInArrow(apply, FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def floors(table: DataFrame, known: Statistics, queries: list[np.ndarray], k: int) -> list[int]:
    """Lower bounds of each query's k-th best score: the k-th best of a drawn
    part of ``forward``."""
    share = min(1.0, SEED_DOCS / max(1, known.documents))
    drawn = table.where(F.pmod(F.xxhash64("doc_id", "n", "terms"), F.lit(1_000_000)) < F.lit(share * 1_000_000))
    shared = table.sparkSession.sparkContext.broadcast((queries, known))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, (documents, total, weights) = shared.value
        for shard in _shards(batches, documents, total, len(weights)):
            yield _found(shard, asked, weights, k, [1] * len(asked))

    out = [1] * len(queries)
    best = _best(drawn.mapInArrow(apply, FOUND), k)
    for row in best.where(F.col("rank") == k).select("query", "score").collect():
        out[row["query"]] = row["score"]
    return out


def query_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """The queries with their distinct terms, in blocks of at most
    ``QUERY_TERMS`` of them (one query at least)."""
    block, size = [], 0
    rows = items.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t"))
    for row in rows.toLocalIterator():
        terms = sorted(set(terms_of(row["t"] or "")))
        if block and size + len(terms) > QUERY_TERMS:
            yield block
            block, size = [], 0
        block.append((row["i"], terms))
        size += len(terms)
    if block:
        yield block


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item."""
    spark = docs.sparkSession
    parts = [_ranked_block(spark, docs, block, k, id_col, text_col) for block in query_blocks(items, item_col, item_text_col)]
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionAll, parts)


def _ranked_block(spark: SparkSession, docs: DataFrame, block: list, k: int, id_col: str, text_col: str) -> DataFrame:
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, terms in block for t in terms}))}
    table = written(forward(docs, vocabulary, id_col, text_col), "forward")
    known = statistics(table, len(vocabulary))
    index = build(table, known)
    queries = [np.array([vocabulary[t] for t in terms], np.int64) for _, terms in block]
    best = _best(search(index, queries, known.weights, k, floors(table, known, queries, k)), k)
    names = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(block)], "query int, item_id long")
    return best.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")
