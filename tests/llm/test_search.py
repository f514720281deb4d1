"""Ranked lexical search against a plain full scan."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from parcelle.llm import ranked_search
from parcelle.llm.common import written
from parcelle.llm.ranked_search import Shard, Statistics, build, forward, ranked, search, statistics
from tests.llm.conftest import prose, table

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    """(item, rank, doc, score); repeated ids are no problem for the scores."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    big_n, big_l = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        found = []
        for i, bag in bags:
            n = sum(bag.values())
            m = 100 - 90 + (90 * n * big_n) // max(1, big_l)
            score = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 8 * m))
                        for t in set(terms(text)) if bag[t])
            if score > 0:
                found.append((-score, math.inf if i is None else i))
        out += [(item, r, None if i == math.inf else i, -s) for r, (s, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def run(spark, docs, items, **how):
    out = ranked(table(spark, [(i, t, "en") for i, t in docs]), table(spark, [(i, t, "x") for i, t in items]), item_col="doc_id", **how)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_terms_keep_characters_beyond_ascii():
    text = "Élan vital — naïve_X9\x7fa`b\u0085c  ÀB\U0001f600q.\x00z"
    assert [t.decode() for t in ranked_search.terms_of(text)] == terms(text)


def test_equals_full_scan(spark, corpus):
    docs = [(i, t) for i, t, _ in corpus]
    items = [(1, docs[3][1]), (2, docs[46][1]), (3, None), (4, "  ..  "), (5, "nowhere zzzzzz"), (6, "The OF of and"),
             (6, "The OF of and"), (None, "one two"), (8, docs[-3][1])]
    assert run(spark, docs, items) == brute(docs, items)


def test_ties_by_id_and_hot_term(spark):
    rng = random.Random(3)
    docs = [(900 - i, "same words here") for i in range(40)] + [(i, prose(rng, 30) + " common") for i in range(300)]
    docs += [(None, "same words here"), (880, "same words here")]
    items = [(1, "same words"), (2, "common the of"), (3, docs[200][1])]
    assert run(spark, docs, items) == brute(docs, items)
    assert run(spark, docs, items, k=3) == brute(docs, items, k=3)


def test_empty_tables(spark, empty):
    docs = table(spark, [(1, "a b", "en")])
    assert ranked(docs, empty, item_col="doc_id").count() == 0
    assert ranked(empty, docs, item_col="doc_id").count() == 0
    assert ranked(table(spark, [(1, None, "x"), (2, " ", "x")]), docs, item_col="doc_id").count() == 0


def test_queries_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "QUERY_TERMS", 12)
    rng = random.Random(9)
    docs = [(i, prose(rng, 25)) for i in range(60)]
    items = [(i, prose(rng, 8)) for i in range(6)] + [(7, prose(rng, 30))]
    blocks = list(ranked_search.query_blocks(table(spark, [(i, t, "x") for i, t in items]), "doc_id", "text"))
    assert len(blocks) > 3 and sum(len(b) for b in blocks) == 7
    assert run(spark, docs, items) == brute(docs, items)


def shard(rng, n_docs, vocabulary, families):
    """A shard of documents of a few families that share most terms."""
    cores = [rng.choice(vocabulary, 12, replace=False) for _ in range(families)]
    rows, tfs = [], []
    for d in range(n_docs):
        own = np.unique(np.concatenate([cores[d % families], rng.choice(vocabulary, 6)]))
        rows.append(own)
        tfs.append(rng.integers(1, 4, len(own)))
    sizes = np.array([len(r) for r in rows])
    n = np.repeat(np.array([t.sum() for t in tfs]), sizes)
    impact = ranked_search.impacts(n, np.concatenate(tfs), n_docs, int(n.sum()))
    return Shard.of(np.arange(n_docs)[::-1].copy(), np.zeros(n_docs, np.uint8), sizes, np.concatenate(rows), impact), cores


@pytest.mark.parametrize("seed", range(4))
def test_blocks_skip_without_loss(monkeypatch, seed):
    monkeypatch.setattr(ranked_search, "BLOCK_DOCS", 16)
    rng = np.random.default_rng(seed)
    index, cores = shard(rng, 600, 300, 12)
    weights = rng.integers(0, 5000, 300)
    index = Shard.from_row(index.to_row())
    assert sum(len(index.docs[index.block[b]:index.block[b + 1]]) for b in range(len(index.block) - 1)) == len(index.column)
    scored = 0
    for q in [*cores, *(rng.choice(300, 10, replace=False) for _ in range(20)), np.array([1]), np.array([], np.int64), np.array([5000])]:
        weight = np.zeros(len(index.terms), np.int64)
        on = np.isin(index.terms, q)
        weight[on] = weights[index.terms[on]]
        full = index.scores(np.arange(600), weight)
        for b in range(0, len(index.block) - 1, 7):
            if index.summary[b + 1] > index.summary[b]:
                members = index.docs[index.block[b]:index.block[b + 1]]
                assert index.bounds(np.array([b]), weight)[0] >= full[members].max()
        want = [(d, s) for d, s in sorted(zip(index.doc_id.tolist(), full.tolist(), strict=True), key=lambda x: (-x[1], x[0])) if s > 0][:10]
        docs, got, many = index.search(q, weights if len(q) == 0 or q.max() < 300 else np.zeros(5001, np.int64), 10, 1)
        if len(q) == 0 or q.max() < 300:
            assert sorted(zip(index.doc_id[docs].tolist(), got.tolist(), strict=True), key=lambda x: (-x[1], x[0])) == want
        scored += many
    assert scored < 0.5 * 600 * (len(cores) + 21)   # blocks and lists are skipped


def test_floor_drops_only_what_is_below():
    rng = np.random.default_rng(0)
    index, cores = shard(rng, 300, 200, 6)
    weights = rng.integers(1, 5000, 200)
    docs, got, _ = index.search(cores[0], weights, 10, 1)
    floor = int(np.sort(got)[-4])
    again, values, _ = index.search(cores[0], weights, 10, floor)
    assert sorted(values.tolist()) == sorted(got[got >= floor].tolist()) or len(values) == 10


def test_stages_apart(spark):
    """The index serves several searches; unknown terms weigh nothing."""
    docs = table(spark, [(i, f"alpha beta w{i}", "en") for i in range(30)] + [(99, None, "en")])
    vocabulary = {t: i for i, t in enumerate([b"alpha", b"beta", b"nowhere", b"w7"])}
    rows = written(forward(docs, vocabulary), "forward")
    known = statistics(rows, len(vocabulary))
    assert isinstance(known, Statistics) and (known.documents, known.terms) == (30, 90) and known.weights[2] == 0
    index = build(rows, known)
    assert index.agg({"n_docs": "sum"}).first()[0] == 30
    found = search(index, [np.array([3]), np.array([2])], known.weights, 5).collect()
    assert [(r["query"], r["doc_id"]) for r in found] == [(0, 7)]
