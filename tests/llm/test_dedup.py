"""Exact and near duplicates and repeated byte strings against brute force."""

import hashlib
import re
import tracemalloc
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

from parcelle.llm import exact_dedup, near_dedup, repeats
from parcelle.llm.common import WORKER_BYTES, small_batches
from parcelle.llm.components import components
from parcelle.llm.queries import QUERIES
from parcelle.session import scratch_path
from tests.llm.conftest import table

LOWER = {i: i + 32 for i in range(65, 91)}


def plain(text):
    return (text or "").translate(LOWER)


@pytest.mark.parametrize("block_bytes", [7, 4096])
def test_exact_groups(docs, corpus, block_bytes):
    rows = corpus if block_bytes > 7 else [r for r in corpus if len(r[1] or "") < 3000]
    source = docs if block_bytes > 7 else table(docs.sparkSession, rows)
    groups = defaultdict(list)
    for i, text, _ in rows:
        groups[plain(text)].append(i)
    want = Counter()
    for text, ids in groups.items():
        keep = max(ids, key=lambda i: (i is not None, i))
        for i in ids:
            want[i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()] += 1
    out = exact_dedup.exact_dedup(source, block_bytes=block_bytes).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in out) == want
    assert sum(r["kept"] for r in out) == len(groups)
    assert all(r["doc_id"] == r["keep_id"] for r in out if r["kept"])


def test_hot_blocks_are_named_apart(spark):
    rows = [(i, "same text " * 5, "en") for i in range(300)] + [(300 + i, f"text {i}", "en") for i in range(20)]
    out = exact_dedup.exact_dedup(table(spark, rows), block_bytes=16).collect()
    assert Counter(r["group_size"] for r in out) == {300: 300, 1: 20}
    assert [r["doc_id"] for r in out if r["kept"] and r["group_size"] == 300] == [299]


def shingles(text, k):
    words = re.findall("[^\x20\x09-\x0d]+", plain(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) or frozenset([tuple(words)])


def brute_components(rows, k, percent):
    sets = [shingles(t, k) for _, t, _ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    groups = defaultdict(list)
    for a in range(len(rows)):
        groups[find(a)].append(a)
    out = {}
    for members in groups.values():
        ids = [rows[a][0] for a in members if rows[a][0] is not None]
        out |= {a: min(ids, default=None) for a in members}
    return sets, out, len(groups)


def test_near_components(docs, corpus):
    sets, want, n_groups = brute_components(corpus, 3, 85)
    out = near_dedup.near_dedup(docs).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out) == Counter(
        (corpus[a][0], len(sets[a]), want[a]) for a in want)
    assert sum(r["kept"] for r in out) == n_groups


def test_near_copies_of_varied_similarity(spark):
    import random

    rng, words = random.Random(3), [f"w{i}" for i in range(400)]
    base = rng.sample(words, 200)
    rows = []
    for i in range(120):
        copy = list(base)
        for at in rng.sample(range(200), rng.randint(0, 14)):
            copy[at] = f"n{i}_{at}"
        rows.append((i, " ".join(copy), "en"))
    _, want, n_groups = brute_components(rows, 3, 85)
    out = {r["doc_id"]: r["component_id"] for r in near_dedup.near_dedup(table(spark, rows)).collect()}
    assert 1 < n_groups < 120 and out == want


def test_a_worker_holds_a_bounded_multiple_of_its_texts(monkeypatch):
    texts = [(f"word{i} of text " * 130).encode() for i in range(2_000)]  # 4 MB
    near_dedup._powers.cache_clear()
    tracemalloc.start()
    sets = [hashlib.sha256(s.tobytes()).digest() for s in near_dedup.shingle_sets(texts, 3)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40_000_000, peak
    monkeypatch.setattr(near_dedup, "CHUNK_BYTES", 2_000_000)
    assert sets == [hashlib.sha256(s.tobytes()).digest() for s in near_dedup.shingle_sets(texts, 3)]


def test_workers_get_small_batches(spark, monkeypatch):
    """Batches of 10,000 rows of sets or texts filled the executors."""
    seen, write = [], near_dedup.written
    key = "spark.sql.execution.arrow.maxBytesPerBatch"

    def watched(df, name, **options):
        seen.append((name, spark.conf.get(key)))
        return write(df, name, **options)

    before = spark.conf.get(key)
    monkeypatch.setattr(near_dedup, "written", watched)
    rows = [(i, f"some words of text {i // 2} and again some words", "en") for i in range(60)]
    assert near_dedup.near_dedup(table(spark, rows)).count() == 60
    assert {n for n, size in seen if size == str(WORKER_BYTES)} >= {"sketches", "sets", "near_pairs", "links"}
    assert spark.conf.get(key) == before
    with small_batches(spark, 1 << 16):
        sizes = spark.range(0, 2_000, 1, 1).selectExpr("repeat('x', 1000) as text").mapInPandas(
            lambda frames: (f.head(1).assign(n=len(f))[["n"]] for f in frames), "n long").collect()
    assert max(r["n"] for r in sizes) < 100


def test_components_of_a_chain_and_a_star(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(7, 7)], "a long, b long")
    out = {r["node"]: r["root"] for r in components(links).collect()}
    assert out == {**dict.fromkeys(range(31), 0), **dict.fromkeys(range(100, 140), 100)}


def test_strings_that_differ_in_one_bit_have_other_names():
    import random

    for base in (random.Random(3).randbytes(200), b"e" * 200, bytes(200)):
        data = [base]
        for at in range(200):
            for bit in range(8):
                data.append(base[:at] + bytes([base[at] ^ (1 << bit)]) + base[at + 1:])
        names = repeats.bucket_names(np.frombuffer(b"".join(data), dtype=np.uint8))[2][::200]
        assert len(names) == len(set(names.tolist())) == 1601


def test_a_passage_followed_by_bytes_that_differ_in_the_top_bit(spark):
    import random

    from tests.llm.conftest import prose

    # U+00C3 to U+00FF begin with 0xC3, which is 'C' with the top bit set; quotes begin with 0xE2, 'b'
    passages = [prose(random.Random(i), 80)[:199] for i in range(2)]
    rows = [(1, passages[0] + "C one", "en"), (2, passages[0] + "\u00e9 two", "en"),
            (3, passages[1] + "b three", "en"), (4, passages[1] + "\u201d four", "en"),
            (5, passages[0][:150] + "x" + passages[1], "en"), (6, "y" + passages[1] + "b six", "en")]
    check_repeats(table(spark, rows), rows)


def test_repeated_bytes(docs, corpus):
    check_repeats(docs, corpus)


def check_repeats(docs, corpus):
    seen = Counter()
    data = [(t or "").encode() for _, t, _ in corpus]
    for b in data:
        seen.update(b[i:i + 200] for i in range(len(b) - 199))
    want = Counter()
    for (doc_id, _, _), b in zip(corpus, data, strict=True):
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if seen[b[i:i + 200]] > 1:
                gone[i:i + 200] = b"\1" * 200
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        want[doc_id, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), kept] += 1
    out = repeats.remove_repeats(docs).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in out) == want
    assert all(sum(b - a for a, b in r["spans"]) == r["n_removed"] for r in out)


def test_repeats_are_found_without_a_copy_of_the_texts(spark):
    scratch = Path(scratch_path(spark, "x").removeprefix("file:")).parent
    before = set(scratch.glob("*")) if scratch.exists() else set()
    assert QUERIES["op4_repeats"](spark, "/root/testdata/sf0.001").count() > 0
    for folder in set(scratch.glob("*")) - before:
        assert "text" not in spark.read.parquet(str(folder)).columns, folder


def test_pieces_of_long_texts_agree(spark, monkeypatch):
    import random

    from tests.llm.conftest import prose

    monkeypatch.setattr(repeats, "PIECE", 997)
    text = prose(random.Random(1), 900).encode()
    runs = list(repeats.window_runs([text, text[300:]]))
    covered = Counter()
    for part in runs:
        for r in part.itertuples():
            covered.update((r.text, i) for i in range(r.first, r.first + r.count))
    assert covered == Counter([(0, i) for i in range(len(text) - 199)] + [(1, i) for i in range(len(text) - 499)])


def test_empty_tables(empty):
    assert exact_dedup.exact_dedup(empty).count() == 0
    assert near_dedup.near_dedup(empty).count() == 0
    assert repeats.remove_repeats(empty).count() == 0
