"""Language ID, token counts, quality, packing, personal data, licences and
decontamination: brute force, exact round trips, held-out accuracy."""

import hashlib
import random
import re
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from parcelle.llm import decontaminate, language_id, licenses, packing, pii, quality, token_counts
from parcelle.llm.common import held_out, in_parts, written
from parcelle.llm.queries import QUERIES, tokenizer_file
from tests.llm.conftest import prose, table


def test_held_out_is_crc32_mod_4(spark):
    got = {r[0]: r[1] for r in spark.range(40).select("id", held_out(F.col("id"))).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(40)}


@pytest.mark.parametrize("sizes", [[], [0], [0, 0], [9, 1, 0], [3, 3, 3, 3, 1], [2, 40, 1]])
def test_parts_cover_a_batch_in_turn_and_are_bounded(sizes):
    batch = pd.Series(["é" * n for n in sizes], dtype=object)
    parts = [batch.iloc[s].tolist() for s in in_parts(batch, 5)]
    assert [x for part in parts for x in part] == batch.tolist()
    assert all(part and sum(map(len, part[:-1])) < 5 for part in parts)


def test_a_worker_holds_no_whole_batch(spark, monkeypatch):
    rng, seen = random.Random(4), []
    texts = [prose(rng, 30) for _ in range(40)]
    model, plain = language_id.ByteGru(["a", "b"], 3), language_id.document_probabilities
    monkeypatch.setattr(language_id, "document_probabilities", lambda m, data: seen.append(sum(map(len, data))) or plain(m, data))
    predict = {}
    monkeypatch.setattr(F, "pandas_udf", lambda *_: lambda f: predict.setdefault("f", f) and (lambda c: F.lit(None).cast("struct<lang:string,score:double>")))
    monkeypatch.setattr(language_id, "PART_CHARS", 1000)
    language_id.identify(table(spark, []), model)
    (out,) = predict["f"](iter([pd.Series(texts)]))
    assert max(seen) < 1000 + max(map(len, texts)) and len(seen) > 1
    assert np.allclose(out["score"], plain(model, [x.encode() for x in texts]).max(axis=1), atol=1e-6)


def test_gru_gradients_match_differences():
    rng = np.random.default_rng(0)
    model = language_id.ByteGru(["a", "b"], 3)
    for k in model.weights:
        model.weights[k] = model.weights[k].astype(np.float64)
    x, mask, y = rng.integers(97, 100, (4, 6)).astype(np.uint8), np.ones((4, 6), bool), np.array([0, 1, 0, 1])
    mask[2, 4:] = False
    _, grads = model.gradients(x, mask, y)
    for name, at in (("back", (0, 1, 2)), ("back", (1, 2, 7)), ("out", (1, 2, 0)), ("bias", (1,)), ("table", (0, 98, 4))):
        w, kept = model.weights[name], model.weights[name][at]
        w[at] = kept + 1e-2
        up = model.gradients(x, mask, y)[0]
        w[at] = kept - 1e-2
        down = model.gradients(x, mask, y)[0]
        w[at] = kept
        assert abs((up - down) / 2e-2 - grads[name][at]) < 2e-3


def test_language_of_held_out_texts(spark, empty):
    rng = random.Random(2)
    sounds = {"aa": ["ka", "ko", "ki"], "bb": ["tze", "sch", "un"], "cc": ["é", "ou", "eau"]}
    rows = [(i, " ".join("".join(rng.choices(s, k=3)) for _ in range(30)), lang)
            for i, (lang, s) in enumerate(list(sounds.items()) * 40)]
    rows += [(900, None, "aa"), (901, "", None), (902, "12 !", "aa"), (None, "kakoki", None)]
    docs = table(spark, rows)
    model = language_id.fit(docs, ~held_out(F.col("doc_id")), steps=60)
    out = language_id.identify(docs, model).select("doc_id", "lang", "lang_pred", "score").collect()
    assert {r["lang_pred"] for r in out if r["doc_id"] in (900, 901, 902)} == {"und"}
    known = [r for r in out if r["doc_id"] is not None and r["doc_id"] < 900]
    assert np.mean([r["lang"] == r["lang_pred"] for r in known]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in out)
    assert language_id.fit(empty, F.lit(True)) is None
    assert language_id.identify(docs, None).where("lang_pred <> 'und'").count() == 0
    assert language_id.identify(empty, model).count() == 0


def greedy(pieces, text):
    most, n = max(map(len, pieces)), 0
    for word in re.split(rb"[ \t-\r]+", text.encode()):
        word, at = "▁".encode() + word if word else b"", 0
        while at < len(word):
            at += next(k for k in range(min(most, len(word) - at), 0, -1) if word[at:at + k] in pieces)
            n += 1
    return n


def test_token_counts_are_greedy(docs, corpus, empty):
    path = tokenizer_file("piece_bpe_32k.model")
    pieces = set(token_counts.read_pieces(path))
    out = sorted((r["doc_id"] or -1, r["n_tokens"]) for r in token_counts.token_counts(docs, path).collect())
    assert out == sorted((i or -1, greedy(pieces, t or "")) for i, t, _ in corpus)
    assert token_counts.token_counts(empty, path).count() == 0


def test_automaton_on_random_vocabularies():
    rng = random.Random(9)
    for _ in range(30):
        pieces = {bytes([b]) for b in range(256)} | {"".join(rng.choices("ab", k=rng.randint(2, 6))).encode() for _ in range(12)}
        texts = ["".join(rng.choices("ab ", k=40)) for _ in range(20)]
        got, _ = token_counts.LongestMatch(sorted(pieces)).count([t.encode() for t in texts])
        assert got.tolist() == [greedy(pieces, t) for t in texts]


def test_quality_learns_and_scores_every_row(spark, empty):
    rng = random.Random(4)
    rows = [(i, prose(rng, 40) if i % 2 else prose(rng, 40).upper().replace(" ", "!! "), "en") for i in range(400)]
    rows += [(1000, None, None), (1001, "", None), (None, "x", None)]
    docs = table(spark, rows)
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(5, 1), (None, 1), (7, None)], "doc_id long, quality int")
    model = quality.fit(docs, labels, ~held_out(F.col("doc_id")))
    out = quality.score(docs.select("doc_id", "text"), model).collect()
    held = [r for r in out if r["doc_id"] is not None and r["doc_id"] < 400 and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert np.mean([(r["score"] >= 0.7) == bool(r["doc_id"] % 2) for r in held]) > 0.97
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    nothing = quality.fit(docs, labels.where("false"), F.lit(True))
    assert {r["score"] for r in quality.score(docs, nothing).collect()} == {0.5}
    assert quality.score(empty, model).count() == 0


@pytest.fixture(scope="module")
def packed(docs):
    return packing.pack(docs, tokenizer_file(), window=256, grid=16).collect()


def test_packing_round_trip(packed, corpus):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file())
    want = sorted([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for i, t, _ in corpus if i is not None and i != 50)
    pieces = {}
    for r in packed:
        if r["doc_id"] is not None and r["doc_id"] != 50:
            pieces.setdefault(r["doc_id"], []).append(r)
    got = []
    for parts in pieces.values():
        parts.sort(key=lambda r: r["start"])
        ids = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in parts]).tolist()
        assert [r["start"] for r in parts] == np.cumsum([0, *(r["length"] for r in parts)]).tolist()[:-1]
        assert {r["doc_tokens"] for r in parts} == {len(ids)}
        got.append(ids)
    assert sorted(got) == want


def test_sequences_are_gapless_and_full(packed):
    sequences = {}
    for r in packed:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        parts.sort()
        assert [p[0] for p in parts] == np.cumsum([0, *(p[1] for p in parts)]).tolist()[:-1]
        total = sum(p[1] for p in parts)
        assert total <= 256 and total & (total - 1) == 0


def test_tokens_equal_the_tokenizer(empty):
    from parcelle.llm.tokens import encode_texts, load_tokenizer

    path = tokenizer_file()
    texts = ["á éÉ  x", "don't CAN'T it's. 'sx's", "<|endoftext|>x", "Σας ΣΑΣ İstanbul ﬁ ½", "a\x1cb \x1dc", "", " 　x\u0085y",
             "日本語 😀😀 1234 5,6. a.b, ß ẞ ÿ Ÿ", "foo.. bar,. baz.,", "Über, naïve. ÀÉ"]
    want = [load_tokenizer(path).encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in encode_texts(path, texts)] == want
    assert packing.pack(empty, path).count() == 0


def test_marks_and_forgotten_words_leave_the_tokens_alone(monkeypatch):
    from parcelle.llm import tokens

    path, rng = tokenizer_file(), random.Random(8)
    letters = [*"abzXYZÀéßÿöñ012 \t\n'\"<>|.,;:!?%$&*()[]{}`~^_-+=@#\\/\x1c×÷µªºİσΣ日😀\u0301\x00\x7f\x80\xa0\xad", "<|endoftext|>", "'s", "'re"]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(2_000)]
    tokenizer = tokens.load_tokenizer(path)
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    monkeypatch.setattr(tokens, "MEMORY_WORDS", 500)
    monkeypatch.setattr(tokens, "GROUP_CHARS", 1_000)
    assert [np.frombuffer(x, "<u4").tolist() for x in tokens.encode_texts(path, texts)] == want
    assert sum(map(len, tokens._memory(path))) < 1_500


def test_a_word_in_use_is_not_encoded_again(monkeypatch):
    """A full memory was emptied, and every word encoded anew."""
    from parcelle.llm import tokens

    class Model:
        def tokenize(self, form):
            seen[form] += 1
            return model.tokenize(form)

    path, seen = tokenizer_file(), Counter()
    model, encode = tokens.load_tokenizer(path).model, tokens.load_tokenizer(path).encode
    monkeypatch.setattr(tokens, "load_tokenizer", lambda _: SimpleNamespace(model=Model(), encode=encode))
    monkeypatch.setattr(tokens, "MEMORY_WORDS", 200)
    word = lambda i: "qz" + "".join(chr(97 + int(d)) for d in str(i))
    for i in range(0, 2_000, 50):
        list(tokens.encode_texts(path, ["qzcommon (qzcommon) qzcommon!! " + " ".join(word(j) for j in range(i, i + 50))]))
    assert seen["qzcommon"] == 1 and len(seen) > 2_000


def test_nnls_and_repeat_counts():
    a, b = np.array([[1.0, 0, 1], [0, 1, 1]]), np.array([2.0, -1])
    assert np.allclose(packing.nnls(a, b), [2, 0, 0])
    rng = np.random.default_rng(1)
    a, b = rng.random((6, 12)), rng.random(6)
    x = packing.nnls(a, b)
    slope = a.T @ (b - a @ x)
    assert (x >= 0).all() and (slope < 1e-6).all() and np.allclose(slope[x > 0], 0, atol=1e-6)
    histogram = {1: 9, 2: 7, 3: 8, 4: 1, 7: 5}
    used = {}
    for way, n in packing.repeat_counts(histogram, 8, 4):
        assert sum(way) == 8
        for part in way:
            used[part] = used.get(part, 0) + n
    assert used and all(used[k] <= histogram[k] for k in used)


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        odd = sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits)))
        return 12 <= len(digits) <= 19 and odd % 10 == 0
    return True


def test_base_spans_are_exact(spark, empty):
    rng = random.Random(8)
    parts = ["4111 1111 1111 1111", "4111-1111-1111-1112", "a.b@c.de", "@x", "a@b", "1.2.3.4", "1.2.3.4.5.6.7.8.9", "999.1.1.1",
             "000255.1.1.0001", "+1 (988) 555-2485", "+12", "+123456789012345678", "é", "😀", "x@y.z@w.v", "_a@b.c_d@e.f", " ", "\n", "..", "5" * 30,
             "joe [at] mail dot com", "555-123-4567", "mail: "]
    rows = [(i, "".join(rng.choices(parts, k=12)), "en") for i in range(150)]
    rows += [(200, None, None), (201, "", None), (202, "a@" + "b." * 4000 + "c", "en"), (203, "x" * 50_000, "en"), (None, "q@w.er", "en")]
    out = {r["doc_id"]: r for r in pii.find_pii(table(spark, rows)).collect()}
    for i, text, _ in rows:
        want = sorted((m.start(), k, m.end()) for k, (kind, pattern) in enumerate(BASE)
                      for m in re.finditer(pattern, text or "") if passes(kind, m[0]))
        assert [tuple(s) for s in out[i]["base"]] == want, text
        assert set(out[i]["base"]) <= set(out[i]["spans"])
    assert pii.find_pii(empty).count() == 0


def test_counts_of_the_query_are_of_their_kind(spark, tmp_path):
    texts = ["a@b.de", "a@b.de c@d.fr 1.2.3.4", "+33 1 23 45 67 89", "4111 1111 1111 1111 and 1.2.3.4 1.2.3.5 1.2.3.6", "none", None]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for row in QUERIES["op7_pii"](spark, str(tmp_path)).collect():
        spans = [(m.start(), k, m.end()) for k, (kind, pattern) in enumerate(BASE)
                 for m in re.finditer(pattern, texts[row["doc_id"]] or "") if passes(kind, m[0])]
        assert [row[f"n_{kind}"] for kind, _ in BASE] == [sum(s[1] == k for s in spans) for k in range(4)]
        joined = ",".join(f"{BASE[k][0]}:{start}:{end}" for start, k, end in sorted(spans))
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()


def test_addresses_spelled_with_brackets_are_searched(spark):
    rows = spark.createDataFrame([(1, "write to joe [at] mail [dot] org today")], "row long, text string")
    assert [r["match"] for r in pii._matches(rows, pii.GENERATORS, True).collect()] == ["joe [at] mail [dot] org"]


def planted(rng, n):
    """Texts with base matches, other numbers and failing matches, and what
    is planted beside them: (texts, spans to add by text, numbers to leave)."""
    def at_some_place(part):
        words = prose(rng, rng.randint(6, 20)).split()
        k = rng.randrange(1, len(words))
        return " ".join(words[:k]) + " " + part + " " + " ".join(words[k:])

    digits = lambda k: "".join(rng.choices("0123456789", k=k))
    name = lambda: "".join(rng.choices("abcdefghijklmno", k=rng.randint(3, 8)))
    rows, added, left = [], {}, {}
    for i in range(n):
        own = [f"{name()}.{digits(2)}@{name()}.example.com", f"+1 ({digits(3)}) 555-{digits(4)}", f"{rng.randint(1, 255)}.8.{rng.randint(0, 255)}.4",
               f"{digits(16)}", f"20{digits(2)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}", f"no {digits(7)}", f"{digits(3)},{digits(2)}"]
        rows.append([i, ". ".join(at_some_place(p) for p in rng.sample(own, 4)), "en"])
    for i in range(0, n, 5):
        good = [f"{name()} [at] {name()} [dot] org", f"{name()}(at){name()}.com", f"({digits(3)}) 555-{digits(4)}", f"{digits(3)}-555-{digits(4)}",
                f"{digits(3)}.555.{digits(4)}"]
        part = good[i // 5 % len(good)]
        bad = rng.choice([f"order {digits(8)}", f"20{digits(2)}-11-0{rng.randint(1, 9)}", f"{digits(2)}/{digits(2)}/20{digits(2)}", f"{digits(6)}.{digits(2)}"])
        text = rows[i][1] + ". Now " + at_some_place(part) + ". And " + at_some_place(bad)
        rows[i][1], added[i], left[i] = text, (text.rindex(part), text.rindex(part) + len(part)), (text.rindex(bad), text.rindex(bad) + len(bad))
    return [tuple(r) for r in rows], added, left


def test_spans_beside_the_base_patterns_are_added(spark):
    rows, added, left = planted(random.Random(12), 600)
    out = {r["doc_id"]: r for r in pii.find_pii(table(spark, rows)).collect()}
    base = {i: {tuple(s) for s in r["base"]} for i, r in out.items()}
    more = {i: {(s[0], s[2]) for s in map(tuple, r["spans"])} - {(a, e) for a, _, e in base[i]} for i, r in out.items()}
    caught = [added[i] in more[i] for i in added]
    assert np.mean(caught) >= 0.9, np.mean(caught)
    wrong = [s for i in left for s in more[i] if s[0] < left[i][1] and left[i][0] < s[1]]
    assert len(wrong) <= 0.02 * len(left)
    beside = sum(len(x) for x in more.values())
    assert beside <= sum(caught) + 0.05 * len(rows)
    for i, text, _ in rows:   # the base spans are what they were
        assert base[i] == {(m.start(), k, m.end()) for k, (kind, pattern) in enumerate(BASE) for m in re.finditer(pattern, text) if passes(kind, m[0])}


def test_thresholds_come_from_rows_that_were_not_fitted():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2, (400, len(pii.FEATURES)))
    x[:, 0] = 3
    y = x[:, 1].astype(float)
    held = np.arange(400) % 4 == 0
    flipped = np.where(held, 1 - y, y)           # what was fitted does not hold there
    assert pii.boost(x, y, np.ones(400), held=held).thresholds[3] is not None
    assert pii.boost(x, flipped, np.ones(400), held=held).thresholds[3] is None


def test_accepted_candidates_that_chain_stay_covered(spark):
    rows = [(i, f"call +1 (20{i % 9}) 555-01{i % 90 + 10} or call (20{i % 9}) 555-01{i % 90 + 10} 555-9999 now", "en") for i in range(200)]
    rows += [(500 + i, f"number {10**11 + i * 7919} and 20{i % 90 + 10}-01-02", "en") for i in range(100)]
    out = pii.find_pii(table(spark, rows)).collect()
    spans = [{tuple(s) for s in r["spans"]} - {tuple(s) for s in r["base"]} for r in out if r["doc_id"] < 500]
    assert np.mean([bool(s) for s in spans]) > 0.8
    for own in spans:
        assert not any(a != b and a[0] <= b[0] and b[2] <= a[2] for a in own for b in own)   # none inside another


def test_boosting_separates_bins():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 4, (500, len(pii.FEATURES)))
    y = ((x[:, 1] > 1) ^ (x[:, 2] > 2)).astype(float)
    model = pii.boost(x, y, np.ones(500))
    assert np.mean((model.raw(x) > 0) == (y > 0)) > 0.95


def test_license_headers_and_inheritance(spark):
    rows = [("a/LICENSE", "Released under the MIT License."), ("a/x.py", "code code"), ("a/b/y.py", "text\nLicensed under CC BY-NC 4.0.\n" + "more words of code here " * 5),
            ("a/b/z.py", None), ("a/b/c/LICENSE", "All rights reserved."), ("a/b/c/d/w.py", ""), ("other/v.py", "the work is under the tree"),
            (None, "Licensed under the Apache License, Version 2.0.\nwith much more text that is no licence at all"), ("a/x.py", "code code")]
    files = written(spark.createDataFrame([(*r, 1) for r in rows], "path string, text string, row int"), "files")
    out = sorted(((r["path"] or "", r["header"], r["is_license_file"], r["license"], r["inherited_from"]) for r in
                  licenses.scan_licenses(files).collect()), key=str)
    assert out == sorted([
        ("a/LICENSE", "mit", True, "mit", None), ("a/x.py", None, False, "mit", "a/LICENSE"), ("a/x.py", None, False, "mit", "a/LICENSE"),
        ("a/b/y.py", "cc-by-nc-4.0", False, "cc-by-nc-4.0", None), ("a/b/z.py", None, False, "mit", "a/LICENSE"),
        ("a/b/c/LICENSE", "all-rights-reserved", True, "all-rights-reserved", None),
        ("a/b/c/d/w.py", None, False, "all-rights-reserved", "a/b/c/LICENSE"), ("other/v.py", None, False, None, None),
        ("", "apache-2.0", False, "apache-2.0", None)], key=str)
    assert licenses.scan_licenses(files.where("false")).count() == 0


def test_full_licence_texts_and_notices(spark):
    notice = licenses.NOTICES["gpl-3.0"].split()
    block = "\n".join("# " + " ".join(notice[i:i + 8]) for i in range(0, len(notice), 8))
    rows = [(f"{name}/LICENSE", text.replace("<year> <copyright holders>", "2020 A. Person"), name) for name, text in licenses.full_texts().items()]
    rows += [(f"{name}/src/x.py", "x = 1", name) for name in licenses.full_texts()]
    rows += [("n/a.py", f"#!/usr/bin/python\n# Copyright\n#\n{block}\n#\n\n" + "import os\nprint(os)\n" * 60, "gpl-3.0"),
             ("n/b.py", "Some words first. This work is licensed under the GNU General\nPublic License, version 3. And " + "more words " * 60, "gpl-3.0"),
             ("n/c.py", "plain words of the software that you can use", None)]
    files = written(spark.createDataFrame([r[:2] for r in rows], "path string, text string"), "files")
    out = {r["path"]: r for r in licenses.scan_licenses(files).collect()}
    assert {p: r["license"] for p, r in out.items()} == {p: name for p, _, name in rows}
    assert {p for p, r in out.items() if r["is_license_file"]} == {p for p, _, _ in rows if p.endswith("LICENSE")}


def test_contaminated_windows(spark, docs, empty):
    rng = random.Random(6)
    item = prose(rng, 40).split()
    changed = item[:20] + ["other"] + item[21:]
    rows = [(1, prose(rng, 50) + " " + " ".join(item) + " " + prose(rng, 50), "en"), (2, " ".join(item), "en"),
            (3, prose(rng, 9) + " " + " ".join(changed).upper() + " tail", "en"), (4, " ".join(item[:20]), "en"),
            (5, prose(rng, 200), "en"), (6, None, None), (7, "", None), (2, " ".join(item), "en")]
    bench = written(spark.createDataFrame([(10, " ".join(item), 1), (11, "too short here", 1), (12, None, 1), (13, " ".join(item), 1)],
                                          "item_id long, text string, row int"), "bench")
    out = decontaminate.contaminated(table(spark, rows), bench).collect()
    assert sorted((r["doc_id"], r["item_id"], r["start"]) for r in out) == sorted(
        (d, i, s) for d, s in ((1, 50), (2, 0), (2, 0)) for i in (10, 13))
    loose = decontaminate.contaminated(table(spark, rows), bench, similarity=0.7).collect()
    assert {r["doc_id"] for r in loose} == {1, 2, 3}
    assert decontaminate.contaminated(empty, bench).count() == 0
    assert decontaminate.contaminated(docs, bench.where("false")).count() == 0


def test_windows_at_every_start(spark):
    rng = random.Random(16)
    items = {20: prose(rng, 59).split(), 21: prose(rng, 59).split(), 22: ("a b c d e f g " * 7).split()[:45]}
    half, third = items[20][30:] + items[20][:30], items[21][40:] + items[21][:40]
    rows = [(1, " ".join(prose(rng, 70).split() + half + prose(rng, 70).split()), "en"), (2, " ".join(half), "en"),
            (3, " ".join(prose(rng, 3).split() + third + prose(rng, 30).split()), "en"), (4, " ".join(half[:50]), "en"),
            (5, " ".join(prose(rng, 9).split() + items[21][:25] + items[21][27:] + prose(rng, 40).split()), "en"),
            (6, "g f e " + "a b c d e f g " * 9, "en"), (7, " ".join(items[21][20:] + items[20][:30]), "en")]
    bench = written(spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string"), "bench")
    bags = lambda w: Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    want = {}
    for doc_id, text, _ in rows:
        for item_id, item in items.items():
            w, b = text.split(), bags(item)
            scores = []
            for start in range(max(0, len(w) - len(item)) + 1):
                a = bags(w[start:start + len(item)])
                scores.append((a & b).total() / (a | b).total())
            if max(scores) >= 0.8:
                want[doc_id, item_id] = max(scores)
    assert {(1, 20), (2, 20), (3, 21)} <= set(want)
    out = decontaminate.contaminated(table(spark, rows), bench, radius=60).collect()
    assert {(r["doc_id"], r["item_id"]): r["similarity"] for r in out} == pytest.approx(want)
    by_print = decontaminate.contaminated(table(spark, rows), bench).collect()
    assert {(1, 20), (3, 21)} <= {(r["doc_id"], r["item_id"]) for r in by_print}


def test_multi_index_finds_all_within_radius(spark):
    rng = random.Random(12)
    flip = lambda p, n: p ^ sum(1 << b for b in rng.sample(range(128), n))
    items = [rng.getrandbits(128) for _ in range(40)]
    windows = [flip(p, rng.randint(0, 40)) for p in items for _ in range(4)]
    # four bits in each of seven blocks and three in the eighth: the worst case of 31
    windows += [p ^ sum(1 << (16 * k + b) for k in range(8) for b in rng.sample(range(16), 4 if k != i % 8 else 3)) for i, p in enumerate(items)]
    words = lambda p: [w - (1 << 64) if w >> 63 else w for w in (p & (1 << 64) - 1, p >> 64)]
    left = spark.createDataFrame([(i, 0, 7, words(p)) for i, p in enumerate(windows)], "row long, start int, length int, print array<long>")
    right = spark.createDataFrame([(i, 7, words(p)) for i, p in enumerate(items)], "item long, length int, print array<long>")
    want = {(i, j) for i, p in enumerate(windows) for j, q in enumerate(items) if (p ^ q).bit_count() <= 31}
    found = decontaminate.candidates(left, right, 31)
    assert {(r["row"], r["item"]) for r in found.collect()} == want and len(want) > 100
    # what unrelated pairs meet before their distance is taken: under a tenth
    many = spark.range(3000).select(F.col("id").alias("row"), F.array(F.xxhash64("id"), F.xxhash64("id", F.lit(1))).alias("print"))
    own = many.select("row", F.inline(decontaminate.blocks("print")))
    entries = right.select("item", F.inline(decontaminate.blocks("print"))).select(
        "item", "block", F.explode(decontaminate.near_values(F.col("value"), 31)).alias("value"))
    assert own.join(entries, ["block", "value"]).select("row", "item").distinct().count() < 0.1 * 3000 * len(items)
