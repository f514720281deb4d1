"""Removal of repeated byte strings by refining buckets of sampled suffixes.

A byte is removed if a string of ``length`` bytes that covers it also starts
anywhere else. Bucket-pointer refinement names the bucket of every suffix:
first by its 8 bytes, then by the buckets of itself and of a later offset
(8, 16, 32, 40, 80, 160, 200 bytes), each level computed from the names of the
levels before. A bucket's name is a 64-bit mix of the two names that it is
refined by, so that all tasks name equal strings alike without meeting. The
name of 8 bytes is without loss, and strings that differ inside one aligned
8-byte block only never share a name.

Sorting every suffix of a corpus would move many times its bytes. Windows of
``length`` bytes are therefore taken in runs: windows that follow one another
and have the same anchor, the first place in the window of its smallest
40-byte bucket. A run is cut where its windows reach 80 bytes before the
anchor: those that do contain the 120 bytes from there, the others the 120
bytes from the anchor on. The bucket of these 120 bytes is the run's key.
Equal windows have their anchors at equal distances, so they always lie in
runs of the same key, wherever they are, and

1. runs whose key occurs once hold no repeated window;
2. of the others, runs that repeat as a whole are repeated throughout;
3. of the rest, every window's own 200-byte bucket is compared, with those of
   one representative of each repeated run of the same key.

Every step moves names and positions only; buckets are counted with partial
sums per task, so a passage in a third of all documents is one row per task.

Defined results: a NULL text is empty; texts under ``length`` bytes keep all
bytes; matches never cross documents; strings are judged on the input and may
overlap, also inside one document; rows that repeat repeat one another; long
texts are read in pieces of bounded size; an empty table gives an empty
result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import bloom_joins, numbered, written

GRAM = 40
LENGTH = 5 * GRAM
HALF = 2 * GRAM
PIECE = 1 << 20
ANCHORS = 4096
_FIRST, _SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    """``x`` mixed without loss: odd factors and xor-shifts can be undone, so
    different values keep different names."""
    x = (x ^ (x >> np.uint64(32))) * _FIRST
    x = (x ^ (x >> np.uint64(29))) * _SECOND
    return x ^ (x >> np.uint64(32))


def _refined(names: np.ndarray, later: np.ndarray) -> np.ndarray:
    """Names of the buckets (name, name at a later offset); different ones
    wherever just one of the two differs."""
    n = min(len(names), len(later))
    x = names[:n] * _FIRST + later[:n]
    x ^= x >> np.uint64(32)
    x *= _SECOND
    x ^= x >> np.uint64(29)
    return x


def bucket_names(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of the 40, 80 and 200-byte bucket at each position."""
    x = flat.astype(np.uint64)
    for width in (1, 2, 4):
        x = x[:-width] | (x[width:] << np.uint64(8 * width))
    eight = _mixed(x)
    sixteen = _refined(eight, eight[8:])
    gram = _refined(_refined(sixteen, sixteen[16:]), eight[32:])
    eighty = _refined(gram, gram[40:])
    return gram, eighty, _refined(_refined(eighty, eighty[80:]), gram[160:])


def _sliding(x: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over each run of ``width`` entries."""
    done = 1
    while 2 * done <= width:
        x, done = pick(x[:-done], x[done:]), 2 * done
    return pick(x[:len(x) - (width - done)], x[width - done:]) if done < width else x


def _pieces(sizes: list[int]) -> Iterator[list[tuple[int, int, int]]]:
    """Batches of (text, first window, end window), each of bounded bytes."""
    batch, held = [], 0
    for i, size in enumerate(sizes):
        for begin in range(0, size - LENGTH + 1, PIECE):
            end = min(begin + PIECE, size - LENGTH + 1)
            if batch and held + end - begin + LENGTH > PIECE:
                yield batch
                batch, held = [], 0
            batch.append((i, begin, end))
            held += end - begin + LENGTH
    if batch:
        yield batch


def _anchors(gram: np.ndarray, first: np.ndarray, span: int) -> np.ndarray:
    """First place of the smallest bucket in the windows that begin at ``first``."""
    view = np.lib.stride_tricks.sliding_window_view(gram, span)
    found = [view[first[i:i + ANCHORS]].argmin(axis=1) for i in range(0, len(first), ANCHORS)]
    return first + np.concatenate(found)


def window_runs(data: list[bytes]) -> Iterator[pd.DataFrame]:
    """Runs of windows: text, first window, how many, key, and name of the
    run's content."""
    span = LENGTH - GRAM + 1
    for batch in _pieces([len(x) for x in data]):
        flat = np.frombuffer(b"".join(data[i][a:b + LENGTH - 1] for i, a, b in batch), dtype=np.uint8)
        gram, eighty, window = bucket_names(flat)
        low = _sliding(gram, span, np.minimum)
        n = np.array([b - a for _, a, b in batch])
        stored = n + LENGTH - 1
        base = np.cumsum(stored) - stored
        piece = np.repeat(np.arange(len(batch)), n)
        where = np.arange(n.sum()) + np.repeat(base - (np.cumsum(n) - n), n)
        smallest, name = low[where], window[where]
        # the anchor moves on where the bucket changes or the window leaves it behind
        new = np.concatenate([[True], (smallest[1:] != smallest[:-1]) | (piece[1:] != piece[:-1])
                              | (gram[where[:-1]] == smallest[:-1])])
        first = np.flatnonzero(new)
        anchor = _anchors(gram, where[first], span)
        # windows of a run are consecutive: the first that reaches less far before the anchor
        cut = first + (anchor - HALF + 1 - where[first])
        end = np.append(first[1:], len(where))
        both = (cut > first) & (cut < end)
        far = cut > first
        place = np.where(far, anchor - HALF, anchor)
        first = np.concatenate([first, cut[both]])
        place = np.concatenate([place, anchor[both]])
        far = np.concatenate([far, np.zeros(both.sum(), dtype=bool)])
        order = np.argsort(first, kind="stable")
        first, place, far = first[order], place[order], far[order]
        count = np.diff(np.append(first, len(where)))
        key = _refined(_refined(eighty[place], gram[place + HALF]), far.astype(np.uint64))
        content = _refined(np.add.reduceat(_mixed(name), first) + count.astype(np.uint64), name[first])
        text = np.array([i for i, _, _ in batch])
        begin = np.array([a for _, a, _ in batch])
        yield pd.DataFrame({
            "text": text[piece[first]], "first": begin[piece[first]] + where[first] - base[piece[first]], "count": count,
            "key": key.view(np.int64), "content": content.view(np.int64),
        })


def _runs(docs: DataFrame) -> DataFrame:
    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = frame["row"].to_numpy()
            for runs in window_runs([x.encode() for x in frame["text"]]):
                yield runs.assign(row=rows[runs["text"]]).drop(columns="text")

    return docs.mapInPandas(find, "first long, count long, key long, content long, row long")


def _packed(docs: DataFrame) -> DataFrame:
    """(row, doc_id, packed): compressed texts, half of what a shuffle of the
    texts would write."""
    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"row": frame["row"], "doc_id": frame["doc_id"].astype("Int64"),
                                "packed": [zlib.compress(x.encode(), 1) for x in frame["text"]]})

    return docs.mapInPandas(pack, "row long, doc_id long, packed binary")


def _windows(docs: DataFrame) -> DataFrame:
    """(key, name, row, first, weight) of the windows of the runs listed with
    each text; of representatives without row."""
    def name(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row, packed, runs in zip(frame["row"], frame["packed"], frame["runs"], strict=True):
                data, runs, at = zlib.decompress(packed), list(runs), 0
                while at < len(runs):
                    held, part = 0, []
                    while at < len(runs) and held < PIECE:
                        part.append(runs[at])
                        held += runs[at]["count"] + LENGTH
                        at += 1
                    flat = b"".join(data[r["first"]:r["first"] + r["count"] + LENGTH - 1] for r in part)
                    names = bucket_names(np.frombuffer(flat, dtype=np.uint8))[2]
                    n = np.array([r["count"] for r in part])
                    own = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    place = np.repeat(np.cumsum(n + LENGTH - 1) - (n + LENGTH - 1), n) + own
                    whole = np.repeat([r["whole"] for r in part], n)
                    yield pd.DataFrame({
                        "key": np.repeat(np.array([r["key"] for r in part], np.int64), n),
                        "name": names[place].view(np.int64), "row": np.where(whole, -1, row),
                        "first": np.repeat([r["first"] for r in part], n) + own, "weight": np.where(whole, 2, 1)})

    return docs.mapInPandas(name, "key long, name long, row long, first long, weight long")


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(row, first, count): runs of windows that occur elsewhere, too."""
    runs = written(_runs(docs), "runs")
    # written, so that the join has plain shuffles on both sides and a hot key's partition can be split
    shared = written(runs.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared_keys")
    with bloom_joins(docs.sparkSession, shared.where("n > 1").count()):  # most runs are in no shared key: they need not cross the shuffle
        runs = written(runs.join(shared.where("n > 1").select("key"), "key", "left_semi"), "shared_runs")
    contents = written(
        runs.groupBy("key", "content").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "first", "count")).alias("one")),
        "contents")
    whole = runs.join(contents.where("n > 1").select("key", "content"), ["key", "content"], "left_semi")
    single = contents.where("n = 1")
    beside = single.select("key").distinct()
    samples = contents.where("n > 1").join(beside, "key", "left_semi")
    listed = single.select("key", "one.*", F.lit(False).alias("whole")).unionByName(
        samples.select("key", "one.*", F.lit(True).alias("whole")))
    listed = listed.groupBy("row").agg(F.collect_list(F.struct("key", "first", "count", "whole")).alias("runs"))  # of one text
    windows = written(_windows(_packed(docs).select("row", "packed").join(listed, "row")), "windows")
    both = ["key", "name"]  # equal windows lie in runs of one key, so 128 bits tell windows apart
    again = written(windows.groupBy(*both).agg(F.sum("weight").alias("n")).where("n > 1"), "shared_names")
    with bloom_joins(docs.sparkSession, again.count()):
        parts = written(windows.where("row >= 0").join(again.where("n > 1").select(*both), both, "left_semi"), "shared_windows")
    parts = parts.select("row", "first", F.lit(1).cast("long").alias("count"))
    return whole.select("row", "first", "count").unionByName(parts)


def _spans(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes under windows that begin in the given runs."""
    order = np.argsort(first, kind="stable")
    begin, end = first[order], np.maximum.accumulate((first + count + LENGTH - 1)[order])
    new = np.concatenate([[True], begin[1:] > end[:-1]])
    return begin[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """(row, doc_id, n_bytes, n_removed, n_spans, kept, spans): what is left
    of each text as bytes, and the removed (begin, end) of its bytes."""
    source = numbered(docs, id_col, text_col, row_col)
    found = repeated_windows(source).groupBy("row").agg(
        F.collect_list("first").alias("first"), F.collect_list("count").alias("count"))  # of one text
    joined = _packed(source).join(found, "row", "left")

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for packed, first, count in zip(frame["packed"], frame["first"], frame["count"], strict=True):
                data, spans = zlib.decompress(packed), []
                if first is not None and len(first):
                    begin, end = _spans(np.asarray(first), np.asarray(count))
                    spans = list(zip(begin.tolist(), end.tolist(), strict=True))
                edges = [0, *(x for span in spans for x in span), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                out.append((len(data), len(data) - len(kept), len(spans), kept, [list(x) for x in spans]))
            columns = ["n_bytes", "n_removed", "n_spans", "kept", "spans"]
            yield pd.DataFrame(out, columns=columns).assign(
                row=frame["row"].to_numpy(), doc_id=frame["doc_id"].astype("Int64").array)

    return joined.mapInPandas(
        cut, "row long, doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, spans array<array<long>>")

