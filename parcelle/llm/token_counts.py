"""Token counts by a linear longest-match automaton.

A word (a maximal run without the six ASCII white-space bytes, with the
vocabulary's word mark in front) is split greedily into the longest pieces of
a vocabulary; the operator only counts them. A trie of the vocabulary's pieces
gets failure links: where the next byte leaves the trie, the link names the
state after popping all pieces that are certain by then, and how many those
are. Precomputing both for every state and byte makes counting one table
lookup a byte, with no back-tracking and no pieces built. All words of a batch
advance together, one byte a step.

The vocabulary has a piece for every byte, so every text has a count.
Defined results: NULL and empty texts have 0 tokens; an empty table gives an
empty result; very long words take one step a byte.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from parcelle.llm.common import texts

WORD_MARK = "▁"


def read_pieces(path: str) -> list[bytes]:
    """Pieces of a sentencepiece model as bytes; its byte pieces are bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return sorted({*(model.id_to_piece(i).encode() for i in plain), *(bytes([b]) for b in range(256))})


class LongestMatch:
    """``go[state, byte]`` and ``cost[state, byte]``: the next state, and the
    pieces popped on the way; ``end[state]``: pieces that are left at a word's
    end; ``start``: the state after the word mark."""

    def __init__(self, pieces: list[bytes], mark: bytes = WORD_MARK.encode()):
        children: list[dict[int, int]] = [{}]
        final = [False]
        for piece in pieces:
            at = 0
            for byte in piece:
                if byte not in children[at]:
                    children[at][byte] = len(children)
                    children.append({})
                    final.append(False)
                at = children[at][byte]
            final[at] = True
        if len(children[0]) < 256 or not all(final[x] for x in children[0].values()):
            raise ValueError("the vocabulary must have a piece for every byte")
        n = len(children)
        self.go = np.zeros((n, 256), np.int32)
        self.cost = np.zeros((n, 256), np.uint16)
        self.end = np.zeros(n, np.uint16)
        link, popped = [0] * n, [0] * n
        for byte, child in children[0].items():
            self.go[0, byte] = child
        queue = deque((0, byte, child) for byte, child in children[0].items())
        while queue:
            parent, byte, at = queue.popleft()
            if final[at]:
                link[at], popped[at] = 0, 1
            else:  # drop what the parent has for certain, then read the byte from there
                link[at] = int(self.go[link[parent], byte])
                popped[at] = popped[parent] + int(self.cost[link[parent], byte])
            self.go[at] = self.go[link[at]]
            self.cost[at] = self.cost[link[at]] + popped[at]
            self.end[at] = self.end[link[at]] + popped[at]
            for following, child in children[at].items():
                self.go[at, following], self.cost[at, following] = child, 0
                queue.append((at, following, child))
        self.start, self.start_cost = 0, 0
        for byte in mark:
            self.start_cost += int(self.cost[self.start, byte])
            self.start = int(self.go[self.start, byte])

    def count(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and words of each text."""
        flat = np.frombuffer(b" ".join([b"", *texts, b""]), dtype=np.uint8)
        space = (flat == 32) | ((flat >= 9) & (flat <= 13))
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        first, size = edge[::2], edge[1::2] - edge[::2]
        order = np.argsort(-size, kind="stable")
        first, size = first[order], size[order]
        state = np.full(len(first), self.start, np.int32)
        tokens = np.full(len(first), self.start_cost, np.int64)
        active = len(first) - np.searchsorted(size[::-1], np.arange(int(size[0]) if len(size) else 0), side="right")
        go, cost = self.go.ravel(), self.cost.ravel()
        for t, n in enumerate(active.tolist()):
            at = state[:n].astype(np.int64) * 256 + flat[first[:n] + t]
            tokens[:n] += cost[at]
            state[:n] = go[at]
        tokens += self.end[state]
        ends = np.cumsum([len(x) + 1 for x in texts])
        of = np.searchsorted(ends, first, side="left")
        return (np.bincount(of, weights=tokens, minlength=len(texts)).astype(np.int64),
                np.bincount(of, minlength=len(texts)))


@lru_cache(maxsize=1)
def automaton(path: str) -> LongestMatch:
    return LongestMatch(read_pieces(path))


def token_counts(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_words, n_tokens) of each row's whole text."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            data = [x.encode() for x in frame["text"]]
            tokens, words = automaton(vocabulary_path).count(data)
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "n_bytes": [len(x) for x in data],
                                "n_words": words, "n_tokens": tokens})

    return texts(docs, id_col, text_col).select("doc_id", "text").mapInPandas(
        count, "doc_id long, n_bytes long, n_words long, n_tokens long")
