"""Token ids by a public tokenizer, word by word.

The tokenizer's rules end every token at white space, so the ids of a text
are the ids of its white-space separated words in turn. Each distinct word of
a group of texts is looked up once, and encoded if the worker has not met it
lately; plain words by the tokenizer's merge model directly. ``str.split`` also
splits at the four separator controls 1C-1F, which the tokenizer does not; texts
that hold them are encoded whole.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np

from parcelle.llm.common import in_parts

_CONTROLS = "\x1c\x1d\x1e\x1f"
#: Words that a worker remembers, without marks and lower-cased; of more, those
#: that it has not met lately are forgotten, so its memory is bounded.
MEMORY_WORDS = 300_000
#: Characters of texts whose distinct words are looked up at once.
GROUP_CHARS = 1 << 19


@lru_cache(maxsize=2)
def load_tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def _memory(path: str) -> list[dict[str, bytes]]:
    """The words met lately, and the words met before these."""
    return [{}, {}]


#: Of a word of Latin letters with such marks around it the tokenizer's
#: normalisation only lower-cases the letters, and its split gives the marks, the
#: letters and the marks. Apostrophes begin contractions, and ``<`` the special
#: tokens.
_MARKS = "!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~"
_LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")


@lru_cache
def _byte_letters() -> str:
    """Byte-level alphabet: bytes that print stand for themselves, the others
    for the letters from U+0100 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return "".join(chr(b if b in prints else next(others)) for b in range(256))


def _look_up(path: str, ids: dict[str, bytes | None]) -> None:
    """Give each of the words ``ids`` its ids."""
    memory = _memory(path)
    if len(memory[0]) > MEMORY_WORDS // 2:
        memory[:] = {}, memory[0]
    known, before = memory
    tokenizer, letters, rest = load_tokenizer(path), _byte_letters(), []
    tokenize = tokenizer.model.tokenize

    def part(text: str) -> bytes:
        found = known.get(text)
        if found is None:
            found = before.get(text)
            if found is None:
                form = text if text.isascii() else text.encode().decode("latin-1").translate(letters)
                found = array("I", [t.id for t in tokenize(form)]).tobytes()
            known[text] = found
        return found

    for word in ids:
        found = known.get(word)
        if found is None:
            core = word.strip(_MARKS)
            if core.isalpha() if core.isascii() else _LETTERS.fullmatch(core):
                found = part(core.lower())
                if len(core) < len(word):
                    at = word.index(core)
                    first, last = word[:at], word[at + len(core):]
                    found = (part(first) if first else b"") + found + (part(last) if last else b"")
            else:
                found = before.get(word)
                if found is None:
                    rest.append(word)
                    continue
                known[word] = found
        ids[word] = found
    for at in range(0, len(rest), 4096):
        group = rest[at:at + 4096]
        found = tokenizer.encode(group, is_pretokenized=True, add_special_tokens=False)
        data = np.array(found.ids, dtype="<u4").tobytes()
        of = np.array(found.word_ids, dtype=np.int64)
        ends = np.searchsorted(of, np.arange(len(group)), side="right")
        last = 0
        for word, end in zip(group, ends.tolist(), strict=True):
            ids[word] = known[word] = data[4 * last:4 * end]
            last = end


def encode_texts(path: str, texts: list[str]) -> Iterator[bytes]:
    """Ids of each text as little-endian unsigned 32-bit integers."""
    for group in in_parts(texts, GROUP_CHARS):
        split = [None if any(c in text for c in _CONTROLS) else text.split() for text in texts[group]]
        ids = dict.fromkeys(chain.from_iterable(words for words in split if words))
        _look_up(path, ids)
        for text, words in zip(texts[group], split, strict=True):
            if words is None:
                yield np.array(load_tokenizer(path).encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
            else:
                yield b"".join(map(ids.__getitem__, words))
