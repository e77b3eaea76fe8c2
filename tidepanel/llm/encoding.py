"""Token ids by the tokenizers library, one call for each distinct unit of text.

A byte-level pre-tokenizer cuts a text into runs of letters, of numbers, of
other signs (each with one space before it at most) and of white space. So in
ordinary prose a cut before a single space, a line break, a comma or a full stop
is always one of its cuts, and equal units (words, mostly) have equal ids
wherever they stand. Texts where that does not hold are cut less, or not at all:
where white space touches white space, or a comma or full stop follows another
sign, or a special token's string occurs.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array

import numpy as np

TOUCHING = re.compile(r"\s\s")
SIGN_RUN = re.compile(r"[\W_][.,]")
LONGEST_CACHED = 64
CACHED = 900_000


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies:
    printable Latin-1 letters for themselves, the others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def units(text: str) -> list[str]:
    """Parts of `text` that are pre-tokenized alike alone and in their place."""
    if "\0" in text or TOUCHING.search(text) is not None:
        return [text]
    if SIGN_RUN.search(text) is None:
        text = text.replace(",", "\0,").replace(".", "\0.").replace("\n", "\0\n")
    return text.replace(" ", "\0 ").split("\0")


class UnitEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = dict(enumerate(byte_letters()))
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        got = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in got]

    def _word(self, word: str) -> bytes:
        """Ids of a single pre-token: the library's model without its set-up."""
        letters = word.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()

    def _fresh(self, missing: list[str]) -> dict[str, bytes]:
        out, rest = {}, []
        for u in missing:
            if len(u) <= LONGEST_CACHED and (u[1:] if u[:1] == " " else u).isalpha():
                out[u] = self._word(u)
            else:
                rest.append(u)
        for at in range(0, len(rest), 4096):
            out.update(zip(rest[at:at + 4096], self._encode(rest[at:at + 4096])))
        return out

    def batch(self, texts: list[str]) -> list[bytes]:
        cache = self.cache
        if len(cache) > CACHED:
            cache.clear()
        cut = [[t] if any(s in t for s in self.special) else units(t) for t in texts]
        fresh = self._fresh([u for u in set().union(*cut) if u not in cache])
        cache.update(fresh)
        out = [b"".join(map(cache.__getitem__, c)) for c in cut]
        for u in fresh:  # whole texts and long units serve this batch only
            if len(u) > LONGEST_CACHED:
                del cache[u]
        return out


_ENCODERS: dict[str, UnitEncoder] = {}


def encoder(path: str) -> UnitEncoder:
    """One encoder a Python worker: its cache serves all the worker's tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = UnitEncoder(path)
    return _ENCODERS[path]


def crc32(data) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF


def text_batches(texts, characters: int = 1_000_000):
    """Slices of a list of texts holding about `characters` each."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= characters:
            yield slice(start, i + 1)
            start, held = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))
