"""Token counts by rank-synchronous array merging.

Distinct pre-tokens of a batch are held as one flat symbol array with a row
number per symbol (a ragged array). In every round each row looks up its lowest
merge rank and applies that pair at all its places at once; a row without a
known pair is done, and the symbols left are its tokens. The library itself is
not called: its file gives the vocabulary and merges, tests compare the counts.

Defined cases: null and empty texts have 0 bytes and 0 tokens; the special
token's string inside a text is one token, as the library's default has it;
nothing is truncated; null doc_ids are kept; an empty table gives no rows.
"""

from __future__ import annotations

import json
from itertools import chain

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import text_or_empty
from tidepanel.llm.encoding import LONGEST_CACHED, byte_letters, text_batches, units

# The pre-tokenizer pattern of byte-level BPE
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NO_RANK = np.int64(1 << 40)
CACHED = 1_500_000


class MergeTable:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocabulary = spec["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.of_byte = np.array([vocabulary[c] for c in byte_letters()], dtype=np.int64)
        keys = np.array([vocabulary[a] << 32 | vocabulary[b] for a, b in pairs], dtype=np.int64)
        made = np.array([vocabulary[a + b] for a, b in pairs], dtype=np.int64)
        self.made = made  # by rank
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order.astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], NO_RANK)

    def count(self, words: list[str]) -> np.ndarray:
        """Tokens of each word, by simultaneous merges."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.array([len(b) for b in raw], dtype=np.int64)
        counts = np.zeros(len(words), dtype=np.int64)
        row = np.repeat(np.arange(len(words)), sizes)
        sym = self.of_byte[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        rank = self._pair_ranks(sym, row, np.arange(len(sym)))
        while len(sym):
            first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            lowest = np.minimum.reduceat(rank, first)
            held = np.diff(np.r_[first, len(sym)])
            done = lowest == NO_RANK
            counts[row[first[done]]] = held[done]
            if done.any():
                keep = np.repeat(~done, held)
                sym, row, rank = sym[keep], row[keep], rank[keep]
                lowest, held = lowest[~done], held[~done]
                if not len(sym):
                    break
            hit = rank == np.repeat(lowest, held)
            # in a run of hits (a a a) only every other one can merge
            at = np.flatnonzero(hit)
            run_start = np.r_[True, (at[1:] != at[:-1] + 1) | (row[at[1:]] != row[at[:-1]])]
            place = np.arange(len(at)) - np.maximum.accumulate(
                np.where(run_start, np.arange(len(at)), 0))
            at = at[place % 2 == 0]
            sym[at] = self.made[rank[at]]
            keep = np.ones(len(sym), dtype=bool)
            keep[at + 1] = False
            moved = np.cumsum(keep) - 1
            sym, row, rank = sym[keep], row[keep], rank[keep]
            new = moved[at]
            touched = np.union1d(new, new[new > 0] - 1)
            rank[touched] = self._pair_ranks(sym, row, touched)
        return counts

    def _pair_ranks(self, sym, row, at) -> np.ndarray:
        """Rank of the pair that starts at each index of `at`."""
        out = np.full(len(at), NO_RANK)
        inside = at < len(sym) - 1
        inside[inside] = row[at[inside]] == row[at[inside] + 1]
        a = at[inside]
        out[inside] = self.ranks(sym[a], sym[a + 1])
        return out


class Counter:
    """Token counts of whole texts, with a bounded cache of counted units."""

    def __init__(self, path: str):
        self.table = MergeTable(path)
        self.pattern = regex.compile(PATTERN)
        self.cache: dict[str, int] = {}

    def _words(self, words: list[str]) -> dict[str, int]:
        out = {}
        for at in range(0, len(words), 50_000):
            part = words[at:at + 50_000]
            out.update(zip(part, self.table.count(part).tolist()))
        return out

    def _units(self, missing: list[str]) -> dict[str, int]:
        """Tokens of units; one that is not a plain word is cut into pre-tokens."""
        split = [[u] if (u[1:] if u[:1] == " " else u).isalpha() else self.pattern.findall(u)
                 for u in missing]
        known = self._words(list(set(chain.from_iterable(split))))
        return {u: sum(map(known.__getitem__, s)) for u, s in zip(missing, split)}

    def batch(self, texts: list[str]) -> list[int]:
        cache = self.cache
        if len(cache) > CACHED:
            cache.clear()
        cut, extra = [], []
        for t in texts:
            segments, specials = [t], 0
            for s in self.table.special:
                parts = [x.split(s) for x in segments]
                specials += sum(len(p) - 1 for p in parts)
                segments = list(chain.from_iterable(parts))
            cut.append(list(chain.from_iterable(map(units, segments))))
            extra.append(specials)
        fresh = self._units([u for u in set().union(*cut) if u not in cache])
        cache.update(fresh)
        out = [sum(map(cache.__getitem__, c)) + e for c, e in zip(cut, extra)]
        for u in fresh:  # whole texts and long units serve this batch only
            if len(u) > LONGEST_CACHED:
                del cache[u]
        return out


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit."""
    def counts(batches):
        c = counter(vocabulary)
        for frame in batches:
            texts = list(frame["text"])
            n = []
            for part in text_batches(texts):
                n += c.batch(texts[part])
            yield pd.DataFrame({"doc_id": frame["doc_id"], "n_bytes": frame["n_bytes"],
                                "n_tokens": np.array(n, dtype=np.int64)})

    # the id crosses as text: pandas has no exact integer next to nulls
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"),
                       F.octet_length(text_or_empty("text")).cast("long").alias("n_bytes"),
                       text_or_empty("text").alias("text"))
    return (rows.mapInPandas(counts, "doc_id string, n_bytes long, n_tokens long")
            .select(F.col("doc_id").cast("long").alias("doc_id"), "n_bytes", "n_tokens",
                    (F.col("n_tokens") > limit).alias("over_limit")))
