"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are compared as lower-case words (runs of letters and
numbers). An item of n words is found in a document when a run of the document's
words is within k = floor(edit_rate * n) word edits of it. Cut into k + 1 pieces,
such an item has at least one piece that occurs there exactly: pieces are looked
up with an Aho-Corasick automaton, and each hit's surroundings are verified with
Myers' bit-parallel distance over words.

The automaton goes to the executors, so the items are taken in blocks of bounded
size; documents pass once for each block and are never shuffled.

Defined cases: a null or empty text holds no item; an item without words is never
found; of items that repeat id and text one counts; documents that repeat a
doc_id are searched one by one; an empty benchmark or document table finds
nothing.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import free_name, text_or_empty

EDIT_RATE = 0.1
BLOCK_BYTES = 1_000_000
FOUND = pa.schema([("doc_id", pa.int64()), ("item", pa.int64()), ("distance", pa.int32()),
                   ("end_word", pa.int64())])


def words_of(col: str) -> Column:
    """Words with one space on either side of each."""
    clean = F.regexp_replace(F.lower(text_or_empty(col)), r"[^\p{L}\p{N}]+", " ")
    return F.concat(F.lit(" "), F.trim(clean), F.lit(" "))


def least_distance(pattern: list[str], text: list[str], most: int) -> tuple[int, int] | None:
    """Myers: (distance, end) of the best place of `pattern` in `text`, the first
    of equals, or None if the distance is over `most`. One bit a pattern word."""
    m = len(pattern)
    masks: dict[str, int] = defaultdict(int)
    for i, w in enumerate(pattern):
        masks[w] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    rise, fall, score = full, 0, m  # vertical +1 and -1 differences
    best = None
    for j, w in enumerate(text):
        same = masks.get(w, 0)
        x = same | fall
        diagonal = (((same & rise) + rise) ^ rise) | same
        up = (fall | ~(diagonal | rise)) & full
        down = rise & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = (up << 1) & full, (down << 1) & full
        rise, fall = (down | ~(x | up)) & full, up & x
        if score <= most and (best is None or score < best[0]):
            best = (score, j + 1)
    return best


class Matcher:
    """Finds the items of one block in normalised texts."""

    def __init__(self, items: Iterable[tuple[int, str]], edit_rate: float = EDIT_RATE):
        import ahocorasick
        self.items: dict[int, tuple[list[str], int]] = {}
        pieces: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for key, text in items:
            words = text.split()
            if not words:
                continue
            budget = math.floor(edit_rate * len(words))
            self.items[key] = (words, budget)
            for p in range(budget + 1):
                lo, hi = (len(words) * q // (budget + 1) for q in (p, p + 1))
                pieces[f" {' '.join(words[lo:hi])} "].append((key, lo))
        self.automaton = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.automaton.add_word(piece, (len(piece), places))
        if pieces:
            self.automaton.make_automaton()

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """Word ranges of `text` in which each hit item can lie, overlapping ones merged."""
        found: dict[int, list[list[int]]] = defaultdict(list)
        word, seen = 0, 0
        for end, (size, places) in self.automaton.iter(text):
            start = end - size + 1  # at the space before the piece
            if start >= seen:
                word += text.count(" ", seen, start)
                at, word_seen = word, start
                seen = word_seen
            else:
                at = word - text.count(" ", start, seen)
            for key, offset in places:
                words, budget = self.items[key]
                lo = max(0, at - offset - budget)
                found[key].append([lo, at - offset + len(words) + budget])
        for key, ranges in found.items():
            ranges.sort()
            merged = [ranges[0]]
            for lo, hi in ranges[1:]:
                if lo <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], hi)
                else:
                    merged.append([lo, hi])
            found[key] = merged
        return found

    def search(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(item, distance, end word) of every item that `text` holds."""
        if not self.items:
            return
        found = self.windows(text)
        words = text.split() if found else []
        for key, ranges in found.items():
            pattern, budget = self.items[key]
            places = []
            for lo, hi in ranges:
                got = least_distance(pattern, words[lo:hi], budget)
                if got is not None:
                    places.append((got[0], got[1] + lo))
            if places:
                yield key, *min(places)


def item_blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """The items as (item_id, words), in blocks of about `block_bytes`."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                             words_of("text").alias("words")).distinct()
    total = items.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    for b in range(blocks):
        rows = items if blocks == 1 else items.where(
            F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks).cast("long")) == b)
        yield [(r["item_id"], r["words"]) for r in rows.collect()]


def per_block(items: list[tuple[int, str]], edit_rate: float) -> Callable[[], Matcher]:
    """Builds the block's matcher once in each task."""
    made: list[Matcher] = []

    def get() -> Matcher:
        if not made:
            made.append(Matcher(enumerate(text for _, text in items), edit_rate))
        return made[0]
    return get


def find_items(docs: DataFrame, benchmark: DataFrame, edit_rate: float = EDIT_RATE,
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, distance, end_word: one row for each document and item in it."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       words_of("text").alias("words"))
    out = None
    for items in item_blocks(benchmark, block_bytes):
        matcher = per_block(items, edit_rate)
        ids = [i for i, _ in items]

        def search(batches, matcher=matcher, ids=ids):
            m = matcher()
            for batch in batches:
                found = [(d, ids[key], distance, end)
                         for d, text in zip(batch.column("doc_id").to_pylist(),
                                            batch.column("words").to_pylist())
                         for key, distance, end in m.search(text)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t.type) for c, t in zip(list(zip(*found)) or [()] * 4, FOUND)],
                    names=["doc_id", "item_id", "distance", "end_word"])

        part = rows.mapInArrow(search, "doc_id long, item_id long, distance int, end_word long")
        out = part if out is None else out.unionByName(part)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, edit_rate: float = EDIT_RATE,
                      block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`docs` with its own columns, without the documents that hold an item."""
    for items in item_blocks(benchmark, block_bytes):
        matcher = per_block(items, edit_rate)

        def clean(batches, matcher=matcher):
            m = matcher()
            for batch in batches:
                keep = [next(m.search(t), None) is None for t in batch.column(0).to_pylist()]
                yield batch.filter(pa.array(keep, pa.bool_())).select(range(1, batch.num_columns))

        name = free_name(docs, "_words")
        docs = docs.select(words_of("text").alias(name), "*").mapInArrow(clean, docs.schema)
    return docs
