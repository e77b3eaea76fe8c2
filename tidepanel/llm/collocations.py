"""Phrase collocations, counted on a prefix-free parse of the corpus.

Parse. A document is one sequence of words with a stop between its pieces. Runs of
three tokens whose hash is divisible by `spacing` are triggers, and the text is cut
into chunks that begin at one trigger and end with the next: neighbours overlap by
the three tokens of the trigger, so every run of up to four words lies whole in the
chunk in which it starts. Triggers depend on the text only, so repeated passages
give the same chunks wherever they stand; the distinct chunks with their frequency
are the dictionary, which is all that is counted. A run belongs to the chunk in
which it starts before the closing trigger, so the overlaps count once; a chunk that
ends its document owns all its runs. Where no trigger comes for `LONGEST` tokens, a
cut is made there.

Counts. Runs are counted level by level (`LEVELS`) inside the dictionary, weighted by
the chunks' frequencies: batches become integer arrays, equal runs are added up in
numpy, and Spark adds the partial sums per (lang, phrase). A run can only be frequent
if all its shorter runs are, which a Bloom filter of bounded size (`FILTER_BITS`) of
the level before tells in advance; its false positives cost work and change nothing, as
the final counts are kept by the phrase itself.

Scores. A candidate of 2 to 4 words with a occurrences is cut after each word into
parts with l and r occurrences; floor(2,000,000 a / (l + r)) of the lowest cut (the
shortest first part among equals) is its score. Candidates inside a longer one with
100 f(longer) >= 80 a are dropped. Sums of parts meet their counts in a salted join,
and the first `top` of a lang are found per salt first.

Defined cases: null and empty texts have no words; a null lang is `und`; words are
what stands between spaces and tabs, so the other blanks of Unicode belong to words;
repeated rows and doc_ids count each time; ties go by a, then by the phrase's bytes;
an empty table, or one without a frequent phrase, gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import materialize, salted_join, text_or_empty

WORDS = 4          # longest phrase
OVERLAP = WORDS - 1
LEVELS = ((1,), (2,), (3, 4))  # lengths counted in one pass over the dictionary
SPACING = 16       # a trigger comes about every so many tokens
LONGEST = 200      # tokens without a trigger after which a cut is made anyway
FLUSH_TOKENS = 1 << 20
FLUSH_ROWS = 200_000
FILTER_BITS = 1 << 25
LEAST = 30
TOP = 2_000
SALTS = 32
STOP = b"."
#: A-Z to a-z, tab to space, piece ends to the stop
TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t,;:!?\n\x0b\x0c\r",
                        b"abcdefghijklmnopqrstuvwxyz " + STOP * 9)
MIX, SPIN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def tokens_of(text: bytes) -> list[bytes]:
    """Words, with a stop for every piece end."""
    return text.translate(TABLE).replace(STOP, b" . ").split()


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * SPIN
    return x ^ (x >> np.uint64(27))


def encoded(tokens: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Number of each token, and the distinct tokens."""
    found = tokens.dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary


def hashes_of(words: pa.Array) -> np.ndarray:
    return mixed(np.fromiter((zlib.crc32(w) << 32 | zlib.adler32(w) for w in words.to_pylist()),
                             dtype=np.uint64, count=len(words)))


def are_stops(ids: np.ndarray, words: pa.Array) -> np.ndarray:
    return ids == words.index(pa.scalar(STOP, pa.binary())).as_py()  # -1 where there is none


def run_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of the run of n tokens that starts at each place."""
    out = np.zeros(max(0, len(h) - n + 1), dtype=np.uint64)
    for i in range(n):
        out = mixed(out * MIX + h[i:len(h) - n + 1 + i])
    return out


def starts_of(triggers: np.ndarray, n: int) -> list[int]:
    """Starts of the chunks of n tokens, from the places of the triggers."""
    starts = [0]
    for at in [*triggers.tolist(), n]:
        while at - starts[-1] > LONGEST and starts[-1] + LONGEST <= n - OVERLAP:
            starts.append(starts[-1] + LONGEST)
        if starts[-1] < at <= n - OVERLAP:
            starts.append(at)
    return starts


def parse(texts: list[bytes], spacing: int = SPACING) -> list[list[tuple[bytes, bool, int]]]:
    """The chunks of each text: content, whether a trigger closes it, words it owns."""
    every = [tokens_of(t) for t in texts]
    flat = [w for tokens in every for w in tokens]
    ids, words = encoded(pa.array(flat, pa.binary()))
    hit = run_hashes(hashes_of(words)[ids], OVERLAP) % np.uint64(spacing) == 0
    stops = np.concatenate([[0], np.cumsum(are_stops(ids, words))])
    out, at = [], 0
    for tokens in every:
        n = len(tokens)
        places = np.flatnonzero(hit[at:at + max(0, n - OVERLAP + 1)])
        starts = starts_of(places, n) if n else []
        chunks = []
        for a, b in zip(starts, [*starts[1:], None]):
            end = n if b is None else b
            owned = end - a - int(stops[at + end] - stops[at + a])
            chunks.append((b" ".join(tokens[a:n if b is None else b + OVERLAP]),
                           b is not None, owned))
        out.append(chunks)
        at += n
    return out


def chunk_dictionary(docs: DataFrame, spacing: int = SPACING) -> DataFrame:
    """Distinct chunks of `lang` and `text`: lang, chunk, closed, words, n."""
    def chunks(batches):
        counts: dict = {}

        def flushed():
            keys, n = list(counts), list(counts.values())
            counts.clear()
            for at in range(0, len(keys), 20_000):
                lang, chunk, closed, words = zip(*keys[at:at + 20_000])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lang, pa.string()),
                     pa.array(chunk, pa.binary()).cast(pa.string(), safe=False),
                     pa.array(closed, pa.bool_()), pa.array(words, pa.int64()),
                     pa.array(n[at:at + 20_000], pa.int64())],
                    names=["lang", "chunk", "closed", "words", "n"])

        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for at in range(0, len(langs), 500):
                texts = batch.column("text").slice(at, 500).to_pylist()
                for lang, found in zip(langs[at:], parse(texts, spacing)):
                    for chunk in found:
                        key = (lang, *chunk)
                        counts[key] = counts.get(key, 0) + 1
                if len(counts) > FLUSH_ROWS:
                    yield from flushed()
        if counts:
            yield from flushed()

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       text_or_empty("text").cast("binary").alias("text"))
    return (rows.mapInArrow(chunks, "lang string, chunk string, closed boolean, words long, n long")
            .groupBy("lang", "chunk", "closed", "words").agg(F.sum("n").alias("n")))


def passes(bits: np.ndarray | None, h: np.ndarray) -> np.ndarray:
    """Which hashes the Bloom filter holds (two bits each)."""
    if bits is None:
        return np.ones(len(h), dtype=bool)
    size = np.uint64(len(bits) * 8)
    out = np.ones(len(h), dtype=bool)
    for part in (h, mixed(h * MIX)):
        bit = part % size
        out &= (bits[(bit >> np.uint64(3)).astype(np.int64)]
                >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return out


def runs_in(lang: pa.Array, chunk: pa.Array, closed: np.ndarray, weight: np.ndarray,
            lengths: tuple[int, ...], known: int, bits: np.ndarray | None):
    """(lang, phrase, w, n) of the runs of each of these lengths, equal ones added up; `bits`
    holds the frequent runs of `known` words."""
    tokens = pc.split_pattern(chunk.cast(pa.binary()), b" ")
    ends = tokens.offsets.to_numpy().astype(np.int64)
    ids, words = encoded(tokens.flatten())
    ends = ends - ends[0]
    chunk_of = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    is_word = ~are_stops(ids, words)
    shorter = None
    if known and len(ids):
        shorter = passes(bits, run_hashes(hashes_of(words)[ids], known))
    langs = lang.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    for n in lengths:
        places = max(0, len(ids) - n + 1)
        which = chunk_of[:places]
        # a run starts before the closing trigger and ends inside its chunk
        last = ends[1:] - np.maximum(np.where(closed, OVERLAP, 0), n - 1)
        ok = np.arange(places) < last[which]
        for i in range(n):
            ok &= is_word[i:places + i]
        for i in range(n - known + 1 if shorter is not None else 0):
            ok &= shorter[i:places + i]
        at = np.flatnonzero(ok)
        if not len(at):
            continue
        key = langs[which[at]]
        for i in range(n):  # numbers of equal prefixes, so that they stay small
            _, first, key = np.unique(key * len(words) + ids[at + i], return_index=True,
                                      return_inverse=True)
        total = np.zeros(len(first), dtype=np.int64)
        np.add.at(total, key, weight[which[at]])
        place = at[first]
        parts = [words.take(pa.array(ids[place + i])) for i in range(n)]
        phrase = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary())) if n > 1 \
            else parts[0]
        yield pa.RecordBatch.from_arrays(
            [lang.take(pa.array(which[place])), phrase.cast(pa.string(), safe=False),
             pa.array(np.full(len(place), n, dtype=np.int32)), pa.array(total)],
            names=["lang", "phrase", "w", "n"])


def count_runs(dictionary: DataFrame, lengths: tuple[int, ...], known: int,
               bits: np.ndarray | None) -> DataFrame:
    """lang, phrase, w, n: runs of `lengths` words, without some that cannot be frequent."""
    sent = dictionary.sparkSession.sparkContext.broadcast(bits)

    def count(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.column("chunk").nbytes
            if size > 6 * FLUSH_TOKENS:
                yield from counted(held)
                held, size = [], 0
        if held:
            yield from counted(held)

    def counted(held):
        rows = pa.Table.from_batches(held).combine_chunks()
        if not rows.num_rows:
            return
        lang, chunk = (rows.column(c).chunk(0) for c in ("lang", "chunk"))
        for out in runs_in(lang, chunk, rows.column("closed").to_numpy(),
                           rows.column("n").to_numpy(), lengths, known, sent.value):
            yield from pa.Table.from_batches([out]).to_batches(20_000)

    return (dictionary.select("lang", "chunk", "closed", "n")
            .mapInArrow(count, "lang string, phrase string, w int, n long")
            .groupBy("lang", "phrase", "w").agg(F.sum("n").alias("n")))


def bloom_of(frequent: DataFrame, n: int, most_bits: int = FILTER_BITS) -> np.ndarray:
    """Filter of the phrases of n words, of any lang: 16 bits each, at most `most_bits` in
    all, so that what comes to the driver and goes to the tasks is bounded."""
    rows = frequent.count()
    size = 1 << 10
    while size < min(16 * rows, most_bits):
        size *= 2

    def set_bits(batches):
        for batch in batches:
            tokens = pc.split_pattern(batch.column("phrase").cast(pa.binary()), b" ").flatten()
            ids, words = encoded(tokens)
            h = run_hashes(hashes_of(words)[ids], n)[::n]
            bit = np.concatenate([part % np.uint64(size) for part in (h, mixed(h * MIX))])
            group, inverse = np.unique(bit >> np.uint64(6), return_inverse=True)
            value = np.zeros(len(group), dtype=np.uint64)
            np.bitwise_or.at(value, inverse, np.uint64(1) << (bit & np.uint64(63)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(group.astype(np.int64)), pa.array(value.view(np.int64))],
                names=["at", "bits"])

    found = (frequent.select("phrase").mapInArrow(set_bits, "at long, bits long")
             .groupBy("at").agg(F.expr("bit_or(bits)").alias("bits")).toArrow())
    out = np.zeros(size // 64, dtype=np.int64)
    out[found.column("at").to_numpy()] = found.column("bits").to_numpy()
    return out.view(np.uint8)


def frequent_runs(docs: DataFrame, least: int = LEAST,
                  spacing: int = SPACING) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, w, a) of all phrases of 1 to 4 words with a >= `least`, and
    (lang, n), the number of words per lang."""
    dictionary = materialize(chunk_dictionary(docs, spacing), "chunks")
    totals = dictionary.groupBy("lang").agg(
        F.sum(F.col("words") * F.col("n")).alias("n"))
    found, known, bits = None, 0, None
    for lengths in LEVELS:
        level = materialize(
            count_runs(dictionary, lengths, known, bits).where(F.col("n") >= least)
            .select("lang", "phrase", "w", F.col("n").alias("a")), f"phrases-{lengths[0]}")
        found = level if found is None else found.unionAll(level)
        if lengths != LEVELS[-1]:
            known = lengths[-1]
            bits = bloom_of(level, known)
    return found, totals


def part(first: Column | int, length: Column | int) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), first, length), " ")


def scored(found: DataFrame) -> DataFrame:
    """lang, phrase, w, a, l, r, score of the candidates."""
    candidates = found.where(F.col("w") > 1)
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("w") - 1)))
    sides = materialize(cuts.select(
        "lang", "phrase", "w", "a", "k",
        F.explode(F.array(
            F.struct(F.lit(True).alias("left"), part(F.lit(1), F.col("k")).alias("part")),
            F.struct(F.lit(False).alias("left"),
                     part(F.col("k") + 1, F.col("w") - F.col("k")).alias("part")))).alias("s"))
        .select("lang", "phrase", "w", "a", "k", "s.left",
                F.struct("lang", "s.part").alias("key")), "sides")
    facts = (found.select(F.struct("lang", F.col("phrase").alias("part")).alias("key"),
                          F.col("a").alias("f"))
             .join(sides.groupBy("key").agg(F.count(F.lit(1)).alias("held")), "key"))
    met = salted_join(sides, materialize(facts, "parts"), "key", "phrase", 2000, "held")
    cut = met.groupBy("lang", "phrase", "w", "a", "k").agg(
        F.max(F.when(F.col("left"), F.col("f"))).alias("l"),
        F.max(F.when(~F.col("left"), F.col("f"))).alias("r"))
    # products and sums in decimals: they may pass 64 bits
    score = F.expr("cast(cast(2000000 as decimal(7, 0)) * cast(a as decimal(20, 0)) "
                   "div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0))) as bigint)")
    return (cut.withColumn("score", score).groupBy("lang", "phrase", "w", "a")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
            .select("lang", "phrase", "w", "a", "m.l", "m.r", "m.score"))


def without_contained(rows: DataFrame, found: DataFrame) -> DataFrame:
    """`rows` but those that a longer candidate holds nearly always."""
    inner = (found.where(F.col("w") > 2)
             .withColumn("m", F.explode(F.sequence(F.lit(2), F.col("w") - 1)))
             .withColumn("i", F.explode(F.sequence(F.lit(1), F.col("w") - F.col("m") + 1)))
             .select("lang", "a", part(F.col("i"), F.col("m")).alias("phrase"))
             .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    wide = "cast({} as decimal(3, 0)) * cast({} as decimal(20, 0))"
    held = F.expr(f"{wide.format(100, 'longer')} >= {wide.format(80, 'a')}")
    return rows.join(inner, ["lang", "phrase"], "left").where(~F.coalesce(held, F.lit(False)))


def first_of_each_lang(rows: DataFrame, top: int, salts: int = SALTS) -> DataFrame:
    """`rows` with rank, up to `top` of each lang; a lang is dealt over salts first."""
    order = "score desc, a desc, phrase"
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts).cast("long")))
    for keys in ("lang, salt", "lang"):
        salted = salted.withColumn(
            "rank", F.expr(f"row_number() over (partition by {keys} order by {order})")
        ).where(F.col("rank") <= top)
    return salted.withColumn("rank", F.col("rank").cast("long"))


def mine(docs: DataFrame, least: int = LEAST, top: int = TOP,
         spacing: int = SPACING) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the `top` phrases of each lang."""
    found, totals = frequent_runs(docs, least, spacing)
    left = without_contained(materialize(scored(found), "scored"), found)
    ranked = first_of_each_lang(left, top)
    # one row a lang on either side of at most `top` rows each
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
