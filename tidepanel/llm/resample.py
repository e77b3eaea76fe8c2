"""Target-distribution importance resampling.

A document's weight is the mean log ratio of its features' frequencies in a target
table and in the documents themselves: features (runs of 1 to `longest` words) are
hashed into `buckets`, both tables' bucket counts are added up by Spark, and the
array of gains that follows goes to the tasks, which score a batch by indexing it.
Gumbel noise from a hash of the doc_id turns weights into a sample without
replacement: the documents with the highest weight plus noise are drawn.

Cutoff. A mergeable quantile sketch of the scores brackets the score at which the
draw ends; one exact count of what lies above and inside says whether it does, and
the bracket is widened until it does. Only the bracket is ordered, by ranges
(score, then doc_id), to find the cutoff; ranks come from the same kind of ranges:
counts of the ranges before, and the place inside one. No task orders more than a
range, and the driver gets one number a range.

Defined cases: null, empty and word-less texts have no features and weight 0; they
are never drawn unless `least_words` is 0; a null doc_id enters its hash as an empty
string and comes before the others in ties; rows that share a doc_id are documents
of their own, which tie in any order; an empty target gives gains from the documents
alone; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import materialize, text_or_empty

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
ACCURACY = 1_000   # of the sketch: rank error about rows / ACCURACY
RANGE_ROWS = 200_000
CACHE = 500_000
#: A-Z to a-z; every byte that is no digit, letter or part of a longer character to space
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128
              else 32 for b in range(256))


class BucketOf(dict):
    """Bucket of a feature, remembered up to CACHE features."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        bucket = self[feature] = zlib.crc32(feature) % self.buckets
        return bucket


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


def features_of(words: list[bytes], longest: int):
    yield from words
    for n in range(2, longest + 1):
        for i in range(len(words) - n + 1):
            yield b" ".join(words[i:i + n])


def feature_count(words: int, longest: int) -> int:
    return sum(max(0, words - n + 1) for n in range(1, longest + 1))


def buckets_of(words: list[bytes], longest: int, bucket_of: BucketOf) -> np.ndarray:
    found = words if longest == 1 else features_of(words, longest)
    return np.fromiter(map(bucket_of.__getitem__, found), dtype=np.int64,
                       count=feature_count(len(words), longest))


def bucket_counts(table: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """Features of `table.text` in each bucket; one array of `buckets` numbers a task."""
    def count(batches):
        bucket_of, total = BucketOf(buckets), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for text in batch.column("text"):
                total += np.bincount(buckets_of(words_of(text.as_py()), longest, bucket_of),
                                     minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])],
                                         names=["bucket", "n"])

    rows = (table.select(text_or_empty("text").cast("binary").alias("text"))
            .mapInArrow(count, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(buckets, dtype=np.int64)
    for r in rows:  # at most `buckets` of them
        out[r.bucket] = r.n
    return out


def gains(docs: DataFrame, target: DataFrame, longest: int = 1,
          buckets: int = BUCKETS) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's share, target to documents."""
    s, t = (bucket_counts(x, longest, buckets) for x in (docs, target))
    s_all, t_all = float(s.sum() + buckets), float(t.sum() + buckets)
    return np.array([math.floor(1000 * math.log((b + 1.0) * s_all / ((a + 1.0) * t_all)))
                     for a, b in zip(s.tolist(), t.tolist())], dtype=np.int64)


def weights(docs: DataFrame, gain: np.ndarray, longest: int = 1) -> DataFrame:
    """doc_id, words, n_features, weight of every row."""
    buckets = len(gain)

    def score(batches):
        bucket_of = BucketOf(buckets)
        for batch in batches:
            words, n, weight = [], [], []
            for text in batch.column("text"):
                found = words_of(text.as_py())
                held = buckets_of(found, longest, bucket_of)
                words.append(len(found))
                n.append(len(held))
                weight.append(int(gain[held].sum()) // len(held) if len(held) else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (words, n, weight))],
                names=["doc_id", "words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       text_or_empty("text").cast("binary").alias("text")).mapInArrow(
        score, "doc_id long, words long, n_features long, weight long")


def with_score(rows: DataFrame, seed: int = SEED) -> DataFrame:
    """`rows` with weight plus noise."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    return rows.withColumn("score", (F.col("weight") + noise).cast("long"))


def bracket(rows: DataFrame, n: int, wanted: int, accuracy: int) -> tuple[int, int, int]:
    """(low, high, above): the wanted-th highest of n scores lies in [low, high], and `above`
    scores are higher than `high`. Bounds come from a sketch; the counts are exact."""
    share, slack = 1 - wanted / n, 2 / accuracy
    while True:
        low, high = rows.agg(F.percentile_approx(
            "score", [max(0.0, share - slack), min(1.0, share + slack)], accuracy)).first()[0]
        score = F.col("score")
        above, inside = rows.agg(
            F.count(F.when(score > high, 1)),
            F.count(F.when((score >= low) & (score <= high), 1))).first()
        if above < wanted <= above + inside:
            return low, high, above
        slack *= 4


def ordered_ranges(rows: DataFrame, n: int) -> DataFrame:
    """`rows` (score, doc_id, row; n of them) with place, their place from 1 in the order
    score descending, doc_id, row: dealt by ranges, and counted on from range to range."""
    parts = max(1, math.ceil(n / RANGE_ROWS))
    dealt = rows.repartitionByRange(parts, F.desc("score"), F.asc("doc_id"), F.asc("row"))
    dealt = materialize(dealt.withColumn("part", F.spark_partition_id()), "ranges")
    before, total = [], 0
    counts = {r.part: r.n for r in dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    for p in range(max(counts, default=-1) + 1):
        before.append(total)
        total += counts.get(p, 0)
    offset = F.get(F.array(*[F.lit(b).cast("long") for b in before or [0]]), F.col("part"))
    inside = F.expr("row_number() over (partition by part order by score desc, doc_id, row)")
    return dealt.withColumn("place", (inside + offset).cast("long")).drop("part")


def draw(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = BUCKETS,
         least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED,
         accuracy: int = ACCURACY) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank (null if not drawn)."""
    rows = materialize(with_score(weights(docs, gains(docs, target, longest, buckets), longest),
                                  seed).withColumn("row", F.monotonically_increasing_id()),
                       "scored")
    asked = rows.where(F.col("words") >= least_words).select("row", "score", "doc_id")
    n = asked.count()
    wanted = percent * n // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    if not wanted:
        return rows.select(*columns, F.lit(None).cast("long").alias("rank"))
    low, high, above = bracket(asked, n, wanted, accuracy)
    # only the bracket is ordered to find the cutoff
    inside = asked.where(F.col("score").between(low, high))
    last = (ordered_ranges(inside, inside.count()).where(F.col("place") == wanted - above)
            .select("score", "doc_id", "row").first())
    doc, row = F.col("doc_id"), F.col("row")
    sooner = doc.eqNullSafe(F.lit(last.doc_id)) & (row <= last.row)
    if last.doc_id is not None:
        sooner = sooner | doc.isNull() | F.coalesce(doc < last.doc_id, F.lit(False))
    drawn = asked.where((F.col("score") > last.score) | ((F.col("score") == last.score) & sooner))
    ranked = ordered_ranges(drawn, wanted).select("row", F.col("place").alias("rank"))
    return rows.join(ranked, "row", "left").select(*columns, "rank")
