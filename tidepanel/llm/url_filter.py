"""URL filter: host rules, else logistic regression on hashed character n-grams.

Everything is DataFrame expressions. A url's features are the hashed runs of
3 and 4 characters of its host (with marked ends) and of its path, each distinct
bucket once, with the value 1 / sqrt(number of buckets). `train` fits the weights by
gradient descent inside one expression over one row: the labelled table is small by
contract (`sample_rows`, the lowest hashes of the url), so the row is bounded. The
weights come back as whole millionths, so that a score is an exact sum, and are
applied as one array literal of `buckets` numbers: judging a table is one pass
without a shuffle.

Rules are (verdict, "host/path"): a rule fits its host and all subdomains of it, if
the url's path starts with the rule's path. The longest fitting rule decides (equally
long ones: the first given); without one, the score.

Defined cases: a null url or one without `://` has an empty host and path, which no
rule fits and which is scored like any other; a null label teaches nothing; an empty
labelled table gives the score 0 everywhere, and 0 allows; an empty table of pages
gives no rows; repeated page_ids are judged row by row; other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.llm.url_samples import labelled_urls

BUCKETS = 8192
GRAMS = (3, 4)
ROUNDS = 300
STEP = 8.0
PENALTY = 1e-4
SAMPLE_ROWS = 2_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: a run's hash: sum of code point x factor, taken twice through a prime
FACTORS, SEEDS, PRIME, SPIN = (7919, 104729, 1299709, 15485863), (17, 70001), 1000003, 48271
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"),
         ("allow", "org/fr/"))


@dataclass(frozen=True)
class Model:
    """Millionths: one weight a bucket, and the constant."""
    weights: tuple[int, ...]
    bias: int


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def runs(text: Column, seed: int, n: int, buckets: int) -> Column:
    """Buckets of all runs of n characters."""
    codes = F.transform(F.split(text, ""), lambda c: F.ascii(c).cast("long"))

    def hashed(c, i):
        total = F.lit(seed + n)
        for j in range(n):
            total = total + F.element_at(c, i + j) * F.lit(FACTORS[j])
        return ((total % PRIME * SPIN) % PRIME % buckets).cast("int")

    return let(codes, lambda c: F.when(
        F.size(c) >= n, F.transform(F.sequence(F.lit(1), F.greatest(F.size(c) - (n - 1), F.lit(1))),
                                    lambda i: hashed(c, i))).otherwise(F.array().cast("array<int>")))


def features(host: Column, path: Column, buckets: int = BUCKETS) -> Column:
    """The distinct buckets of a url, in order."""
    marked = F.concat(F.lit("^"), host, F.lit("$"))
    found = [runs(text, seed, n, buckets)
             for text, seed in zip((marked, path), SEEDS) for n in GRAMS]
    return F.array_sort(F.array_distinct(F.concat(*found)))


def labelled_table(spark: SparkSession) -> DataFrame:
    """The labelled urls that come with the library."""
    return spark.createDataFrame(labelled_urls(), "url string, label int")


def train(labelled: DataFrame, buckets: int = BUCKETS, rounds: int = ROUNDS, step: float = STEP,
          penalty: float = PENALTY, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Logistic regression (mean log loss, `penalty` / 2 on squared weights) from rows of
    url and label (1: block), by `rounds` steps of gradient descent from zero."""
    url = F.col("url").cast("string")
    rows = (labelled.where(F.col("label").isNotNull())
            .select(F.xxhash64(url).alias("order"), F.coalesce(url, F.lit("")).alias("url"),
                    (F.col("label") > 0).cast("double").alias("y"))
            .orderBy("order", "url", "y").limit(sample_rows)
            .select("url", "y", features(host_of(F.col("url")), path_of(F.col("url")),
                                         buckets).alias("f")))
    examples = rows.agg(F.array_sort(F.collect_list(F.struct("url", "y", "f"))).alias("ex"))
    # one row: the examples, and for every bucket the numbers of those that hold it
    holders = (examples.select(F.posexplode("ex").alias("i", "e"))
               .select("i", F.explode("e.f").alias("b"))
               .groupBy("b").agg(F.array_sort(F.collect_list("i")).alias("held")))
    every = (labelled.sparkSession.range(buckets).withColumnRenamed("id", "b")
             .join(holders, "b", "left")
             .select("b", F.coalesce("held", F.array().cast("array<int>")).alias("held")))
    none = F.lit(None)
    one = (examples.select("ex", none.cast("struct<b:bigint,held:array<int>>").alias("p"))
           .unionAll(every.select(none.cast(examples.schema["ex"].dataType).alias("ex"),
                                  F.struct("b", "held").alias("p")))
           .agg(F.first("ex", ignorenulls=True).alias("ex"),
                F.array_sort(F.collect_list("p")).alias("p")))
    one = one.select(
        F.transform("ex", lambda e: e["y"]).alias("y"), F.transform("ex", lambda e: e["f"]).alias("f"),
        F.transform("ex", lambda e: F.lit(1.0) / F.sqrt(F.greatest(F.size(e["f"]), F.lit(1))))
        .alias("v"), F.transform("p", lambda p: p["held"]).alias("held"))
    fitted = one.select("y", F.expr(f"""
        aggregate(sequence(1, {int(rounds)}),
                  named_struct('w', transform(held, b -> 0D), 'c', 0D),
                  (m, round) -> element_at(transform(array(transform(y, (t, e) ->
                      1D / (1D + exp(-(m.c + v[e] * aggregate(f[e], 0D, (s, b) -> s + m.w[b]))))
                      - t)), r -> named_struct(
                    'w', transform(m.w, (x, b) -> x - {step!r}D * (
                        aggregate(held[b], 0D, (s, e) -> s + r[e] * v[e]) / size(y)
                        + {penalty!r}D * x)),
                    'c', m.c - {step!r}D * aggregate(r, 0D, (s, x) -> s + x)
                         / size(y))), 1))""").alias("m"))
    row = fitted.where(F.size("y") > 0).select(
        F.expr("transform(m.w, x -> bigint(round(x * 1000000)))").alias("w"),
        F.expr("bigint(round(m.c * 1000000))").alias("c")).first()
    return Model(tuple(row.w), row.c) if row else Model((0,) * buckets, 0)


def score(host: Column, path: Column, model: Model) -> Column:
    """Log odds of `block`, in millionths."""
    weights = F.from_json(F.lit(json.dumps(model.weights)), "array<bigint>")
    return let(features(host, path, len(model.weights)), lambda f: F.aggregate(
        f, F.lit(0).cast("long"), lambda s, b: s + F.get(weights, b))
        / F.sqrt(F.greatest(F.size(f), F.lit(1))) + F.lit(model.bias))


def fits(host: Column, path: Column, rule: str) -> Column:
    name, slash, rest = rule.partition("/")
    return ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)


def judge(pages: DataFrame, model: Model,
          rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, score (millionths)."""
    rows = pages.select("page_id", host_of(F.col("url").cast("string")).alias("host"),
                        path_of(F.col("url").cast("string")).alias("path"))
    host, path = F.col("host"), F.col("path")
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # the longest is asked first; of equally long ones the first given
    for said, text in sorted(reversed(rules), key=lambda r: len(r[1])):
        rule = F.when(fits(host, path, text), text).otherwise(rule)
        verdict = F.when(fits(host, path, text), said).otherwise(verdict)
    judged = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("said"),
                         score(host, path, model).alias("score"))
    return judged.select("page_id", "host", "path", "rule", F.coalesce(
        "said", F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"),
        F.col("score"))
