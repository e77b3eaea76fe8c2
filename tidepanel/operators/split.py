"""Deterministic splits and folds by key hash.

A row's side depends only on its key (md5 of ``key:seed``), so splits are
stable under any repartitioning or re-execution after executor loss, need no
shuffle, and are reproducible on other engines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.functions.columns import hash_unit, time_number
from tidepanel.operators.quantiles import DEFAULT_ACCURACY, quantile_values

SPLIT_SCALE = 10_000


def key_of(cols, seed: str) -> Column:
    return F.concat_ws(":", *[F.col(c).cast("string") for c in cols], F.lit(seed))


def split_random(df: DataFrame, key_cols, test_fraction: float = 0.2, *, seed: str = "split",
                 col: str = "is_test") -> DataFrame:
    """``is_test`` = hash bucket of the key below ``test_fraction``."""
    b = hash_unit(key_of(key_cols, seed)) % F.lit(SPLIT_SCALE)
    return df.withColumn(col, b < F.lit(int(round(test_fraction * SPLIT_SCALE))))


def split_stratified(df: DataFrame, key_cols, label: str, test_fraction: float = 0.2, *,
                     seed: str = "split", col: str = "is_test") -> DataFrame:
    """Hash split drawn per label (the label is part of the hashed key),
    so every class keeps ``test_fraction`` of its rows in expectation."""
    return split_random(df, [label, *key_cols], test_fraction, seed=seed, col=col)


def label_thresholds(df: DataFrame, key: Column, label: str, shares,
                     max_labels: int = 1_000) -> dict:
    """{label: hash values}: for each share, the hash up to which (inclusive) the
    label has ``round(share * its rows)`` rows; None where that is no row.

    Counts of (label, hash bucket) place each rank in a bucket; only the rows of
    those buckets (1/4096 of a label each) are ordered. Labels are classes: more
    than ``max_labels`` raise.
    """
    rows = df.select(F.col(label).alias("label"), hash_unit(key).alias("h"))
    bucket = F.shiftright("h", 20)
    counts = rows.groupBy("label", bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"))
    seen = counts.select("label").distinct().limit(max_labels + 1).collect()
    if len(seen) > max_labels:
        raise ValueError(f"{label} has more than {max_labels} labels")
    w = Window.partitionBy("label").orderBy("b")
    placed = (counts.withColumn("before", F.sum("n").over(w) - F.col("n"))
              .withColumn("total", F.sum("n").over(Window.partitionBy("label")))
              .withColumn("share", F.explode(F.array(*[F.lit(float(s)) for s in shares])))
              .withColumn("rank", F.round(F.col("share") * F.col("total")).cast("long"))
              .where((F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("before") + F.col("n")))
              .select("label", "b", "share", (F.col("rank") - F.col("before")).alias("k")))
    # at most max_labels x shares rows
    wanted = F.broadcast(placed.withColumnRenamed("label", "l").withColumnRenamed("b", "pb"))
    ordered = Window.partitionBy("l", "share").orderBy("h")
    inside = rows.join(wanted, F.col("label").eqNullSafe(F.col("l")) & (bucket == F.col("pb"))) \
        .withColumn("i", F.row_number().over(ordered)).where(F.col("i") == F.col("k")).collect()
    out = {r["label"]: [None] * len(list(shares)) for r in seen}
    for r in inside:
        out[r["label"]][[float(s) for s in shares].index(r["share"])] = r["h"]
    return out


def _above(df: DataFrame, key: Column, label: str, thresholds: dict) -> Column:
    """How many of its label's thresholds a row's hash exceeds."""
    h, out = hash_unit(key), None
    for value, cuts in thresholds.items():
        n = sum([(h > F.lit(c)).cast("int") if c is not None else F.lit(1) for c in cuts], F.lit(0))
        same = F.col(label).eqNullSafe(F.lit(value))
        out = F.when(same, n) if out is None else out.when(same, n)
    return out if out is not None else F.lit(None).cast("int")


def split_stratified_exact(df: DataFrame, key_cols, label: str, test_fraction: float = 0.2, *,
                           seed: str = "split", col: str = "is_test") -> DataFrame:
    """X2 with exact counts: of every label, the ``round(test_fraction * n)`` rows of
    the lowest key hashes are test rows (rows of equal hash go together)."""
    key = key_of(key_cols, seed)
    cuts = label_thresholds(df, key, label, [test_fraction])
    return df.withColumn(col, _above(df, key, label, cuts) == 0)


def stratified_kfold_exact(df: DataFrame, key_cols, label: str, k: int = 5, *, seed: str = "fold",
                           col: str = "fold") -> DataFrame:
    """X5 with exact counts: every label's rows, ordered by key hash, are cut into k
    runs whose sizes differ by at most one."""
    key = key_of(key_cols, seed)
    cuts = label_thresholds(df, key, label, [i / k for i in range(1, k)])
    return df.withColumn(col, _above(df, key, label, cuts).cast("int"))


def split_ordered(df: DataFrame, time_col: str, test_fraction: float = 0.2, *,
                  col: str = "is_test", exact: bool = True,
                  accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """No shuffle -- rows up to the ``1 - test_fraction`` time quantile
    train, later rows test. The cut-off is one fitted value."""
    t = time_number(time_col, df.schema[time_col].dataType)
    tmp = df.select(t.alias("_t"))
    cut = quantile_values(tmp, ["_t"], [1.0 - test_fraction], exact=exact,
                          accuracy=accuracy)[("_t", 1.0 - test_fraction)]
    if cut is None:
        return df.withColumn(col, F.lit(None).cast("boolean"))
    return df.withColumn(col, t > F.lit(float(cut)))


def kfold(df: DataFrame, key_cols, k: int = 5, *, seed: str = "fold", col: str = "fold") -> DataFrame:
    """Fold id 0..k-1 from the key hash."""
    return df.withColumn(col, (hash_unit(key_of(key_cols, seed)) % F.lit(int(k))).cast("int"))


def stratified_kfold(df: DataFrame, key_cols, label: str, k: int = 5, *, seed: str = "fold",
                     col: str = "fold") -> DataFrame:
    """Fold id per label (label in the hashed key)."""
    return kfold(df, [label, *key_cols], k, seed=seed, col=col)
