"""Exact quantiles (linear interpolation) without an unbounded buffer.

Spark's ``percentile`` aggregate is exact but keeps every distinct value of a
group in one buffer, so a hot group (or a global quantile) ends in one task
holding all its distinct values. Here:

1. one pass computes ``count`` and ``percentile_approx`` at ``q -/+ 3/accuracy``
   per (group, column): the values of ranks ``floor(q(n-1))`` and the next one
   are guaranteed to lie between the two approximate values;
2. one pass counts, per (group, column, q), the rows below the window and the
   rows per distinct value inside it (at most about ``6 n / accuracy``
   distinct values, or the whole group when ``n <= accuracy``);
3. a running sum over the window picks the two order statistics, which are
   interpolated as ``v_i + frac (v_{i+1} - v_i)`` (same definition as
   ``percentile`` / ``quantile_cont``).

Both passes combine inside the tasks before their exchange: the windows of pass 1, one
row per group and column, are broadcast where their number allows it, so no data row is
exchanged on its group. Without groups, the windows of pass 1 are read back (columns x quantiles numbers)
and pass 2 applies them as literals: one conditional aggregation for the counts
below and one count per distinct value inside, with no join and no exchange of
data rows; a window that holds too many rows is narrowed again first.

Everything stays distributed; only the final table (one row per group, column
and quantile) is small. ``exact=False`` returns ``percentile_approx`` alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.session import bounded_broadcast, cut_lineage

DEFAULT_ACCURACY = 100_000
MOST_GROUPS = 100_000  # (group, column) windows sent to all tasks; more are joined


def _long(df: DataFrame, cols, by) -> DataFrame:
    by = list(by)
    data = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols])
    long = data.unpivot(by, list(cols), "column", "v")
    return long.where(F.col("v").isNotNull() & ~F.isnan("v"))


def quantiles(df: DataFrame, cols, qs, by=(), *, exact: bool = True,
              accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """Long table ``(*by, column, q, value)``; NULL/NaN ignored."""
    return quantiles_and_stats(df, cols, qs, by, exact=exact, accuracy=accuracy)[0]


def quantiles_and_stats(df: DataFrame, cols, qs, by=(), *, exact: bool = True,
                        accuracy: int = DEFAULT_ACCURACY, extra: dict | None = None):
    """:func:`quantiles` plus ``(*by, column, <extra>)``: further aggregates of
    the value ``v`` (e.g. ``{"mean": F.avg("v")}``) computed in the quantiles'
    first pass, so they cost no scan of their own."""
    by = list(by)
    qs = [float(q) for q in qs]
    long = _long(df, cols, by)
    keys = [*by, "column"]
    extra_aggs = [e.alias(name) for name, e in (extra or {}).items()]
    if not exact:
        approx = long.groupBy(*keys).agg(
            F.percentile_approx("v", F.array(*[F.lit(q) for q in qs]), accuracy).alias("a"),
            *extra_aggs)
        out = approx.select(*keys, F.posexplode("a").alias("qi", "value")).select(
            *keys, F.element_at(F.array(*[F.lit(q) for q in qs]), F.col("qi") + 1).alias("q"),
            "value")
        return out, approx.select(*keys, *(extra or {}))

    eps = 1.0 / accuracy
    lo_q = [max(0.0, q - 3 * eps) for q in qs]
    hi_q = [min(1.0, q + 3 * eps) for q in qs]
    grid = F.array(*[F.lit(x) for x in lo_q + hi_q])
    stats = long.groupBy(*keys).agg(
        F.count("v").alias("n"), F.percentile_approx("v", grid, accuracy).alias("a"), *extra_aggs)
    stats = cut_lineage(stats)  # one row per group and column, read several times below
    nq = len(qs)
    small = F.col("n") <= F.lit(accuracy)
    targets = stats.select(
        *keys, "n",
        F.array(*[F.when(small, F.lit(float("-inf"))).otherwise(F.col("a")[j])
                  for j in range(nq)]).alias("lo"),
        F.array(*[F.when(small, F.lit(float("inf"))).otherwise(F.col("a")[nq + j])
                  for j in range(nq)]).alias("hi"))

    if not by:
        return _ungrouped(df, cols, qs, targets, accuracy), stats.select(*keys, *(extra or {}))

    # Pass 2: per (group, column, q): below-count row (key NULL) + window values.
    joined = long.join(bounded_broadcast(targets.drop("n"), MOST_GROUPS), keys, "inner")
    qi = F.explode(F.sequence(F.lit(0), F.lit(nq - 1))).alias("qi")
    per_q = joined.select(*keys, "v", "lo", "hi", qi)
    lo_i = F.col("lo")[F.col("qi")]
    hi_i = F.col("hi")[F.col("qi")]
    per_q = per_q.where(F.col("v") <= hi_i).select(
        *keys, "qi", F.when(F.col("v") >= lo_i, F.col("v")).alias("k"))
    counts = per_q.groupBy(*keys, "qi", "k").agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(*keys, "qi").orderBy(F.col("k").asc_nulls_first())
    counts = counts.withColumn("cum", F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, 0)))

    qarr = F.array(*[F.lit(q) for q in qs])
    ranks = targets.select(*keys, "n", F.posexplode(qarr).alias("qi", "q")).withColumn(
        "pos", F.col("q") * (F.col("n") - 1).cast("double")).withColumn(
        "i", F.floor("pos").cast("bigint")).withColumn(
        "frac", F.col("pos") - F.col("i").cast("double"))
    sel = counts.join(ranks, [*keys, "qi"], "inner").where(F.col("k").isNotNull())
    picked = sel.groupBy(*keys, "qi").agg(
        F.min(F.when(F.col("cum") > F.col("i"), F.col("k"))).alias("v0"),
        F.min(F.when(F.col("cum") > F.col("i") + 1, F.col("k"))).alias("v1"))
    out = ranks.join(picked, [*keys, "qi"], "inner").select(
        *keys, "q",
        F.when(F.col("frac") > 0, F.col("v0") + F.col("frac") * (F.col("v1") - F.col("v0")))
        .otherwise(F.col("v0")).alias("value"))
    return out, stats.select(*keys, *(extra or {}))


MOST_IN_WINDOW = 1_000_000  # rows of one (column, q) that one running sum may order


def _ungrouped(df: DataFrame, cols, qs, targets: DataFrame, accuracy: int) -> DataFrame:
    """Pass 2 without groups: the windows (columns x quantiles) come back as literals,
    so no data row is exchanged before it is counted. A window that still holds
    more than ``MOST_IN_WINDOW`` rows is narrowed again about the wanted rank."""
    spark = df.sparkSession
    x = {c: F.col(c).cast("double") for c in cols}
    bounds = {}  # (column, qi) -> (n, lo, hi)
    for row in targets.collect():
        for j in range(len(qs)):
            bounds[row["column"], j] = (row["n"], row["lo"][j], row["hi"][j])
    if not bounds:
        return spark.createDataFrame([], "column string, q double, value double")

    def valid(c):
        return x[c].isNotNull() & ~F.isnan(x[c])

    def inside(c, lo, hi):
        return valid(c) & (x[c] >= F.lit(lo)) & (x[c] <= F.lit(hi))

    keys = list(bounds)
    while True:
        sums = df.agg(*[F.sum((valid(c) & (x[c] < F.lit(bounds[c, j][1]))).cast("long")).alias(f"b{t}")
                        for t, (c, j) in enumerate(keys)],
                      *[F.sum(inside(c, *bounds[c, j][1:]).cast("long")).alias(f"w{t}")
                        for t, (c, j) in enumerate(keys)]).first()
        wide = [t for t, k in enumerate(keys)
                if sums[f"w{t}"] > MOST_IN_WINDOW and bounds[k][1] < bounds[k][2]]
        if not wide:
            break
        aggs = []
        for t in wide:
            (c, j), share = keys[t], (qs[keys[t][1]] * (bounds[keys[t]][0] - 1) - sums[f"b{t}"]) / sums[f"w{t}"]
            aggs.append(F.percentile_approx(
                F.when(inside(c, *bounds[c, j][1:]), x[c]),
                F.array(*[F.lit(min(1.0, max(0.0, share + d))) for d in (-3 / accuracy, 3 / accuracy)]),
                accuracy).alias(f"a{t}"))
        narrower = df.agg(*aggs).first()
        same = True
        for t in wide:
            n, lo, hi = bounds[keys[t]]
            got = tuple(narrower[f"a{t}"])
            same &= got == (lo, hi)
            bounds[keys[t]] = (n, *got)
        if same:
            break  # few distinct values: the counts per value are small already

    entries = F.array(*[F.when(inside(c, *bounds[c, j][1:]),
                               F.struct(F.lit(c).alias("column"), F.lit(j).alias("qi"), x[c].alias("k")))
                        for c, j in keys])
    counts = (df.select(F.explode(F.filter(entries, lambda e: e.isNotNull())).alias("e"))
              .groupBy("e.column", "e.qi", "e.k").agg(F.count(F.lit(1)).alias("c")))
    ranks = []
    for t, (c, j) in enumerate(keys):
        position = qs[j] * float(bounds[c, j][0] - 1)
        ranks.append((c, j, qs[j], int(position), position - int(position), int(sums[f"b{t}"])))
    ranks = F.broadcast(spark.createDataFrame(
        ranks, "column string, qi int, q double, i long, frac double, below long"))
    w = Window.partitionBy("column", "qi").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    cum = counts.join(ranks, ["column", "qi"]).withColumn("cum", F.col("below") + F.sum("c").over(w))
    picked = cum.groupBy("column", "qi", "q", "frac").agg(
        F.min(F.when(F.col("cum") > F.col("i"), F.col("k"))).alias("v0"),
        F.min(F.when(F.col("cum") > F.col("i") + 1, F.col("k"))).alias("v1"))
    return picked.select(
        "column", "q", F.when(F.col("frac") > 0, F.col("v0") + F.col("frac") * (F.col("v1") - F.col("v0")))
        .otherwise(F.col("v0")).alias("value"))


def quantile_values(df: DataFrame, cols, qs, *, exact: bool = True,
                    accuracy: int = DEFAULT_ACCURACY) -> dict:
    """Ungrouped quantiles as ``{(column, q): value}`` (bounded: cols x qs)."""
    rows = quantiles(df, cols, qs, exact=exact, accuracy=accuracy).collect()
    out = {(c, float(q)): None for c in cols for q in qs}
    for r in rows:
        out[(r["column"], float(r["q"]))] = r["value"]
    return out


def quantiles_wide(df: DataFrame, cols, qs, by=(), *, names=None, exact=True,
                   accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """``(*by, column, <name per q>)`` -- one row per group and column."""
    names = names or [f"q{int(round(q * 100))}" for q in qs]
    long = quantiles(df, cols, qs, by, exact=exact, accuracy=accuracy)
    return pivot_quantiles(long, [*by, "column"], qs, names)


def pivot_quantiles(long: DataFrame, keys, qs, names) -> DataFrame:
    return long.groupBy(*keys).agg(*[
        F.max(F.when(F.col("q") == F.lit(float(q)), F.col("value"))).alias(nm)
        for q, nm in zip(qs, names)])
