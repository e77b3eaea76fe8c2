"""Profiling.

Every statistic over many columns is one aggregation (plus one quantile
computation where quantiles are involved), returned in long form with one row
per column.
"""

from __future__ import annotations

import math

import numpy as np

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepanel.operators import moments
from tidepanel.operators.quantiles import DEFAULT_ACCURACY, pivot_quantiles, quantiles_and_stats, quantiles_wide
from tidepanel.session import bounded_broadcast, cut_lineage
from tidepanel.spec import NUMERIC_TYPES


def _stack(row_df: DataFrame, cols, fields: dict[str, callable]) -> DataFrame:
    """Turn a one-row aggregate with ``<col>__<field>`` columns into one row per column."""
    arr = F.array(*[F.struct(F.lit(c).alias("column"),
                             *[F.col(f"{c}__{f}").alias(f) for f in fields]) for c in cols])
    return row_df.select(F.explode(arr).alias("s")).select("s.*")


def table_shape(df: DataFrame) -> DataFrame:
    """``(n_rows, n_columns)``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("bigint"))


def column_types(df: DataFrame) -> DataFrame:
    """``(column, data_type, non_null)`` -- one aggregation."""
    cols = df.columns
    agg = df.agg(*[F.count(F.col(c)).alias(f"{c}__non_null") for c in cols])
    dtypes = dict(df.dtypes)
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(dtypes[c]).alias("data_type"),
                             F.col(f"{c}__non_null").alias("non_null")) for c in cols])
    return agg.select(F.explode(arr).alias("s")).select("s.*")


def describe_numeric(df: DataFrame, cols=None, *, exact: bool = True,
                     accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """Count, mean, sample std, min, 25/50/75 % (interpolated), max.

    Two scans: the moments ride along in the quantiles' first pass."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]
    qs, names = [0.25, 0.5, 0.75], ["p25", "p50", "p75"]
    long, stats = quantiles_and_stats(
        df, cols, qs, exact=exact, accuracy=accuracy,
        extra={"count": F.count("v"), "mean": F.avg("v"), "std": F.stddev_samp("v"),
               "min": F.min("v"), "max": F.max("v")})
    q = pivot_quantiles(long, ["column"], qs, names)
    # both sides have one row per column: a bounded broadcast by construction;
    # columns without any value have no stats row and are added with count 0
    known = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    out = known.join(F.broadcast(stats), "column", "left").join(F.broadcast(q), "column", "left")
    return out.select("column", F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
                      "mean", "std", "min", "p25", "p50", "p75", "max")


def describe_categorical(df: DataFrame, cols) -> DataFrame:
    """P4 (text part): ``(column, count, unique, top, freq)``; ties of ``top``
    go to the smallest value."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], list(cols), "column", "value").where(F.col("value").isNotNull())
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    per_col = counts.groupBy("column").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), F.max("n").alias("freq"))
    # per_col has one row per described column (bounded by len(cols))
    top = counts.join(F.broadcast(per_col.select("column", "freq")), "column") \
        .where(F.col("n") == F.col("freq")).groupBy("column").agg(F.min("value").alias("top"))
    return per_col.join(top, "column").select("column", "count", "unique", "top", "freq")


def describe_all(df: DataFrame, *, exact: bool = True, accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """One row per column of any kind. Numeric columns have moments and quantiles,
    the others their distinct count, most frequent value and its frequency; what
    does not apply is NULL."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]
    other = [c for c in df.columns if c not in numeric]
    names = ["column", "count", "unique", "top", "freq", "mean", "std", "min", "p25", "p50", "p75", "max"]
    parts = []
    if numeric:
        parts.append(describe_numeric(df, numeric, exact=exact, accuracy=accuracy))
    if other:
        text = describe_categorical(df, other)
        known = df.sparkSession.createDataFrame([(c,) for c in other], "column string")
        parts.append(known.join(F.broadcast(text), "column", "left").withColumns({
            "count": F.coalesce("count", F.lit(0)).cast("bigint"),
            "unique": F.coalesce("unique", F.lit(0)).cast("bigint")}))
    kinds = {"unique": "bigint", "top": "string", "freq": "bigint"}
    out = None
    for part in parts:
        part = part.select(*[F.col(n) if n in part.columns else
                             F.lit(None).cast(kinds.get(n, "double")).alias(n) for n in names])
        out = part if out is None else out.unionByName(part)
    return out


def missing_counts(df: DataFrame, cols=None) -> DataFrame:
    """P5: ``(column, missing_count)`` in one pass (NaN counts as missing)."""
    cols = cols or df.columns
    dtypes = {f.name: f.dataType for f in df.schema.fields}

    def miss(c):
        m = F.col(c).isNull()
        if isinstance(dtypes[c], (T.DoubleType, T.FloatType)):
            m = m | F.isnan(c)
        return F.count_if(m).alias(f"{c}__missing_count")
    return _stack(df.agg(*[miss(c) for c in cols]), cols, {"missing_count": 0})


def sentinel_counts(df: DataFrame, value: float, cols=None) -> DataFrame:
    """Cells equal to ``value`` per column; text columns count 0."""
    cols = cols or df.columns
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    aggs = [(F.count_if(F.col(c) == F.lit(float(value))) if isinstance(dtypes[c], NUMERIC_TYPES)
             else F.lit(0).cast("bigint")).alias(f"{c}__sentinel_count") for c in cols]
    return _stack(df.agg(*aggs), cols, {"sentinel_count": 0})


def histogram(df: DataFrame, cols, bins: int = 10) -> DataFrame:
    """Equal-width bins over [min, max] per column, last bin closed;
    ``(column, bin, lo, hi, count)`` including empty bins."""
    rng = df.agg(*chain_aggs(cols)).first()
    spark = df.sparkSession
    edges = []
    for c in cols:
        lo, hi = rng[f"{c}__min"], rng[f"{c}__max"]
        if lo is None:
            continue
        edges.append((c, float(lo), float(hi)))
    if not edges:
        return spark.createDataFrame([], "column string, bin int, lo double, hi double, count bigint")
    parts = []
    for c, lo, hi in edges:
        x = F.col(c).cast("double")
        width = hi - lo
        b = F.lit(0) if width == 0 else F.least(
            F.floor((x - F.lit(lo)) / F.lit(width) * F.lit(bins)).cast("int"), F.lit(bins - 1))
        parts.append(F.when(x.isNotNull() & ~F.isnan(x), F.struct(F.lit(c).alias("column"), b.alias("bin"))))
    binned = df.select(F.explode(F.array(*parts)).alias("s")).where(F.col("s").isNotNull()) \
        .select("s.column", "s.bin")
    counts = binned.groupBy("column", "bin").agg(F.count(F.lit(1)).alias("count"))
    grid = spark.createDataFrame(
        [(c, i, lo + i * (hi - lo) / bins, lo + (i + 1) * (hi - lo) / bins)
         for c, lo, hi in edges for i in range(bins)],
        "column string, bin int, lo double, hi double")
    # both sides have at most len(cols) x bins rows: bounded by the parameters
    return grid.join(F.broadcast(counts), ["column", "bin"], "left").select(
        "column", "bin", "lo", "hi", F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))


def chain_aggs(cols):
    out = []
    for c in cols:
        x = F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
        out += [F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    return out


BOX = ("q1", "median", "q3", "whisker_lo", "whisker_hi")


def five_number(df: DataFrame, col: str, by=(), *, whis: float = 1.5, where: Column | None = None,
                exact: bool = True, accuracy: int = DEFAULT_ACCURACY,
                log_scale: bool = False) -> DataFrame:
    """Per group q1, median, q3, whiskers (most extreme data inside the
    1.5 IQR fences) and the number of fliers. ``log_scale`` adds log10 columns
    (non-positive -> NULL). Without groups and without values: no row."""
    by = list(by)
    data = df if where is None else df.where(where)
    data = data.select(*by, F.col(col).cast("double").alias(col)).where(
        F.col(col).isNotNull() & ~F.isnan(col))
    q = quantiles_wide(data, [col], [0.25, 0.5, 0.75], by, names=["q1", "median", "q3"],
                       exact=exact, accuracy=accuracy).drop("column")
    iqr = F.col("q3") - F.col("q1")
    q = q.withColumns({"lo_fence": F.col("q1") - F.lit(whis) * iqr,
                       "hi_fence": F.col("q3") + F.lit(whis) * iqr})
    if by:
        # one row per group, written once to the checkpoint folder: the size
        # proof of the broadcast and the join both read the stored rows
        # instead of re-running the quantile passes
        joined = data.join(bounded_broadcast(cut_lineage(q)), by, "inner")
    else:  # one fitted row -> literals
        r = q.first()
        if r is None:
            return df.sparkSession.createDataFrame(
                [], "q1 double, median double, q3 double, whisker_lo double, "
                    "whisker_hi double, n_fliers bigint, n bigint" + "".join(
                        f", log10_{c} double" for c in BOX if log_scale))
        joined = data.withColumns({k: F.lit(r[k]).cast("double") for k in
                                   ["q1", "median", "q3", "lo_fence", "hi_fence"]})
    x = F.col(col)
    agg = joined.groupBy(*by).agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.min(F.when(x >= F.col("lo_fence"), x)).alias("whisker_lo"),
        F.max(F.when(x <= F.col("hi_fence"), x)).alias("whisker_hi"),
        F.count_if((x < F.col("lo_fence")) | (x > F.col("hi_fence"))).alias("n_fliers"),
        F.count(F.lit(1)).alias("n"))
    if log_scale:
        for c in BOX:
            agg = agg.withColumn(f"log10_{c}", F.when(F.col(c) > 0, F.log10(c)))
    return agg


def corr_matrix(df: DataFrame, cols, *, pairs: str = "upper") -> DataFrame:
    """P10: Pearson correlation of every pair over the rows where both values
    are present, all pairs in one pass (``moments``); NULL when either side has no
    spread. ``pairs``: ``upper`` (a < b in column order), ``all`` (both orders and the
    diagonal)."""
    found = moments.pair_moments(df, cols)
    names = F.array(*[F.lit(c) for c in cols])
    den = F.sqrt(F.col("q_i") * F.col("q_j"))
    known = found.select(F.get(names, F.col("i").cast("int")).alias("col_a"),
                         F.get(names, F.col("j").cast("int")).alias("col_b"),
                         F.when(den > 0, F.col("p") / den).alias("corr"))
    # pairs without a common row, and tables without rows, have their rows all the same
    plist = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    every = df.sparkSession.createDataFrame(plist, "col_a string, col_b string")
    upper = every.join(known, ["col_a", "col_b"], "left")
    if pairs == "upper":
        return upper
    lower = upper.select(F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "corr")
    diag = df.sparkSession.createDataFrame([(c, c, 1.0) for c in cols], "col_a string, col_b string, corr double")
    return upper.unionByName(lower).unionByName(diag)


def top_correlated_pairs(df: DataFrame, cols, n: int = 10, *, mirrored: bool = False,
                         drop_perfect: bool = True) -> DataFrame:
    """Strongest absolute correlations, self pairs removed.

    ``drop_perfect`` keeps the reference filter ``|r| < 1`` (which also drops
    distinct pairs with |r| = 1); ``mirrored`` lists (a, b) and (b, a)."""
    cm = corr_matrix(df, cols, pairs="all" if mirrored else "upper").where(
        F.col("col_a") != F.col("col_b")).withColumn("abs_corr", F.abs("corr")).where(
        F.col("abs_corr").isNotNull())
    if drop_perfect:
        cm = cm.where(F.col("abs_corr") < 1)
    return cm.orderBy(F.desc("abs_corr"), "col_a", "col_b").limit(n)


def class_distribution(df: DataFrame, col: str, labels) -> DataFrame:
    """Count per label; missing labels form their own row and labels
    that never occur appear with 0."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    known = df.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(v) for v in labels])).alias(col))
    out = known.join(counts, col, "full_outer")
    return out.select(col, F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Count per value, sorted by value."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(F.col(col).asc_nulls_last())


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct non-missing values."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def kde_grid(df: DataFrame, cols, points: int = 200, fine_bins: int = 2048,
             cut: float = 3.0, method: str = "exact") -> DataFrame:
    """Gaussian kernel density on a grid (Scott bandwidth, grid over
    [min - cut*bw, max + cut*bw]); ``(column, point, x, density)``.

    ``method="exact"`` sums the kernel of every row at every grid point: one
    aggregation with ``points`` sums per column (work points x n, no pairs of
    rows, nothing kept per row). ``method="binned"`` first reduces each column
    to ``fine_bins`` weighted bin centres, so that the kernel work is
    independent of the row count (error bounded by the bin width).
    """
    if method not in ("exact", "binned"):
        raise ValueError("method must be 'exact' or 'binned'")
    spark = df.sparkSession
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__n"), F.stddev_samp(x).alias(f"{c}__sd"),
                 F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    st = df.agg(*aggs).first()
    specs = []
    for c in cols:
        n, sd, lo, hi = st[f"{c}__n"], st[f"{c}__sd"], st[f"{c}__min"], st[f"{c}__max"]
        if not n or sd is None or sd == 0:
            continue
        bw = sd * n ** (-1.0 / 5.0)
        specs.append((c, n, bw, lo, hi))
    if not specs:
        return spark.createDataFrame([], "column string, point int, x double, density double")
    if method == "exact":
        norm = math.sqrt(2 * math.pi)
        grid_rows = []
        for c, n, bw, lo, hi in specs:
            g0, g1 = lo - cut * bw, hi + cut * bw
            grid_rows += [(c, i, g0 + (g1 - g0) * i / (points - 1), float(bw), float(n) * bw * norm)
                          for i in range(points)]
        # cols x points rows, bounded by the parameters
        grid = spark.createDataFrame(grid_rows, "column string, point int, x double, bw double, den double")
        names = [c for c, *_ in specs]
        points_of = {c: np.array([g[2] for g in grid_rows if g[0] == c]) for c in names}
        widths = {c: bw for c, _, bw, _, _ in specs}

        def partial(batches):
            import pandas as pd
            sums = {c: np.zeros(points) for c in names}
            for pdf in batches:
                for c in names:
                    v = pdf[c].dropna().to_numpy(dtype="float64")
                    for at in range(0, len(v), 2000):
                        z = (points_of[c][:, None] - v[None, at:at + 2000]) / widths[c]
                        sums[c] += np.exp(-0.5 * z * z).sum(axis=1)
            for c in names:
                yield pd.DataFrame({"column": c, "point": np.arange(points), "k": sums[c]})

        # a task sends cols x points sums, however many rows it read
        sums = df.select(*[F.col(c).cast("double").alias(c) for c in names]).mapInPandas(
            partial, "column string, point int, k double").groupBy("column", "point").agg(
            F.sum("k").alias("k"))
        return sums.join(F.broadcast(grid), ["column", "point"]).select(
            "column", "point", "x", (F.col("k") / F.col("den")).alias("density"))
    parts = []
    for c, n, bw, lo, hi in specs:
        w = (hi - lo) / fine_bins if hi > lo else 1.0
        b = F.least(F.floor((F.col(c).cast("double") - F.lit(lo)) / F.lit(w)).cast("int"),
                    F.lit(fine_bins - 1))
        parts.append(F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("column"), b.alias("b"))))
    fine = df.select(F.explode(F.array(*parts)).alias("s")).where(F.col("s").isNotNull()) \
        .groupBy("s.column", "s.b").agg(F.count(F.lit(1)).alias("w"))
    grid_rows = []
    meta_rows = []
    for c, n, bw, lo, hi in specs:
        g0, g1 = lo - cut * bw, hi + cut * bw
        for i in range(points):
            grid_rows.append((c, i, g0 + (g1 - g0) * i / (points - 1)))
        w = (hi - lo) / fine_bins if hi > lo else 1.0
        meta_rows.append((c, float(n), float(bw), float(lo), float(w)))
    grid = spark.createDataFrame(grid_rows, "column string, point int, x double")
    meta = spark.createDataFrame(meta_rows, "column string, n double, bw double, lo double, width double")
    centres = fine.join(F.broadcast(meta), "column").withColumn(
        "centre", F.col("lo") + (F.col("b") + F.lit(0.5)) * F.col("width"))
    # grid (cols x points) meets bins (cols x fine_bins): both bounded by parameters
    z = (F.col("x") - F.col("centre")) / F.col("bw")
    dens = F.broadcast(grid).join(centres, "column").groupBy("column", "point", "x").agg(
        (F.sum(F.col("w") * F.exp(F.lit(-0.5) * z * z)) /
         (F.first("n") * F.first("bw") * F.lit(math.sqrt(2 * math.pi)))).alias("density"))
    return dens
