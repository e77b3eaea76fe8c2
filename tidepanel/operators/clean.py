"""Sentinel, threshold and outlier cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.functions import columns as fx
from tidepanel.operators.quantiles import DEFAULT_ACCURACY, quantiles_wide


def sentinel_to_null(df: DataFrame, rules: dict[str, float]) -> DataFrame:
    """Exact sentinel value -> NULL, per column."""
    return df.withColumns({c: fx.sentinel_to_null(c, v) for c, v in rules.items()})


def threshold_to_null(df: DataFrame, rules: dict[str, float]) -> DataFrame:
    """Value above the column's limit -> NULL (missing stays missing)."""
    return df.withColumns({c: fx.threshold_to_null(c, v) for c, v in rules.items()})


def drop_sentinel_rows(df: DataFrame, rules: dict[str, float]) -> DataFrame:
    """Drop rows where any column equals its sentinel; rows with a missing
    value in that column are kept (null-safe inequality)."""
    cond = None
    for c, v in rules.items():
        keep = ~F.col(c).eqNullSafe(F.lit(float(v)))
        cond = keep if cond is None else cond & keep
    return df if cond is None else df.where(cond)


def clip(df: DataFrame, bounds: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """C4: winsorise each column to its (lo, hi); NULL stays NULL."""
    return df.withColumns({c: fx.clip(c, lo, hi) for c, (lo, hi) in bounds.items()})


def iqr_bounds(df: DataFrame, cols, k: float = 1.5, *, exact: bool = True,
               accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """``(column, q1, q3, iqr, lower, upper)`` with fences q1 - k iqr, q3 + k iqr.

    One quantile computation for all columns.
    """
    q = quantiles_wide(df, cols, [0.25, 0.75], names=["q1", "q3"], exact=exact,
                       accuracy=accuracy)
    iqr = F.col("q3") - F.col("q1")
    return q.select("column", "q1", "q3", iqr.alias("iqr"),
                    (F.col("q1") - F.lit(k) * iqr).alias("lower"),
                    (F.col("q3") + F.lit(k) * iqr).alias("upper"))


def _fences(df, cols, k, exact, accuracy) -> dict[str, tuple[float, float]]:
    rows = iqr_bounds(df, cols, k, exact=exact, accuracy=accuracy).collect()
    return {r["column"]: (r["lower"], r["upper"]) for r in rows}


def iqr_outliers(df: DataFrame, col: str, k: float = 1.5, *, exact: bool = True,
                 accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """Rows whose ``col`` lies outside the IQR fences (fences are one
    fitted row, applied as literals)."""
    lo, hi = _fences(df, [col], k, exact, accuracy).get(col, (None, None))
    if lo is None:
        return df.limit(0)
    return df.where((F.col(col) < F.lit(lo)) | (F.col(col) > F.lit(hi)))


def outlier_report(df: DataFrame, cols, k: float = 1.5, *, exact: bool = True,
                   accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """Per column the fences and the number of low / high outliers.

    Columns without outliers are listed with zero counts. Two data passes in
    total (quantiles, then one conditional-count aggregation for all columns).
    """
    fences = _fences(df, cols, k, exact, accuracy)
    aggs = []
    for c in cols:
        lo, hi = fences.get(c, (None, None))
        if lo is None:
            aggs += [F.lit(0).cast("bigint").alias(f"{c}__low"), F.lit(0).cast("bigint").alias(f"{c}__high")]
        else:
            aggs += [F.count_if(F.col(c) < F.lit(lo)).alias(f"{c}__low"),
                     F.count_if(F.col(c) > F.lit(hi)).alias(f"{c}__high")]
    counts = df.agg(*aggs)
    stack = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"),
                 F.lit(fences.get(c, (None, None))[0]).cast("double").alias("lower"),
                 F.lit(fences.get(c, (None, None))[1]).cast("double").alias("upper"),
                 F.col(f"{c}__low").alias("n_low"), F.col(f"{c}__high").alias("n_high"))
        for c in cols])).alias("s")
    return counts.select(stack).select(
        "s.column", "s.lower", "s.upper", "s.n_low", "s.n_high",
        (F.col("s.n_low") + F.col("s.n_high")).alias("n_outliers"))


def clean_recipe_a(df: DataFrame, *, date_col: str | None = None,
                   ordinal_col: str | None = None,
                   upper_limits: dict[str, float] | None = None,
                   sentinels: dict[str, float] | None = None) -> DataFrame:
    """Coerce the date, add its day ordinal, values above a limit -> NULL,
    sentinels -> NULL. Values above the limit other than the sentinel are
    removed too (policy A)."""
    out = df
    if date_col is not None:
        dtype = out.schema[date_col].dataType.simpleString()
        date = fx.parse_date(date_col) if dtype == "string" else F.col(date_col).cast("date")
        out = out.withColumn(date_col, date)
        if ordinal_col:
            out = out.withColumn(ordinal_col, fx.date_ordinal(date_col))
    if upper_limits:
        out = threshold_to_null(out, upper_limits)
    if sentinels:
        out = sentinel_to_null(out, sentinels)
    return out


def clean_recipe_b(df: DataFrame, *, rules: dict[str, tuple[float, float, float]]) -> DataFrame:
    """Per column ``(sentinel, lo, hi)``: sentinel -> NULL, then clip to
    [lo, hi] (policy B: other large values are kept at the bound)."""
    return df.withColumns({
        c: fx.clip(fx.sentinel_to_null(c, s), lo, hi) for c, (s, lo, hi) in rules.items()})
