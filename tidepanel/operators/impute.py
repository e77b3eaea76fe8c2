"""Imputation.

Time-series fills run on the chunked entity windows of
:mod:`tidepanel.operators.windows`; fitted fills learn one row of statistics
from ``fit_df`` (the training rows) and apply it as literals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.operators.quantiles import DEFAULT_ACCURACY, quantile_values
from tidepanel.operators.windows import entity_window_transform
from tidepanel.session import cut_lineage
from tidepanel.spec import PanelSpec, require_columns


def _replace(out: DataFrame, original_cols, mapping: dict[str, str]) -> DataFrame:
    return out.select(*[F.col(mapping[c]).alias(c) if c in mapping else F.col(c)
                        for c in original_cols])


def _keep_cols(df):
    return list(df.columns)


def ffill(df: DataFrame, spec: PanelSpec, cols) -> DataFrame:
    """Last known value of the entity so far (NULL before the first)."""
    out = entity_window_transform(df, spec, ffill=cols)
    return _replace(out, _keep_cols(df), {c: f"{c}__ffill" for c in cols})


def bfill(df: DataFrame, spec: PanelSpec, cols) -> DataFrame:
    """Next known value of the entity (NULL after the last)."""
    out = entity_window_transform(df, spec, bfill=cols)
    return _replace(out, _keep_cols(df), {c: f"{c}__bfill" for c in cols})


def ffill_bfill(df: DataFrame, spec: PanelSpec, cols) -> DataFrame:
    """Forward fill, then backward fill what is still missing (one pass)."""
    out = entity_window_transform(df, spec, ffill=cols, bfill=cols)
    out = out.withColumns({f"{c}__fb": F.coalesce(F.col(f"{c}__ffill"), F.col(f"{c}__bfill"))
                           for c in cols})
    return _replace(out, _keep_cols(df), {c: f"{c}__fb" for c in cols})


def interpolate_linear(df: DataFrame, spec: PanelSpec, cols) -> DataFrame:
    """I4: linear interpolation by row position inside the entity; values
    before the first / after the last known value take that value. Result
    columns are double."""
    out = entity_window_transform(df, spec, interpolate=cols)
    return _replace(out, _keep_cols(df), {c: f"{c}__interp" for c in cols})


def time_series_fill(df: DataFrame, spec: PanelSpec, cols, *, exact: bool = True,
                     accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """Interpolate per entity, then ffill/bfill, then the global median of
    the already filled column.

    After interpolation with both ends filled, ffill/bfill can only change
    entities without any known value, which stay NULL; so the chain is
    ``coalesce(interpolated, median(interpolated))``. The median is one fitted
    value per column.
    """
    require_columns(df, [*spec.keys, *cols])
    # the interpolated table is written once to the checkpoint folder: the two
    # median passes and the output read it instead of re-running the windows
    filled = cut_lineage(interpolate_linear(df, spec, cols))
    med = quantile_values(filled, cols, [0.5], exact=exact, accuracy=accuracy)
    return filled.withColumns({
        c: F.coalesce(F.col(c), F.lit(med[(c, 0.5)]).cast("double")) for c in cols})


# ---- fitted imputers ------------------------------------------------------

def fit_median(fit_df: DataFrame, cols, *, exact=True, accuracy=DEFAULT_ACCURACY) -> dict:
    vals = quantile_values(fit_df, cols, [0.5], exact=exact, accuracy=accuracy)
    return {c: vals[(c, 0.5)] for c in cols}


def fit_mean(fit_df: DataFrame, cols) -> dict:
    row = fit_df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols]).first()
    return {c: row[c] for c in cols}


def fit_most_frequent(fit_df: DataFrame, cols) -> dict:
    """Most frequent non-missing value per column; ties -> smallest value.

    Per column one job: distinct-value counts (partial aggregation), then the
    smallest ``(-count, value)`` pair -- both combinable aggregations, so no
    column's values meet in one task.
    """
    out = {}
    for c in cols:
        counts = fit_df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
        row = counts.agg(F.min(F.struct((-F.col("n")).alias("neg_n"), F.col(c).alias("v")))
                         .alias("best")).first()
        out[c] = None if row is None or row["best"] is None else row["best"]["v"]
    return out


def apply_fill(df: DataFrame, values: dict) -> DataFrame:
    return df.withColumns({
        c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)) if v is not None else F.col(c)
        for c, v in values.items()})


def impute_median(df: DataFrame, cols, *, fit_df: DataFrame | None = None, exact=True,
                  accuracy=DEFAULT_ACCURACY) -> DataFrame:
    """Fill with the training median. The column becomes double (as a
    median of integers may be fractional)."""
    vals = fit_median(fit_df if fit_df is not None else df, cols, exact=exact, accuracy=accuracy)
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(vals[c]).cast("double"))
                           for c in cols})


def impute_mean(df: DataFrame, cols, *, fit_df: DataFrame | None = None) -> DataFrame:
    """Fill with the training mean (double)."""
    vals = fit_mean(fit_df if fit_df is not None else df, cols)
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(vals[c]).cast("double"))
                           for c in cols})


def impute_most_frequent(df: DataFrame, cols, *, fit_df: DataFrame | None = None) -> DataFrame:
    """I8: fill with the training mode (ties -> smallest)."""
    return apply_fill(df, fit_most_frequent(fit_df if fit_df is not None else df, cols))
