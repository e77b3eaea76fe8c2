"""Reshaping."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.functions.columns import hash_unit


def unstack(df: DataFrame, ids, values, var: str = "variable", val: str = "value") -> DataFrame:
    """Wide -> long (one row per id and value column)."""
    return df.select(*ids, *[F.col(c).cast("double").alias(c) for c in values]).unpivot(
        list(ids), list(values), var, val)


def transpose(df: DataFrame, id_col: str, *, name_col: str = "metric", max_ids: int = 1_000) -> DataFrame:
    """R2: swap rows and columns of a small report: the values of ``id_col``
    become columns, the other columns become rows. The id list is bounded."""
    values = [c for c in df.columns if c != id_col]
    ids = [r[0] for r in df.select(id_col).distinct().limit(max_ids + 1).collect()]
    if len(ids) > max_ids:
        raise ValueError("report too large to transpose")
    long = df.select(F.col(id_col).cast("string").alias(id_col),
                     *[F.col(c).cast("double").alias(c) for c in values]).unpivot(
        [id_col], values, name_col, "_v")
    return long.groupBy(name_col).pivot(id_col, sorted(str(i) for i in ids)).agg(F.first("_v"))


def concat_columns(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Side-by-side columns of two frames, aligned by key (Spark has no
    row position: the key is what a positional concat relies on)."""
    return left.join(right, list(keys), "inner")


def keep_rows_of(df: DataFrame, other: DataFrame, keys) -> DataFrame:
    """Rows whose key occurs in ``other`` (semi join; no duplication)."""
    return df.join(other.select(*keys), list(keys), "left_semi")


def map_values(df: DataFrame, col: str, mapping: dict, out: str | None = None) -> DataFrame:
    """Dictionary lookup as a literal map (unmapped -> NULL)."""
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    return df.withColumn(out or col, F.element_at(m, F.col(col)))


def scatter_table(df: DataFrame, cols, *, key_cols=None, fraction: float | None = None) -> DataFrame:
    """Plot data: a projection, optionally a deterministic key-hash sample
    (sampling is the feature here: plots do not need every point)."""
    out = df.select(*cols) if key_cols is None else df.select(*dict.fromkeys([*key_cols, *cols]))
    if fraction is not None and key_cols:
        key = F.concat_ws(":", *[F.col(c).cast("string") for c in key_cols], F.lit("plot"))
        out = out.where(hash_unit(key) % 10_000 < int(round(fraction * 10_000)))
    return out
