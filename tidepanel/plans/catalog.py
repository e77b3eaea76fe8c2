"""Registered queries: one Spark plan per operator of the inventory, bound to
the driver tables, plus an independent DuckDB SQL oracle where the result is
SQL-expressible.

Floating outputs are rounded (``ROUND_DIGITS``) on both sides: summation order
differs between engines in the last bits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}
ROUND_DIGITS = 6


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


SIG_DIGITS = 11
BIG = 1e6


def round_col(c, digits: int = ROUND_DIGITS):
    """``digits`` decimals below 1e6 in magnitude, ``SIG_DIGITS`` significant
    digits above (large sums differ between engines in the last bits)."""
    e = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(c))))
    big = F.round(c / e, SIG_DIGITS - 1) * e
    return F.when(F.abs(c) >= F.lit(BIG), big).otherwise(F.round(c, digits))


def rounded(df: DataFrame, digits: int = ROUND_DIGITS) -> DataFrame:
    """Round every double column (report-level presentation)."""
    return df.select(*[
        round_col(F.col(f.name), digits).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields])


def r(expr: str, digits: int = ROUND_DIGITS) -> str:
    x = f"({expr})"
    e = f"pow(10.0, floor(log10(abs({x}))))"
    return (f"(CASE WHEN abs({x}) >= {BIG} THEN round({x} / {e}, {SIG_DIGITS - 1}) * {e} "
            f"ELSE round({x}, {digits}) END)")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: v[1] for k, v in REGISTRY.items() if v[1]}


def _load_all():
    # importing the modules registers their queries
    from tidepanel.plans import (  # noqa: F401
        q_clean, q_derive, q_encode, q_impute, q_metrics, q_models, q_profile, q_reshape,
        q_split, q_tables, q_workflows)
