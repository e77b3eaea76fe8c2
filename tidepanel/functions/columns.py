"""Scalar column expressions shared by the operators.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so
that it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Day number of 1970-01-01 when 0001-01-01 is day 1 (proleptic
# Gregorian, the convention of Python's date.toordinal), and the date format
# of the source panel.
EPOCH_ORDINAL = 719163
DATE_FORMAT = "yyyy-MM-dd"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """NaN -> NULL, so that comparisons and averages skip missing values."""
    c = _c(c)
    return F.when(~F.isnan(c), c)


def sentinel_to_null(c, value: float) -> Column:
    """Exact sentinel -> NULL (C1). ``nullif`` keeps NULL as NULL."""
    return F.nullif(_c(c), F.lit(float(value)))


def threshold_to_null(c, upper: float) -> Column:
    """Values above ``upper`` -> NULL; missing stays missing."""
    c = _c(c)
    return F.when(c <= F.lit(float(upper)), c)


def clip(c, lo: float | None, hi: float | None) -> Column:
    """Winsorise to [lo, hi]; NULL stays NULL (least/greatest skip NULLs) (C4)."""
    c = _c(c)
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    return F.when(c.isNotNull(), out)


def bin_right_closed(c, edges, labels) -> Column:
    """Right-closed binning: (-inf, e0], (e0, e1], ..., (e_last, inf).

    ``labels`` has one more entry than ``edges``. NULL input gives NULL.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("labels must have len(edges) + 1 entries")
    c = _c(c)
    out = F.when(c.isNull(), F.lit(None).cast("string"))
    for e, lab in zip(edges, labels):
        out = out.when(c <= F.lit(float(e)), F.lit(lab))
    return out.otherwise(F.lit(labels[-1]))


def parse_date(c, fmt: str = DATE_FORMAT, strict: bool = False) -> Column:
    """String -> date. Coercing mode yields NULL for bad text."""
    c = _c(c)
    return F.to_date(c, fmt) if strict else F.try_to_date(c, fmt)


def date_ordinal(c) -> Column:
    """Day number with 0001-01-01 = 1."""
    return (F.datediff(_c(c), F.lit("1970-01-01").cast("date"))
            + F.lit(EPOCH_ORDINAL)).cast("bigint")


def date_from_ordinal(c) -> Column:
    """Inverse of :func:`date_ordinal` (D3)."""
    return F.date_add(F.lit("1970-01-01").cast("date"),
                      (_c(c) - F.lit(EPOCH_ORDINAL)).cast("int"))


def date_as_int(c) -> Column:
    """Date -> yyyymmdd integer."""
    return F.date_format(_c(c), "yyyyMMdd").cast("int")


def computed_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with ``columns``, each evaluated once a row. A filter on a projected column
    is pushed below the projection and repeats its expression, several times where a
    condition names it several times; it is not pushed below a generator."""
    made = F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])))
    return df.select("*", made)


def hash_unit(key) -> Column:
    """Deterministic 32-bit integer of a text key: first 8 hex digits of md5.

    Equal on other engines that have md5 (e.g. DuckDB:
    ``cast('0x' || substr(md5(k),1,8) as bigint)``). Stable under any
    repartitioning, unlike ``rand``.
    """
    return F.conv(F.substring(F.md5(_c(key).cast("string")), 1, 8), 16, 10).cast("bigint")


def hash_bucket(key, n: int) -> Column:
    return hash_unit(key) % F.lit(int(n))


def time_number(c, dtype: T.DataType) -> Column:
    """Numeric view of a time column: days for dates, seconds for timestamps."""
    c = _c(c)
    if isinstance(dtype, T.DateType):
        return F.datediff(c, F.lit("1970-01-01").cast("date")).cast("double")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return (F.unix_micros(c.cast("timestamp")) / F.lit(1_000_000.0))
    return c.cast("double")
