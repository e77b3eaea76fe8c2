"""Dates, next-step targets, binning, codes and rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepanel.functions import columns as fx
from tidepanel.operators.windows import entity_window_transform
from tidepanel.session import bounded_broadcast, cut_lineage
from tidepanel.spec import PanelSpec, require_columns

# The three-level rise label of the reference
# (right-closed intervals (-inf, 0], (0, 5], (5, inf)).
RISE_EDGES = (0.0, 5.0)
RISE_LABELS = ("No_Increase", "Slight_Increase", "Large_Increase")


def parse_dates(df: DataFrame, col: str, *, fmt: str = fx.DATE_FORMAT,
                strict: bool = False, out: str | None = None) -> DataFrame:
    """Text -> date; bad text -> NULL (or an error when ``strict``)."""
    return df.withColumn(out or col, fx.parse_date(col, fmt, strict))


def add_date_ordinal(df: DataFrame, col: str, out: str) -> DataFrame:
    """D2."""
    return df.withColumn(out, fx.date_ordinal(F.col(col).cast("date")))


def add_date_from_ordinal(df: DataFrame, col: str, out: str) -> DataFrame:
    """D3."""
    return df.withColumn(out, fx.date_from_ordinal(col))


def add_date_as_int(df: DataFrame, col: str, out: str) -> DataFrame:
    """D4."""
    return df.withColumn(out, fx.date_as_int(F.col(col).cast("date")))


def lead_value(df: DataFrame, spec: PanelSpec, cols, *, suffix: str = "_next") -> DataFrame:
    """Next row's value inside the entity (NULL on the last row)."""
    out = entity_window_transform(df, spec, lead=cols)
    return out.select(*df.columns, *[F.col(f"{c}__lead").alias(f"{c}{suffix}") for c in cols])


def next_step_change(df: DataFrame, spec: PanelSpec, col: str, *,
                     next_col: str | None = None, change_col: str | None = None,
                     pct_col: str | None = None, drop_last: bool = True) -> DataFrame:
    """Next row's value minus the current one; rows without a next value
    are dropped. "Next" is the next row of the entity; gaps are not checked.
    ``pct_col`` adds ``100 * change / current`` (NULL when current is 0)."""
    require_columns(df, [*spec.keys, col])
    next_col = next_col or f"{col}_next"
    change_col = change_col or f"{col}_change"
    out = lead_value(df, spec, [col], suffix="__n").withColumnRenamed(f"{col}__n", next_col)
    out = out.withColumn(change_col, F.col(next_col) - F.col(col))
    if pct_col:
        out = out.withColumn(pct_col, F.try_divide(F.col(change_col) * F.lit(100.0), F.col(col)))
    if drop_last:
        out = out.where(F.col(change_col).isNotNull())
    return out


def bin_labels(df: DataFrame, col: str, out: str, edges=RISE_EDGES, labels=RISE_LABELS) -> DataFrame:
    """Right-closed binning into labels."""
    return df.withColumn(out, fx.bin_right_closed(col, edges, labels))


def sort_panel(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Presentation order only; operators never rely on row order."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in spec.keys])


def sorted_levels(df: DataFrame, col: str, *, max_levels: int = 100_000) -> list:
    """Sorted distinct non-missing values of a categorical column.

    The level list is bounded: more than ``max_levels`` levels raise instead
    of flowing to the driver.
    """
    lv = df.where(F.col(col).isNotNull()).select(col).distinct()
    rows = lv.limit(max_levels + 1).collect()
    if len(rows) > max_levels:
        raise ValueError(f"{col} has more than {max_levels} levels")
    return sorted(r[0] for r in rows)


def level_codes(df: DataFrame, col: str, code: str = "_code") -> DataFrame:
    """``(col, code)``: the rank of every distinct level, from 0, at any number of levels.

    The levels are range-partitioned and written to the checkpoint folder; a rank is
    the place in the partition plus the sizes of the partitions before it.
    """
    levels = cut_lineage(
        df.where(F.col(col).isNotNull()).select(col).distinct().repartitionByRange(col)
        .withColumn("_part", F.spark_partition_id()))
    before = (levels.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # a row a partition
              .withColumn("_base", F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).drop("_n"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(col)) - 1
    return levels.withColumn("_place", place).join(before, "_part").select(
        col, (F.col("_base") + F.col("_place")).cast("int").alias(code))


def category_code(df: DataFrame, col: str, out: str, *, levels=None) -> DataFrame:
    """Sorted level -> dense code 0..n-1 (NULL stays NULL), by a join with the
    ranked levels: the data's own, or those of a given list (others get NULL)."""
    if levels is not None:
        codes = df.sparkSession.createDataFrame(
            [(v, i) for i, v in enumerate(levels)],
            T.StructType([T.StructField(col, df.schema[col].dataType), T.StructField("_code", T.IntegerType())]))
    else:
        codes = level_codes(df, col)
    codes = codes.withColumnRenamed(col, "_level")
    joined = df.join(bounded_broadcast(codes), F.col(col) == F.col("_level"), "left")
    kept = [F.col(c) for c in df.columns if c != out]
    return joined.select(*kept, F.col("_code").alias(out))


def relabel_dense(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Relabel arbitrary cluster labels to 0..n-1 in sorted order."""
    return category_code(df, col, out or col)


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """First ``k`` rows by an explicit, tie-broken order (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(k)


def argbest(df: DataFrame, order: list[Column]) -> DataFrame:
    """The single best row (ties resolved by the order's later keys)."""
    return df.orderBy(*order).limit(1)
