"""Panel description and column-role helpers."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)
CATEGORICAL_TYPES = (T.StringType, T.BooleanType)


@dataclass(frozen=True)
class PanelSpec:
    """Entity key, time column and tie-break keys of a panel table.

    ``chunk_width`` (in time units: days for dates, seconds for timestamps,
    raw units for numbers) sets the size of the time slices that entity-ordered
    operators work on; ``None`` derives it from the time range.
    """

    entity: tuple[str, ...]
    time: str
    tiebreak: tuple[str, ...] = field(default=())
    chunk_width: float | None = None

    def __post_init__(self):
        if isinstance(self.entity, str):
            object.__setattr__(self, "entity", (self.entity,))
        if isinstance(self.tiebreak, str):
            object.__setattr__(self, "tiebreak", (self.tiebreak,))

    @property
    def order(self) -> tuple[str, ...]:
        return (self.time, *self.tiebreak)

    @property
    def keys(self) -> tuple[str, ...]:
        return (*self.entity, *self.order)


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """Numeric columns in schema order."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in ex]


def categorical_columns(df: DataFrame, exclude=()) -> list[str]:
    """String / boolean columns in schema order."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, CATEGORICAL_TYPES) and f.name not in ex]


def require_columns(df: DataFrame, cols) -> None:
    """Raise listing every missing column."""
    missing = sorted(set(cols) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def drop_if_present(df: DataFrame, cols) -> DataFrame:
    """Drop the named columns, ignoring absent ones."""
    return df.drop(*[c for c in cols if c in df.columns])


def select_columns(df: DataFrame, cols) -> DataFrame:
    """Keep a named list in the given order."""
    return df.select(*cols)


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    """Columns whose name starts with ``prefix`` (F8)."""
    return [c for c in df.columns if c.startswith(prefix)]


def drop_prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.drop(*columns_with_prefix(df, prefix))


def feature_sets(all_features, variants: dict[str, list[str]]) -> dict[str, list[str]]:
    """Named feature lists built from drop-lists."""
    return {name: [c for c in all_features if c not in set(drops)]
            for name, drops in variants.items()}
