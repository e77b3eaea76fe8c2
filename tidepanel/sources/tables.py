"""Sources (S1, S2): CSV and Parquet panels with NaN -> NULL at the boundary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepanel.functions.columns import nan_to_null

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def normalise_missing(df: DataFrame) -> DataFrame:
    """NaN -> NULL in every float/double column (done once, at the source)."""
    fl = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: nan_to_null(c) for c in fl}) if fl else df


def read_panel_parquet(spark: SparkSession, path: str, columns=None) -> DataFrame:
    """Parquet scan (column pruning / filter pushdown by Catalyst)."""
    df = spark.read.parquet(path)
    if columns:
        df = df.select(*columns)
    return normalise_missing(df)


def read_panel_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                   *, date_col: str | None = None, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """UTF-8 CSV with a header. With a schema nothing is inferred (the
    production setting); without one the types are inferred (one extra pass).
    Unparsable cells become NULL (PERMISSIVE); ``date_col`` is coerced with
    ``try_to_date``."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE") \
        .option("encoding", "UTF-8")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(path)
    if date_col is not None and isinstance(df.schema[date_col].dataType, T.StringType):
        df = df.withColumn(date_col, F.try_to_date(F.col(date_col), date_format))
    return normalise_missing(df)


TASK_BYTES = 1_000_000  # estimated bytes of a scan that are worth a task of their own


def spread(df: DataFrame) -> DataFrame:
    """Deal out a scan of fewer partitions than the cores could share: a file of one row
    group is read by one task, however many splits it has. Small tables stay as they
    are, and so do large ones, which have more splits than there are cores."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    target = min(df.sparkSession.sparkContext.defaultParallelism, size // TASK_BYTES)
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(read_panel_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet"))
