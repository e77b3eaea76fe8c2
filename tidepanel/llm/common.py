"""Helpers shared by the operators: scratch tables, null-safe text, salting."""

from __future__ import annotations

import functools
import math
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.session import ensure_checkpoint_dir


MOST_HOT_KEYS = 50_000  # keys a salted join lists and broadcasts
BATCH_ROWS = 1_000  # rows are whole documents: 10,000 of them are too much for one Arrow batch


def let_workers_import(spark: SparkSession) -> None:
    """Python workers find this package where the driver found it (a cluster has it
    installed or sent along; this serves sessions started in another folder), and
    get at most BATCH_ROWS rows in a batch."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows, "10000")) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    import tidepanel
    here = os.path.dirname(os.path.dirname(os.path.abspath(tidepanel.__file__)))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if here not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, here])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    let_workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder of the session."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/tidepanel-llm/{uuid.uuid4().hex}-{name}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back: lineage is cut,
    nothing is computed twice, and a lost executor loses no part of it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def forget(*tables: DataFrame | None) -> None:
    """Delete tables of `materialize` that nothing reads any more."""
    for table in tables:
        path = getattr(table, "_scratch_path", None)
        if path:
            sc = table.sparkSession.sparkContext
            where = sc._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores until no column of `df` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def any_of(conditions: list[Column]) -> Column:
    return functools.reduce(lambda a, b: a | b, conditions)


def salted_join(rows: DataFrame, facts: DataFrame, key: str, rows_id: str, per_salt: int,
                size_col: str, how: str = "inner") -> DataFrame:
    """Join of `rows` with one-row-per-key `facts` when a key may hold a
    large share of `rows`.

    `facts.size_col` is the number of rows of the key. A key of n rows is dealt
    over ceil(n / per_salt) salts: its fact is repeated that often (at most
    keys + rows / per_salt copies in all), and each row picks one by hash. The
    salt count reaches the rows through a list of the hot keys only, of which there
    are at most rows / per_salt; `per_salt` grows until they are at most MOST_HOT_KEYS.
    """
    def hot_keys():
        return (facts.where(F.col(size_col) > per_salt)
                .select(key, F.ceil(F.col(size_col) / per_salt).cast("int").alias("_salts")))

    # with more rows a salt gets more of them, so that the list stays bounded
    while hot_keys().limit(MOST_HOT_KEYS + 1).count() > MOST_HOT_KEYS:
        per_salt *= 4
    hot = hot_keys()
    pick = F.pmod(F.xxhash64(F.col(rows_id)), F.coalesce(F.col("_salts"), F.lit(1)).cast("long"))
    left = (rows.join(F.broadcast(hot), key, "left")
            .withColumn("_salt", pick.cast("int")).drop("_salts"))
    right = facts.withColumn("_salt", F.explode(F.sequence(
        F.lit(0), F.greatest(F.lit(1), F.ceil(F.col(size_col) / per_salt)).cast("int") - 1)))
    return left.join(right, [key, "_salt"], how).drop("_salt")


def parts_for(total_bytes: int | None, target: int) -> int:
    return max(1, math.ceil((total_bytes or 0) / target))
