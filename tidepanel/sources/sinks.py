"""Sinks (S3-S6): result tables, metrics JSON and the output check.

Outputs of a run are written to a staging folder, audited there, and published with a
manifest (``publish_outputs``); ``audit_outputs`` checks a published run against it.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BOM = "\ufeff"
MANIFEST = "_manifest"
STAGING = "_staging"
MANIFEST_SCHEMA = "name string, format string, columns array<string>, n_rows long, checksum string"


def nested_as_json(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text, which CSV can hold."""
    return df.select(*[
        F.to_json(F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else F.col(f"`{f.name}`")
        for f in df.schema.fields])


def write_table(df: DataFrame, path: str, *, fmt: str = "csv", single_file: bool = False,
                partition_by=None, mode: str = "overwrite") -> str:
    """S3: write a result table. Small reports may go to one file
    (``single_file``); large tables stay partitioned (Parquet preferred)."""
    out = nested_as_json(df) if fmt == "csv" else df
    out = out.coalesce(1) if single_file else out
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":  # nested columns as JSON text
        w.option("header", True).option("encoding", "UTF-8").csv(path)
    else:
        w.format(fmt).save(path)
    return path


def write_table_csv_bom(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Single CSV file for spreadsheets, starting with a UTF-8 byte-order
    mark (carried by the first header name)."""
    first = df.columns[0]
    df.withColumnRenamed(first, BOM + first).coalesce(1).write.mode(mode) \
        .option("header", True).option("encoding", "UTF-8").csv(path)
    return path


def metrics_frame(spark: SparkSession, metrics: dict) -> DataFrame:
    """A nested metrics dict as a one-row DataFrame (structs and arrays)."""
    text = json.dumps(metrics, default=float)
    schema = spark.range(1).select(F.schema_of_json(F.lit(text))).first()[0]
    return spark.range(1).select(F.from_json(F.lit(text), schema).alias("m")).select("m.*")


def write_metrics_json(spark: SparkSession, metrics: dict, path: str, mode: str = "overwrite") -> str:
    """Metrics dict -> one JSON document."""
    metrics_frame(spark, metrics).coalesce(1).write.mode(mode).json(path)
    return path


def assert_outputs(spark: SparkSession, paths) -> None:
    """Raise listing every required output that does not exist."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    missing = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        if not hp.getFileSystem(conf).exists(hp):
            missing.append(p)
    if missing:
        raise FileNotFoundError(f"missing required outputs: {missing}")


# ---- write, audit, publish ----------------------------------------------------------

def _file_system(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _written(spark: SparkSession, path: str, fmt: str, columns) -> tuple[int, str, list[str]]:
    """(rows, checksum, columns) of a written table, from its files. The checksum is the sum
    of the rows' 64-bit hashes: it needs no order and is combined before any exchange."""
    if fmt == "csv":
        text = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        # a header that names other columns is an error, not a column of other values
        back = spark.read.schema(text).option("header", True).option("enforceSchema", False) \
            .option("mode", "FAILFAST").csv(path)
    else:
        back = spark.read.format(fmt).load(path)
    each = F.xxhash64(*[F.col(f"`{c}`") for c in back.columns]).cast("decimal(38,0)")
    row = back.agg(F.count(F.lit(1)).alias("n"), F.sum(each).cast("string").alias("sum")).first()
    return row["n"], row["sum"] or "0", back.columns


def publish_outputs(spark: SparkSession, tables: dict[str, DataFrame], out_dir: str, *,
                    fmt: str = "csv", row_level=()) -> str:
    """S3 + S6: write every table to a staging folder, read it back, and only when all of
    them hold the rows that were computed move them to ``out_dir/<name>`` and write the
    manifest (one JSON document per table: format, columns, rows, checksum).

    Rows are counted while they are written (an observation), so nothing is computed
    twice. Tables named in ``row_level`` stay partitioned, the others are one file. A
    table of an earlier run is replaced; the old manifest goes first, so a run that ends
    in between leaves none. A CSV value with a line break fails the audit: use Parquet.
    """
    facts = []
    for name, df in tables.items():
        seen = Observation()
        path = write_table(df.observe(seen, F.count(F.lit(1)).alias("n")), f"{out_dir}/{STAGING}/{name}",
                           fmt=fmt, single_file=name not in row_level)
        expected = seen.get["n"]
        n, checksum, columns = _written(spark, path, fmt, df.columns)
        if n != expected or list(columns) != list(df.columns):
            raise ValueError(f"{name}: {expected} rows of {df.columns} computed, {n} of {columns} written")
        facts.append((name, fmt, list(columns), n, checksum))
    fs, manifest = _file_system(spark, f"{out_dir}/{MANIFEST}")
    fs.delete(manifest, True)
    for name in tables:
        _, staged = _file_system(spark, f"{out_dir}/{STAGING}/{name}")
        _, final = _file_system(spark, f"{out_dir}/{name}")
        fs.delete(final, True)
        if not fs.rename(staged, final):
            raise OSError(f"{name} could not be moved to {out_dir}")
    fs.delete(_file_system(spark, f"{out_dir}/{STAGING}")[1], True)
    spark.createDataFrame(facts, MANIFEST_SCHEMA).coalesce(1).write.json(f"{out_dir}/{MANIFEST}")
    return f"{out_dir}/{MANIFEST}"


def audit_outputs(spark: SparkSession, out_dir: str) -> DataFrame:
    """The manifest of a published run; raises naming every table whose files are
    missing, cannot be read, or hold other columns, rows or values than were published."""
    assert_outputs(spark, [f"{out_dir}/{MANIFEST}"])
    manifest = spark.read.schema(MANIFEST_SCHEMA).json(f"{out_dir}/{MANIFEST}")
    damaged = []
    for fact in manifest.collect():  # a row per output table
        path = f"{out_dir}/{fact['name']}"
        fs, where = _file_system(spark, path)
        try:
            found = _written(spark, path, fact["format"], fact["columns"]) if fs.exists(where) else None
        except Exception as error:  # files that Spark cannot read are what the audit looks for
            found = str(error).splitlines()[0][:200]
        if found != (fact["n_rows"], fact["checksum"], fact["columns"]):
            damaged.append(f"{fact['name']}: {found or 'missing'}")
    if damaged:
        raise ValueError(f"outputs differ from the manifest: {damaged}")
    return manifest
