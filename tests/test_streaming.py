import os
import shutil

from pyspark.sql import functions as F

from tidepanel.operators import impute
from tidepanel.plans import bindings as B
from tidepanel.streaming.incremental import clean_stream, ffill_stream, to_memory

SF = "/root/testdata/sf0.001"


def _dirty_events_dir(spark, tmp):
    """Two files = two micro-batches, split by time."""
    ev = B.dirty_events(spark, SF).select("event_id", "ts", "event_type", "value")
    cut = ev.agg(F.percentile_approx(F.col("ts").cast("timestamp").cast("double"), 0.5)).first()[0]
    early = ev.where(F.col("ts").cast("timestamp").cast("double") <= cut)
    late = ev.where(F.col("ts").cast("timestamp").cast("double") > cut)
    early.coalesce(1).write.parquet(os.path.join(tmp, "in", "b1"))
    late.coalesce(1).write.parquet(os.path.join(tmp, "in", "b2"))
    return ev


def test_stream_clean_and_ffill_match_batch(spark, tmpdir_path):
    ev = _dirty_events_dir(spark, tmpdir_path)
    files = sorted(p for p in os.listdir(os.path.join(tmpdir_path, "in")))
    src = os.path.join(tmpdir_path, "src")
    os.makedirs(src)
    stream_in = (spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1)
                 .parquet(src))
    cleaned = clean_stream(stream_in, sentinels={"value": 999.0})
    filled = ffill_stream(cleaned, B.EVENT_SPEC, ["value"])
    q = filled.writeStream.format("memory").queryName("ffill_out").outputMode("append") \
        .option("checkpointLocation", os.path.join(tmpdir_path, "ck")).start()
    for f in files:  # deliver the batches one after the other
        for part in os.listdir(os.path.join(tmpdir_path, "in", f)):
            if part.endswith(".parquet"):
                shutil.copy(os.path.join(tmpdir_path, "in", f, part), os.path.join(src, f"{f}-{part}"))
        q.processAllAvailable()
    q.stop()
    got = spark.table("ffill_out")
    batch = impute.ffill(clean_stream(ev, sentinels={"value": 999.0}), B.EVENT_SPEC, ["value"])
    cols = ["event_id", "value"]
    assert got.count() == ev.count()
    assert got.select(cols).exceptAll(batch.select(cols)).count() == 0


def test_to_memory_helper(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "s")
    spark.range(5).write.parquet(src)
    df = spark.readStream.schema("id long").parquet(src)
    to_memory(clean_stream(df.withColumn("x", F.col("id").cast("double")), upper_limits={"x": 2.0}),
              "mem_clean", os.path.join(tmpdir_path, "ck2"))
    assert sorted(r["x"] for r in spark.table("mem_clean").collect() if r["x"] is not None) == [0.0, 1.0, 2.0]
