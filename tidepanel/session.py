"""Session construction and cluster-facing helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every tidepanel job relies on: AQE for runtime re-planning and skew
# splitting, UTC so that timestamp_ntz <-> date casts agree with other engines,
# no web UI, and cleanup of checkpoint files that are no longer referenced.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    # no broadcast chosen from planner size estimates: a side is broadcast
    # after a count proves its bound (bounded_broadcast), when it is bounded
    # by construction (explicit hint), or by AQE from measured shuffle sizes
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    # checkpointed intermediates (cut_lineage) are deleted from the shared
    # folder once nothing refers to them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app: str = "tidepanel",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the reliable checkpoint folder of the cluster.

    The folder is read from ``spark.checkpoint.dir``. Only when the session has
    none (local tests) is ``fallback`` -- or a fresh folder under the system
    temp dir -- used.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if sc.master.startswith("local"):
            conf_dir = fallback or tempfile.mkdtemp(prefix="tidepanel-ckpt-")
        else:
            raise RuntimeError(
                "spark.checkpoint.dir is not set; set it to a shared folder")
    sc.setCheckpointDir(conf_dir)
    return conf_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the reliable checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def bounded_broadcast(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast ``df`` only when it is proven to hold at most ``max_rows`` rows.

    The proof is a ``limit(max_rows + 1).count()`` job, which stops reading
    after ``max_rows + 1`` rows. Above the bound the frame is returned as is and
    the planner (AQE) chooses a shuffle join.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def default_parallelism(spark: SparkSession) -> int:
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # pragma: no cover - connect sessions
        return int(os.environ.get("BENCH_CPUS", "8"))


def right_sized(df: DataFrame, rows_per_partition: int = 200_000,
                min_partitions: int = 1) -> tuple[DataFrame, int]:
    """Persist ``df`` with about ``rows_per_partition`` rows per partition.

    For iterative fits (many small jobs over the same data) the task count per
    job should follow the data size: thousands of near-empty tasks per
    iteration cost more than the work. The input is computed once at its own
    parallelism and cached; the cached rows are then coalesced (no shuffle,
    and the upstream plan is not narrowed) or, when ``min_partitions`` asks
    for more parallelism for CPU-heavy per-row work, round-robin
    repartitioned. Returns the persisted frame and its row count.
    """
    import math
    full = df.persist()
    n = full.count()  # computed once, at the input's own parallelism
    target = max(int(min_partitions), math.ceil(n / rows_per_partition), 1)
    current = full.rdd.getNumPartitions()
    if target < current:
        out = full.coalesce(target)  # reads the cache: the upstream plan keeps its parallelism
    elif target > current and min_partitions > 1:
        out = full.repartition(target)
    else:
        return full, n
    out = out.persist()
    out.count()
    full.unpersist()
    return out, n
