"""Incremental (Structured Streaming) forms of two batch operators.

The reference is batch-only; these keep the same semantics when panel rows
arrive over time:

* :func:`clean_stream` applies the row-level cleaning rules (sentinel -> NULL,
  threshold -> NULL, clipping, right-closed labels) -- stateless expressions,
  identical to the batch operators;
* :func:`ffill_stream` forward-fills per entity with the last known value
  kept in streaming state, so a value missing at the start of a micro-batch
  takes the last known value of an earlier batch (I1 across batches). Rows
  are assumed to arrive in time order per entity (late rows are filled from
  the state as of their arrival); the state holds one value per entity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidepanel.functions import columns as fx
from tidepanel.spec import PanelSpec


def clean_stream(df: DataFrame, *, sentinels: dict | None = None, upper_limits: dict | None = None,
                 clip: dict | None = None) -> DataFrame:
    out = df
    for c, v in (sentinels or {}).items():
        out = out.withColumn(c, fx.sentinel_to_null(c, v))
    for c, v in (upper_limits or {}).items():
        out = out.withColumn(c, fx.threshold_to_null(c, v))
    for c, (lo, hi) in (clip or {}).items():
        out = out.withColumn(c, fx.clip(c, lo, hi))
    return out


def ffill_stream(df: DataFrame, spec: PanelSpec, cols) -> DataFrame:
    """Streaming forward fill of ``cols`` per entity (state: last known values)."""
    import pandas as pd
    cols = list(cols)
    out_schema = df.schema
    state_schema = T.StructType([T.StructField(c, T.DoubleType()) for c in cols])
    order = list(spec.order)

    def step(key, pdfs, state):
        last = dict(zip(cols, state.get)) if state.exists else {c: None for c in cols}
        frames = []
        for pdf in pdfs:
            frames.append(pdf)
        if not frames:
            return
        pdf = pd.concat(frames).sort_values(order, kind="mergesort")
        for c in cols:
            s = pdf[c].astype("float64")
            if last[c] is not None:
                s = pd.concat([pd.Series([last[c]]), s], ignore_index=True).ffill().iloc[1:]
                s.index = pdf.index
            else:
                s = s.ffill()
            pdf[c] = s
            nn = s.dropna()
            if len(nn):
                last[c] = float(nn.iloc[-1])
        state.update(tuple(last[c] for c in cols))
        yield pdf

    return df.groupBy(*spec.entity).applyInPandasWithState(
        step, out_schema, state_schema, "append", "NoTimeout")


def to_memory(df: DataFrame, name: str, checkpoint: str):
    """Run a streaming frame to completion into an in-memory table (tests and
    local smoke runs)."""
    q = df.writeStream.format("memory").queryName(name).outputMode("append") \
        .option("checkpointLocation", checkpoint).start()
    q.processAllAvailable()
    q.stop()
    return q


