"""Pairwise-complete moments of many columns in one pass.

Every Arrow batch becomes a value matrix V (centred per column, 0 where missing) and
a presence matrix P; three matrix products give, for every pair of columns at once,
the number of rows where both are present and the sums, squares and products over
those rows. Batches are merged inside a task, and tasks by Spark, with the usual
formula for combining centred moments, so columns with a large offset lose no
digits and a constant column has a spread of exactly 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


@dataclass
class PairMoments:
    """For columns a, b over the rows where both are present: number of rows n[a, b], mean
    m[a, b] of a, centred squares q[a, b] of a, centred products p[a, b]."""
    n: np.ndarray
    m: np.ndarray
    q: np.ndarray
    p: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray) -> "PairMoments":
        """x: rows x columns, NaN where missing."""
        there = ~np.isnan(x)
        first = np.array([c[t][0] if t.any() else 0.0 for c, t in zip(x.T, there.T)])
        v = np.where(there, x - first, 0.0)
        count = np.maximum(there.sum(0), 1)
        off = v.sum(0) / count
        v = np.where(there, v - off, 0.0)
        present = there.astype(np.float64)
        n = present.T @ present
        some = np.maximum(n, 1)
        s = v.T @ present
        q = (v * v).T @ present - s * s / some
        p = v.T @ v - s * s.T / some
        return cls(n, np.where(n > 0, (first + off)[:, None] + s / some, 0.0), np.maximum(q, 0), p)

    def merged(self, other: "PairMoments") -> "PairMoments":
        n = self.n + other.n
        some = np.maximum(n, 1)
        d = np.where((self.n > 0) & (other.n > 0), other.m - self.m, 0.0)
        mean = np.where(self.n > 0, self.m + d * (other.n / some), other.m)
        f = self.n * other.n / some
        return PairMoments(n, mean, self.q + other.q + d * d * f, self.p + other.p + d * d.T * f)


def pair_moments(df: DataFrame, cols) -> DataFrame:
    """(i, j, n, q_i, q_j, p) for columns i < j of `cols`: number of rows where both are
    present, centred squares of either and centred products over them."""
    upper = np.triu_indices(len(cols), 1)
    names = [f"c{k}" for k in range(len(cols))]

    def partial(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                x = np.column_stack([batch.column(k).to_numpy(zero_copy_only=False)
                                     for k in range(len(names))]).astype(np.float64)
                found = PairMoments.of(x)
                total = found if total is None else total.merged(found)
        if total is not None:
            fields = (upper[0], upper[1], total.n[upper], total.m[upper], total.m.T[upper],
                      total.q[upper], total.q.T[upper], total.p[upper])
            yield pa.RecordBatch.from_arrays([pa.array(f) for f in fields],
                                             names=["i", "j", "n", "m_i", "m_j", "q_i", "q_j", "p"])

    parts = df.select(*[F.col(c).cast("double").alias(k) for c, k in zip(cols, names)]).mapInArrow(
        partial, "i long, j long, n double, m_i double, m_j double, q_i double, q_j double, p double"
    ).where("n > 0")
    # means of the tasks about the least of them: equal means differ by exactly 0
    pair = Window.partitionBy("i", "j")
    for m in ("m_i", "m_j"):
        parts = parts.withColumn(m, F.col(m) - F.min(m).over(pair))
        parts = parts.withColumn(m, F.col(m) - F.sum(F.col("n") * F.col(m)).over(pair)
                                 / F.sum("n").over(pair))
    n, a, b = F.col("n"), F.col("m_i"), F.col("m_j")
    return parts.groupBy("i", "j").agg(
        F.sum("n").alias("n"), F.sum(F.col("q_i") + n * a * a).alias("q_i"),
        F.sum(F.col("q_j") + n * b * b).alias("q_j"), F.sum(F.col("p") + n * a * b).alias("p"))
