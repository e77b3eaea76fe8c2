"""Linear models from sufficient statistics.

One pass for the column means and one of Arrow batches multiplied in numpy give,
per group (fold), the count, means and co-moments of ``[x_1 .. x_d, y]`` over
complete rows, at any width (``gram_stats`` gives the raw Gram matrix of
``[1, x, y]``, M9). Everything else -- OLS (minimum-norm on the
centred system, like a least-squares solver on rank-deficient designs), ridge
with an unpenalised intercept, k-fold cross-validation (train = total -
held-out fold), SSE of a held-out fold -- is solved on the driver from
(d+1)^2 numbers per fold. Predictions are literal linear expressions,
evaluated JVM-side.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _complete(df: DataFrame, cols) -> DataFrame:
    cond = None
    for c in cols:
        k = F.col(c).isNotNull()
        cond = k if cond is None else cond & k
    return df.where(cond) if cond is not None else df


def gram_stats(df: DataFrame, features, y: str, by: str | None = None,
               shift: dict | None = None, products=()) -> DataFrame:
    """M9: long table ``(group, i, j, value)`` (i <= j) of sum z_i z_j with
    z = [1, x - shift, y - shift_y]; rows with a missing value are skipped.
    ``products``: pairs of feature positions whose products are columns of z too,
    between x and y; they are made inside the batches.

    Every task multiplies its Arrow batches in numpy and emits one triangle per
    group; the triangles are summed by (group, i, j).
    """
    shift = shift or {}
    cols = list(features) + [y]
    data = _complete(df, cols)
    m = len(cols) + len(products) + 1
    grp = F.col(by).cast("int") if by else F.lit(0)
    names = [f"c{k}" for k in range(len(cols))]
    src = data.select(grp.alias("group"), *[
        (F.col(c).cast("double") - F.lit(float(shift.get(c) or 0.0))).alias(k)
        for c, k in zip(cols, names)]).where(F.col("group").isNotNull())
    upper = np.triu_indices(m)

    def partial(batches):
        acc = {}
        for batch in batches:
            flat = [batch.column(k).to_numpy(zero_copy_only=False) for k in names]
            rows = np.column_stack([np.ones(batch.num_rows), *flat[:-1],
                                    *(flat[i] * flat[j] for i, j in products), flat[-1]])
            groups = batch.column("group").to_numpy()
            for g in np.unique(groups):
                part = rows[groups == g]
                acc[g] = acc.get(g, 0) + part.T @ part
        for g, mat in acc.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(upper[0]), g, dtype=np.int32)),
                 *(pa.array(x.astype(np.int32)) for x in upper), pa.array(mat[upper])],
                names=["group", "i", "j", "value"])

    return src.mapInArrow(partial, "group int, i int, j int, value double").groupBy(
        "group", "i", "j").agg(F.sum("value").alias("value"))


@dataclass
class Moments:
    """Count, means and co-moments (sum of centred products) of z = [x, y]."""
    n: float
    mu: np.ndarray
    C: np.ndarray

    def minus(self, part: "Moments") -> "Moments":
        """Statistics of the rows not in ``part`` (parallel-merge formula, inverted)."""
        n_r = self.n - part.n
        if n_r <= 0:
            return Moments(0.0, np.zeros_like(self.mu), np.zeros_like(self.C))
        mu_r = (self.n * self.mu - part.n * part.mu) / n_r
        dlt = part.mu - mu_r
        C_r = self.C - part.C - (part.n * n_r / self.n) * np.outer(dlt, dlt)
        return Moments(n_r, mu_r, C_r)


def merge(a: Moments, b: Moments) -> Moments:
    n = a.n + b.n
    if n == 0:
        return a
    dlt = b.mu - a.mu
    return Moments(n, a.mu + dlt * (b.n / n), a.C + b.C + np.outer(dlt, dlt) * (a.n * b.n / n))


def moment_stats(df: DataFrame, features, y: str, by: str | None = None, products=()) -> dict:
    """Per group count, means and co-moments of [x, y], in two passes: the column
    means, then the Gram statistics about them (``gram_stats``), which keeps the
    products small and their sums exact enough. Bounded collect: groups x (d+1)^2
    numbers, d being the number of features.

    With ``products`` (pairs of feature positions) the moments are those of
    [x, products, y]. The features are then taken as they are, so the caller gives
    them a scale near 1 and a centre near 0."""
    cols = list(features) + [y]
    centred = [y] if products else cols
    means = _complete(df, cols).agg(*[
        F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(centred)]).first()
    shift = {c: means[f"m{i}"] or 0.0 for i, c in enumerate(centred)}
    m = len(cols) + len(products)
    grams: dict[int, np.ndarray] = {}
    for r in gram_stats(df, features, y, by, shift, products).collect():
        G = grams.setdefault(r["group"], np.zeros((m + 1, m + 1)))
        G[r["i"], r["j"]] = G[r["j"], r["i"]] = r["value"]
    centre = np.array([*(shift.get(c, 0.0) for c in features), *[0.0] * len(products), shift[y]])
    out = {}
    for g, G in grams.items():
        n, off = G[0, 0], G[0, 1:] / G[0, 0]
        out[g] = Moments(float(n), centre + off, G[1:, 1:] - n * np.outer(off, off))
    return out


INDEPENDENT = 1e-10  # least eigenvalue of independent columns' correlations, of the largest


def solve_moments(M: Moments, alpha: float = 0.0) -> tuple[float, np.ndarray]:
    """(intercept, beta); alpha = 0 -> least squares, of minimum norm where the columns
    are dependent. Independent ones are solved at unit spread: columns of very different
    sizes (x and x^2, say) cost digits otherwise."""
    d = len(M.mu) - 1
    if M.n <= 0:
        return float("nan"), np.full(d, np.nan)
    sxx, sxy = M.C[:d, :d], M.C[:d, d]
    if alpha:
        beta = np.linalg.solve(sxx + alpha * np.eye(d), sxy)
    else:
        spread = np.sqrt(np.maximum(np.diag(sxx), 0.0))
        beta = None
        if d and (spread > 0).all():
            unit = sxx / np.outer(spread, spread)
            sizes = np.linalg.eigvalsh(unit)
            if sizes[0] > INDEPENDENT * sizes[-1]:
                beta = np.linalg.solve(unit, sxy / spread) / spread
        if beta is None:
            beta = np.linalg.pinv(sxx, rcond=1e-12, hermitian=True) @ sxy
    return float(M.mu[d] - M.mu[:d] @ beta), beta


def sse_moments(M: Moments, intercept: float, beta: np.ndarray) -> float:
    """Sum of squared residuals of a fixed model over the rows summarised by M."""
    w = np.concatenate([-beta, [1.0]])
    rbar = float(M.mu @ w) - intercept
    return float(w @ M.C @ w) + M.n * rbar * rbar


@dataclass
class LinearModel:
    features: list[str]
    intercept: float
    coef: np.ndarray
    shift: dict

    def prediction(self):
        e = F.lit(float(self.intercept))
        for c, b in zip(self.features, self.coef):
            e = e + F.lit(float(b)) * (F.col(c).cast("double") - F.lit(float(self.shift.get(c, 0.0))))
        return e

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return df.withColumn(out, self.prediction())

    def coefficients(self, spark, top: int | None = None) -> DataFrame:
        """``(feature, coefficient, abs_coefficient)`` sorted by |coef|."""
        rows = [(f, float(b), abs(float(b))) for f, b in zip(self.features, self.coef)]
        df = spark.createDataFrame(rows, "feature string, coefficient double, abs_coefficient double")
        df = df.orderBy(F.desc("abs_coefficient"), "feature")
        return df.limit(top) if top else df

    def intercept_in_raw_units(self) -> float:
        return float(self.intercept - sum(b * self.shift.get(c, 0.0) for c, b in zip(self.features, self.coef)))


def fit_linear(df: DataFrame, features, y: str, *, alpha: float = 0.0) -> LinearModel:
    """M7 (alpha = 0) / M6 (ridge, intercept not penalised): one aggregation."""
    features = list(features)
    M = moment_stats(df, features, y).get(0)
    if M is None:
        raise ValueError("no complete rows to fit")
    b0, beta = solve_moments(M, alpha)
    return LinearModel(features, b0, beta, {})


def predictions_table(model: LinearModel, df: DataFrame, y: str, keys=()) -> DataFrame:
    """``(keys, actual, predicted, residual)``."""
    p = model.prediction()
    return df.select(*keys, F.col(y).cast("double").alias("actual"), p.alias("predicted")).withColumn(
        "residual", F.col("actual") - F.col("predicted"))


def cross_validate(df: DataFrame, features, y: str, fold: str, k: int, *, alpha: float = 0.0,
                   with_mae: bool = True) -> DataFrame:
    """X6 for linear models: one moment pass by fold; each training set is
    total - fold (inverted parallel merge), solved on the driver; held-out
    SSE from the fold's own moments; MAE (not a moment quantity) in one
    scoring pass with per-fold literal coefficients.

    ``(fold, n, mse, rmse, mae, r2)``.
    """
    from tidepanel.session import right_sized
    features = list(features)
    data, _ = right_sized(_complete(df, features + [y]).select(*features, y, fold))
    try:
        parts = moment_stats(data, features, y, by=fold)
        total = None
        for M in parts.values():
            total = M if total is None else merge(total, M)
        models, rows = {}, []
        d = len(features)
        for f in range(k):
            Mf = parts.get(f)
            if Mf is None:
                continue
            b0, beta = solve_moments(total.minus(Mf), alpha)
            models[f] = (b0, beta)
            sse = sse_moments(Mf, b0, beta)
            sst = Mf.C[d, d]
            rows.append([int(f), int(round(Mf.n)), float(sse / Mf.n), float(np.sqrt(max(sse, 0.0) / Mf.n)),
                         float(1.0 - sse / sst) if sst > 0 else None])
        mae = {}
        if with_mae and models:
            pred = None
            for f, (b0, beta) in models.items():
                e = F.lit(float(b0))
                for c, b in zip(features, beta):
                    e = e + F.lit(float(b)) * F.col(c).cast("double")
                pred = F.when(F.col(fold) == F.lit(f), e) if pred is None else pred.when(F.col(fold) == F.lit(f), e)
            err = F.abs(F.col(y).cast("double") - pred)
            mae = {r["fold"]: r["mae"] for r in data.groupBy(F.col(fold).cast("int").alias("fold"))
                   .agg(F.avg(err).alias("mae")).collect()}  # k rows
    finally:
        data.unpersist()
    out = [(f, n, mse, rmse, mae.get(f), r2) for f, n, mse, rmse, r2 in rows]
    return df.sparkSession.createDataFrame(out, "fold int, n bigint, mse double, rmse double, mae double, r2 double")
