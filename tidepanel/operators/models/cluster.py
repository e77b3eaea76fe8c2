"""K-means, assignment, sweeps and PCA.

Fits run Lloyd iterations where one pass over the cached data advances every
(k, restart) model at once (numpy inside ``mapInArrow`` tasks over rows cached
as matrix blocks, one vector of partial sums a task); seeding is k-means|| over
all rows, likewise for all models at once. Only centres and sums move between
driver and executors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidepanel.operators.metrics import silhouette_sq_euclidean
from tidepanel.session import default_parallelism, right_sized


def to_vector(df: DataFrame, array_col: str, out: str = "features") -> DataFrame:
    from pyspark.ml.functions import array_to_vector
    return df.withColumn(out, array_to_vector(F.col(array_col).cast("array<double>")))


def _sqdist(x: Column, centre) -> Column:
    lit = F.array(*[F.lit(float(v)) for v in centre])
    return F.aggregate(F.zip_with(x, lit, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)


def assign(df: DataFrame, array_col: str, centres, out: str = "cluster",
           dist_col: str | None = "sq_dist") -> DataFrame:
    """Nearest centre (ties -> lowest index) and its squared distance.
    Centres are k literal arrays: one select, no join."""
    cands = [F.struct(_sqdist(F.col(array_col), c).alias("d"), F.lit(i).alias("c"))
             for i, c in enumerate(centres)]
    best = F.least(*cands) if len(cands) > 1 else cands[0]
    out_df = df.withColumn("_best", best).withColumn(out, F.col("_best.c"))
    if dist_col:
        out_df = out_df.withColumn(dist_col, F.col("_best.d"))
    return out_df.drop("_best")


def inertia(df: DataFrame, array_col: str, centres) -> float:
    """Sum of squared distances to the nearest centre."""
    return assign(df, array_col, centres).agg(F.sum("sq_dist")).first()[0]


def class_means(df: DataFrame, array_col: str, label: str) -> list[list[float]]:
    """Mean vector per label (k rows), ordered by label."""
    first = df.select(array_col).first()
    dim = len(first[0])
    rows = df.groupBy(label).agg(*[F.avg(F.col(array_col)[i]).alias(f"m{i}") for i in range(dim)]) \
        .orderBy(label).collect()
    return [[r[f"m{i}"] for i in range(dim)] for r in rows]


@dataclass
class KMeansResult:
    k: int
    centres: list[list[float]]
    cost: float
    seed: int


def _canonical(centres) -> list[list[float]]:
    """Label order fixed by sorting the centres lexicographically."""
    return [list(map(float, c)) for c in sorted((list(c) for c in centres))]


BLOCK_CELLS = 4_000_000  # distances of one block of rows to all models' centres


FEW_PARTS = 32  # partial results that are summed on the driver; more are summed by Spark


def _mapped(vec: DataFrame, array_col: str, fn, ddl: str) -> DataFrame:
    """`fn` (Arrow batches of the one column -> pandas frames) on every task."""
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches):
        for out in fn(batches):
            yield pa.RecordBatch.from_pandas(out, schema=schema, preserve_index=False)

    return vec.select(array_col).mapInArrow(run, ddl)


def _summed(parts: DataFrame, keys, scalars, dim: int, tasks: int) -> list:
    """Partial rows (keys, scalars, vector ``s``) of the tasks summed per key, the
    vector per dimension. Of a few tasks the partial rows come back, otherwise
    their sums: as many rows as keys, however many tasks ran."""
    if tasks > FEW_PARTS:
        sums = ", ".join(f"sum(s[{i}])" for i in range(dim))
        return parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in scalars],
                                        F.expr(f"array({sums})").alias("s")).collect()
    total: dict = {}
    for r in parts.toArrow().to_pylist():
        key = tuple(r[k] for k in keys)
        numbers = np.array([*(r[c] for c in scalars), *r["s"]])
        total[key] = total[key] + numbers if key in total else numbers
    return [dict(zip(keys, key)) | dict(zip(scalars, x)) | {"s": x[len(scalars):]}
            for key, x in total.items()]


def _blocks(batches, centres: int):
    """Arrow batches as float matrices, few enough rows at a time for ``centres``."""
    step = max(1, BLOCK_CELLS // max(1, centres))
    for batch in batches:
        column = batch.column(0)
        if len(column):
            X = column.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(
                len(column), -1)
            for at in range(0, len(X), step):
                yield X[at:at + step]


def _sq_distances(X: np.ndarray, C: np.ndarray) -> np.ndarray:
    middle = C.mean(0)  # a large offset of the columns would swallow the distances
    X, C = X - middle, C - middle
    return np.maximum((X * X).sum(1)[:, None] - 2.0 * (X @ C.T) + (C * C).sum(1)[None, :], 0.0)


BLOCK = ["n", "x"]  # columns of a packed block: its rows, and their values as float64
BLOCK_ROWS = 1024
CACHE_CELLS = 200_000  # distances made at a time, so that they stay in a core's cache


def _packed(vec: DataFrame, array_col: str) -> DataFrame:
    """The rows of the array column as persisted matrix blocks, dealt evenly to at
    least as many partitions, whole rounds of the cores: the passes of a fit send
    Python whole blocks, not values."""
    def pack(batches):
        for batch in batches:
            column = batch.column(0)
            if len(column):
                X = column.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(
                    len(column), -1)
                parts = [X[at:at + BLOCK_ROWS] for at in range(0, len(X), BLOCK_ROWS)]
                yield pa.RecordBatch.from_pydict({
                    "n": pa.array([len(x) for x in parts], pa.int32()),
                    "x": pa.array([x.tobytes() for x in parts], pa.binary())})

    cores = max(1, default_parallelism(vec.sparkSession))
    return vec.select(array_col).mapInArrow(pack, "n int, x binary").repartition(
        -(-vec.rdd.getNumPartitions() // cores) * cores or cores).persist()


def _matrices(batches):
    """Packed blocks as float matrices."""
    for batch in batches:
        for n, x in zip(batch.column(0).to_pylist(), batch.column(1)):
            yield np.frombuffer(x.as_buffer(), dtype="float64").reshape(n, -1)


def _added(blocks: DataFrame, fn, tasks: int) -> np.ndarray:
    """The float vectors that ``fn`` makes of the matrices of each task, added up; of
    many tasks Spark adds them first, so that few vectors reach the driver."""
    def run(batches):
        yield pa.RecordBatch.from_pydict({"s": pa.array([fn(_matrices(batches)).tobytes()], pa.binary())})

    def add(batches):
        vectors = (np.frombuffer(x.as_buffer()) for batch in batches for x in batch.column(0))
        total = next(vectors, None)
        if total is not None:
            for x in vectors:
                total = total + x
            yield pa.RecordBatch.from_pydict({"s": pa.array([total.tobytes()], pa.binary())})

    parts = blocks.mapInArrow(run, "s binary")
    if tasks > FEW_PARTS:
        parts = parts.repartition(FEW_PARTS).mapInArrow(add, "s binary")
    return sum(np.frombuffer(x.as_buffer()) for x in parts.toArrow().column("s"))


def _cells(X: np.ndarray, C: np.ndarray) -> np.ndarray:
    """Squared distances, a row for each centre, of rows and centres that are centred
    alike: a centre's distances lie side by side, so that minima run over whole rows."""
    d = (-2.0 * C) @ X.T
    d += (X * X).sum(1)
    d += (C * C).sum(1)[:, None]
    return np.maximum(d, 0.0, out=d)


def _mark_nearest(d: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Writes 1 into ``out`` at the nearest centre (first axis; ties: the first), else 0.
    Returns the least distances."""
    least = d.min(0)
    np.copyto(out, d == least)
    if (out.sum(0) != 1.0).any():  # ties, or no number
        out[...] = 0.0
        np.put_along_axis(out, d.argmin(0)[None], 1.0, 0)
    return least


def _uniform(X: np.ndarray, salt: int) -> np.ndarray:
    """A number in [0, 1) for each row, from its values and ``salt`` only: the same on
    a repeated task."""
    h = np.full(len(X), (salt * 2 + 1) * 0x9E3779B97F4A7C15 % (1 << 64), dtype=np.uint64)
    for column in np.ascontiguousarray(np.ascontiguousarray(X).view(np.uint64).T):
        h = (h ^ column) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return (h >> np.uint64(11)).astype("float64") / float(1 << 53)


def _weighted_plus_plus(X: np.ndarray, weight: np.ndarray, k: int, rng) -> np.ndarray:
    """Greedy k-means++ on weighted candidates (2 + log k trials a step)."""
    n, trials = len(X), 2 + int(np.log(k))
    chosen = [int(rng.choice(n, p=weight / weight.sum()))]
    d2 = ((X - X[chosen[0]]) ** 2).sum(1)
    while len(chosen) < min(k, n):
        mass = d2 * weight
        if mass.sum() <= 0:
            break  # no candidate differs from the chosen ones
        best = None
        for c in rng.choice(n, size=trials, p=mass / mass.sum()):
            new = np.minimum(d2, ((X - X[c]) ** 2).sum(1))
            potential = float((new * weight).sum())
            if best is None or potential < best[0]:
                best = (potential, int(c), new)
        chosen.append(best[1])
        d2 = best[2]
    return X[chosen]


def seed_centres(blocks: DataFrame, configs, *, rounds: int = 5,
                 more_rounds: int = 20) -> dict[int, np.ndarray]:
    """k-means|| for all (k, seed) models at once, over every row of the packed blocks.

    Each round is one pass: a row joins a model's candidates with probability
    2 k d^2 / cost, cost being the model's last known one, so about 2 k rows a
    model come back. Candidates are weighted by the rows nearest to them (one
    pass) and reduced to k by weighted k-means++. Rounds go on while a model has
    fewer than k candidates and rows away from them; a model of data with fewer
    distinct rows gets as many centres as there are.
    """
    models = range(len(configs))
    seeds = sorted({seed for _, seed in configs})  # rows are drawn by seed: models of one share the numbers

    def first(batches):
        import pandas as pd
        best = {}
        for X in _matrices(batches):
            for seed in seeds:
                u = _uniform(X, 1000 * seed)
                i = int(u.argmin())
                if seed not in best or u[i] < best[seed][0]:
                    best[seed] = (float(u[i]), X[i].tolist())
        yield pd.DataFrame([(seed, u, x) for seed, (u, x) in best.items()], columns=["seed", "u", "x"])

    rows = (_mapped(blocks, BLOCK, first, "seed long, u double, x array<double>")
            .groupBy("seed").agg(F.min_by("x", "u").alias("x")).collect())
    start = {r["seed"]: np.array([r["x"]]) for r in rows}
    if not start:
        return {}
    candidates = {m: start[configs[m][1]] for m in models}
    cost = {m: float("inf") for m in candidates}
    for number in range(rounds + more_rounds + 1):
        short = [m for m in candidates if cost[m] > 0 and (
            number <= rounds or len(candidates[m]) < configs[m][0])]
        if not short:
            break

        def sample(batches, number=number, short=short, cost=dict(cost), have=dict(candidates)):
            import pandas as pd
            total, picked = dict.fromkeys(short, 0.0), []
            stacked = np.concatenate([have[m] for m in short])
            middle = stacked.mean(0)
            farthest = ((stacked - middle) ** 2).sum(1).max()
            for X in _matrices(batches):
                Y = X - middle
                noise = 16 * X.shape[1] * np.finfo("float64").eps * ((Y ** 2).sum(1) + farthest)
                u = {seed: _uniform(X, 1000 * seed + number) for seed in {configs[m][1] for m in short}}
                for m in short:
                    C = have[m] - middle
                    step = max(1, CACHE_CELLS // len(C))
                    near = np.concatenate([_cells(Y[at:at + step], C).min(0)
                                           for at in range(0, len(Y), step)])
                    near[near < noise] = 0.0  # rounding, not distance
                    total[m] += float(near.sum())
                    if np.isfinite(cost[m]):
                        k, seed = configs[m]
                        for i in np.flatnonzero(u[seed] < 2.0 * k * near / cost[m]):
                            picked.append((m, 0.0, X[i].tolist()))
            yield pd.DataFrame([(m, c, None) for m, c in total.items()] + picked,
                               columns=["m", "cost", "x"])

        got = _mapped(blocks, BLOCK, sample, "m int, cost double, x array<double>")
        # one cost a model, and about 2 k rows of it
        for r in got.groupBy("m").agg(F.sum("cost").alias("cost"),
                                      F.collect_set("x").alias("x")).collect():
            cost[r["m"]] = r["cost"]
            if r["x"]:
                candidates[r["m"]] = np.concatenate([candidates[r["m"]], np.array(r["x"])])
    candidates = {m: np.unique(x, axis=0) for m, x in candidates.items()}
    stacked = np.concatenate([candidates[m] for m in models])
    ends = np.cumsum([0] + [len(candidates[m]) for m in models])

    def nearest(matrices):
        n, middle = np.zeros(len(stacked)), stacked.mean(0)
        for X in matrices:
            Y = X - middle
            for m in models:
                C = stacked[ends[m]:ends[m + 1]] - middle
                step = max(1, CACHE_CELLS // len(C))
                for at in range(0, len(Y), step):
                    d = _cells(Y[at:at + step], C)
                    mark = np.empty(d.shape)
                    _mark_nearest(d, mark)
                    n[ends[m]:ends[m + 1]] += mark.sum(1)
        return n

    weight = _added(blocks, nearest, blocks.rdd.getNumPartitions())
    return {m: _weighted_plus_plus(candidates[m], weight[ends[m]:ends[m + 1]] + 1e-12, configs[m][0],
                                   np.random.RandomState(configs[m][1])) for m in models}


def _lloyd_sums(blocks: DataFrame, current: dict[int, np.ndarray], tasks: int):
    """One pass over all rows: for every model its rows and sums per centre, and its cost.

    Models of as many centres are stacked centre by centre, so that one minimum
    serves all of them."""
    dim = next(iter(current.values())).shape[1]
    middle = np.concatenate(list(current.values())).mean(0)
    groups: dict[int, list[int]] = {}
    for m, C in current.items():
        groups.setdefault(len(C), []).append(m)
    stacked = np.concatenate([np.stack([current[m] for m in ms], 1).reshape(-1, dim)
                              for ms in groups.values()])
    sizes, all_models = [(k, len(ms)) for k, ms in groups.items()], len(current)

    def partial(matrices):
        n, sums, costs = np.zeros(len(stacked)), np.zeros_like(stacked), np.zeros(all_models)
        C, step = stacked - middle, max(1, CACHE_CELLS // len(stacked))
        for X in matrices:
            for at in range(0, len(X), step):
                rows = X[at:at + step]
                d = _cells(rows - middle, C)
                mark, done, models = np.empty(d.shape), 0, 0
                for k, many in sizes:
                    here, shape = slice(done, done + k * many), (k, many, len(rows))
                    least = _mark_nearest(d[here].reshape(shape), mark[here].reshape(shape))
                    costs[models:models + many] += least.sum(1)
                    done, models = done + k * many, models + many
                n += mark.sum(1)
                sums += mark @ rows
        return np.concatenate([n, sums.ravel(), costs])

    got = _added(blocks, partial, tasks)
    n, costs = got[:len(stacked)], got[-all_models:]
    sums, done, models, out = got[len(stacked):-all_models].reshape(-1, dim), 0, 0, {}
    for k, ms in groups.items():
        here = slice(done, done + k * len(ms))
        counts, totals = n[here].reshape(k, -1), sums[here].reshape(k, -1, dim)
        for i, m in enumerate(ms):
            out[m] = counts[:, i], totals[:, i], float(costs[models + i])
        done, models = done + k * len(ms), models + len(ms)
    return out


def batched_lloyd(vec: DataFrame, array_col: str, configs, *, max_iter: int = 300,
                  tol: float = 1e-4, start: dict[int, np.ndarray] | None = None) -> list[KMeansResult]:
    """Lloyd iterations for many (k, seed) models at once.

    Each iteration is one pass over the rows, cached as matrix blocks: every task
    assigns its rows to the nearest centre of every active model with numpy and
    emits one vector of partial sums per (model, cluster), which are added; only
    the sums reach the driver. Convergence per model: squared centre shift
    <= tol x mean feature variance over all rows; empty clusters keep their
    centre. ``start`` gives the first centres instead of ``seed_centres``. A
    result's ``k`` is the number of its centres.
    """
    blocks = _packed(vec, array_col)
    try:
        centres = dict(start) if start is not None else seed_centres(blocks, configs)
        if not centres:
            return []
        dim = next(iter(centres.values())).shape[1]
        spread = vec.agg(*[F.var_pop(F.col(array_col)[i]) for i in range(dim)]).first()
        limit = tol * float(np.mean([v or 0.0 for v in spread]))
        active, tasks = set(centres), blocks.rdd.getNumPartitions()
        cost = {m: float("nan") for m in centres}
        for _ in range(max_iter):
            if not active:
                break
            current = {m: centres[m] for m in sorted(active)}
            for m, (n, sums, cost[m]) in _lloyd_sums(blocks, current, tasks).items():
                new = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres[m])
                if float(((new - centres[m]) ** 2).sum()) <= limit:
                    active.discard(m)
                centres[m] = new
    finally:
        blocks.unpersist()
    order = (lambda c: [list(map(float, x)) for x in c]) if start is not None else _canonical
    return [KMeansResult(len(centres[m]), order(centres[m]), cost[m], configs[m][1])
            for m in sorted(centres)]


def sweep_scores(vec: DataFrame, array_col: str, centres_by_k: dict) -> list[tuple]:
    """Inertia and squared-Euclidean silhouette for several clusterings in two
    passes over the data (same definition as
    :func:`tidepanel.operators.metrics.silhouette_sq_euclidean`)."""
    cents = {k: np.array(c) for k, c in centres_by_k.items()}

    dim = next(iter(cents.values())).shape[1]
    widest = sum(len(C) for C in cents.values())

    def stats(batches):
        import pandas as pd
        acc = {k: [np.zeros(len(C)), np.zeros(len(C)), np.zeros(len(C)), np.zeros_like(C)]
               for k, C in cents.items()}
        for X in _blocks(batches, widest):
            sq, rows = (X * X).sum(1), np.arange(len(X))
            for k, C in cents.items():
                d = _sq_distances(X, C)
                label = d.argmin(1)
                onehot = np.zeros(d.shape)
                onehot[rows, label] = 1.0
                a = acc[k]
                a[0] += onehot.sum(0)
                a[1] += np.bincount(label, weights=sq, minlength=len(C))
                a[2] += np.bincount(label, weights=d[rows, label], minlength=len(C))
                a[3] += onehot.T @ X
        for k, (n, q, cost, y) in acc.items():
            yield pd.DataFrame({"k": k, "c": np.arange(len(n)), "n": n, "q": q, "cost": cost, "s": list(y)})

    inertia_by_k = dict.fromkeys(cents, 0.0)
    cl = {k: (np.zeros(len(C)), np.zeros(len(C)), np.zeros_like(C)) for k, C in cents.items()}
    for r in _summed(_mapped(
            vec, array_col, stats, "k int, c int, n double, q double, cost double, s array<double>"),
            ["k", "c"], ["n", "q", "cost"], dim, vec.rdd.getNumPartitions()):
        n, q, y = cl[r["k"]]
        n[r["c"]], q[r["c"]], y[r["c"]] = r["n"], r["q"], r["s"]
        inertia_by_k[r["k"]] += r["cost"]

    def sil(batches):
        import pandas as pd
        acc = {k: [0.0, 0] for k in cents}
        for X in _blocks(batches, widest):
            sq, rows = (X * X).sum(1), np.arange(len(X))
            for k, C in cents.items():
                N, Q, Y = cl[k]
                label = _sq_distances(X, C).argmin(1)
                tot = N[None, :] * sq[:, None] - 2 * X @ Y.T + Q[None, :]
                own = N[label]
                a = np.where(own > 1, tot[rows, label] / np.maximum(own - 1, 1), 0.0)
                other = np.where(N[None, :] > 0, tot / np.maximum(N[None, :], 1), np.inf)
                other[rows, label] = np.inf
                b = other.min(1)
                den = np.maximum(a, b)
                s = np.where((own > 1) & (den > 0), (b - a) / np.where(den > 0, den, 1), 0.0)
                acc[k][0] += float(s.sum())
                acc[k][1] += len(X)
        yield pd.DataFrame([(k, s, n) for k, (s, n) in acc.items()], columns=["k", "s", "n"])

    tot_s = {r["k"]: (r["s"], r["n"]) for r in _mapped(
        vec, array_col, sil, "k int, s double, n long").groupBy("k").agg(
        F.sum("s").alias("s"), F.sum("n").alias("n")).collect()}
    out = []
    for k in centres_by_k:
        s_, n_ = tot_s.get(k, (0.0, 0))
        nonempty = int((cl[k][0] > 0).sum())
        out.append((int(k), float(inertia_by_k[k]), float(s_ / n_) if n_ and nonempty > 1 else None))
    return out


def kmeans(df: DataFrame, array_col: str, k: int, *, restarts: int = 10, seed: int = 42,
           max_iter: int = 300, tol: float = 1e-4) -> KMeansResult:
    """Best of ``restarts`` k-means fits (k-means++ seeding, Lloyd), all
    restarts advanced together in one data pass per iteration; centres in
    canonical order."""
    vec, _ = right_sized(df.select(F.col(array_col).cast("array<double>").alias(array_col)),
                         50_000, default_parallelism(df.sparkSession))
    try:
        res = batched_lloyd(vec, array_col, [(k, seed + r) for r in range(restarts)],
                            max_iter=max_iter, tol=tol)
    finally:
        vec.unpersist()
    return min(res, key=lambda x: (x.cost, x.seed))


def kmeans_sweep(df: DataFrame, array_col: str, ks=range(2, 13), *, restarts: int = 10,
                 seed: int = 42, max_iter: int = 300, tol: float = 1e-4) -> tuple[DataFrame, dict]:
    """Inertia and (squared-Euclidean, linear-time) silhouette per k.

    All k x restarts models advance together (one pass per iteration).
    Returns the table ``(n_clusters, inertia, silhouette_score)`` and the
    best fit per k."""
    vec, _ = right_sized(df.select(F.col(array_col).cast("array<double>").alias(array_col)),
                         50_000, default_parallelism(df.sparkSession))
    ks = list(ks)
    try:
        res = batched_lloyd(vec, array_col, [(k, seed + r) for k in ks for r in range(restarts)],
                            max_iter=max_iter, tol=tol)
        fits = {}  # by the number of centres found: fewer than asked for on few distinct rows
        for x in res:
            cur = fits.get(x.k)
            if cur is None or (x.cost, x.seed) < (cur.cost, cur.seed):
                fits[x.k] = x
        rows = sweep_scores(vec, array_col, {k: fits[k].centres for k in sorted(fits)})
    finally:
        vec.unpersist()
    table = df.sparkSession.createDataFrame(rows, "n_clusters int, inertia double, silhouette_score double")
    return table, fits


def select_k(sweep: DataFrame) -> DataFrame:
    """The k with the best silhouette; ties -> smallest k."""
    return sweep.orderBy(F.desc_nulls_last("silhouette_score"), "n_clusters").limit(1)


def centres_table(spark, centres, names) -> DataFrame:
    """``(cluster, <feature>...)`` one row per centre."""
    rows = [(i, *map(float, c)) for i, c in enumerate(centres)]
    schema = "cluster int, " + ", ".join(f"`{n}` double" for n in names)
    return spark.createDataFrame(rows, schema)


def cluster_profile(df: DataFrame, cluster: str, measures) -> DataFrame:
    """Mean of every measure per cluster, with the cluster size."""
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"),
                                   *[F.avg(F.col(m).cast("double")).alias(f"mean_{m}") for m in measures])


def pca_2d(df: DataFrame, array_col: str, *, k: int = 2, keep=()) -> tuple[DataFrame, np.ndarray, np.ndarray, list[float]]:
    """Centred PCA on ``k`` components (spark.ml PCA does not centre on
    transform, so the column means are removed first); each component's sign
    makes its largest absolute loading positive. Returns
    ``(rows with pc1..pck, loadings, explained variance, means)``."""
    from pyspark.ml.feature import PCA

    dim = len(df.select(array_col).first()[0])
    means = df.agg(*[F.avg(F.col(array_col)[i]).alias(f"m{i}") for i in range(dim)]).first()
    mlit = F.array(*[F.lit(float(means[f"m{i}"])) for i in range(dim)])
    centred = df.withColumn("_c", F.zip_with(F.col(array_col).cast("array<double>"), mlit, lambda a, b: a - b))
    vec = to_vector(centred, "_c", "_v")
    model = PCA(k=k, inputCol="_v", outputCol="_pc").fit(vec)
    load = np.array(model.pc.toArray(), copy=True)  # dim x k
    for j in range(k):
        col = load[:, j]
        if col[np.argmax(np.abs(col))] < 0:
            load[:, j] = -col
    var = np.array(model.explainedVariance.toArray())
    exprs = []
    for j in range(k):
        w = F.array(*[F.lit(float(v)) for v in load[:, j]])
        exprs.append(F.aggregate(F.zip_with(F.col("_c"), w, lambda a, b: a * b), F.lit(0.0),
                                 lambda s, v: s + v).alias(f"pc{j + 1}"))
    return centred.select(*keep, *exprs), load, var, [float(means[f"m{i}"]) for i in range(dim)]


def project_centres(spark, centres, means, loadings: np.ndarray) -> DataFrame:
    """The centres on the components of ``pca_2d``: ``(cluster, pc1 .. pck)``."""
    at = (np.array(centres) - np.array(means)) @ loadings
    schema = "cluster int, " + ", ".join(f"pc{j + 1} double" for j in range(at.shape[1]))
    return spark.createDataFrame([(i, *map(float, row)) for i, row in enumerate(at)], schema)
