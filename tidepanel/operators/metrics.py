"""Evaluation metrics as aggregations.

Every metric is one aggregation over (actual, predicted) rows, optionally
grouped (per model, per fold); all aggregates are combinable, so they are
computed map-side before any exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(df: DataFrame, y: str, p: str, by=()) -> DataFrame:
    """V1: ``mse, rmse, mae, r2`` (R2 = 1 - SSE / SST, NULL when SST = 0)."""
    e = F.col(y).cast("double") - F.col(p).cast("double")
    agg = df.where(F.col(y).isNotNull() & F.col(p).isNotNull()).groupBy(*by).agg(
        F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"),
        F.sum(e * e).alias("_sse"), (F.var_pop(F.col(y).cast("double")) * F.count(F.lit(1))).alias("_sst"))
    return agg.select(*by, "mse", F.sqrt("mse").alias("rmse"), "mae",
                      F.when(F.col("_sst") > 0, F.lit(1.0) - F.col("_sse") / F.col("_sst")).alias("r2"))


def variance_decomposition(df: DataFrame, y: str, p: str, by=()) -> DataFrame:
    """V2: SST = sum (y - mean y)^2, SSE = sum (y - p)^2,
    SSR = sum (p - mean y)^2 = n (var(p) + (mean p - mean y)^2) -- one pass."""
    yy, pp = F.col(y).cast("double"), F.col(p).cast("double")
    e = yy - pp
    a = df.where(F.col(y).isNotNull() & F.col(p).isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.var_pop(yy).alias("vy"), F.var_pop(pp).alias("vp"),
        F.avg(yy).alias("my"), F.avg(pp).alias("mp"), F.sum(e * e).alias("sse"))
    return a.select(*by, (F.col("vy") * F.col("n")).alias("sst"), "sse",
                    (F.col("n") * (F.col("vp") + (F.col("mp") - F.col("my")) ** 2)).alias("ssr"))


def mape(df: DataFrame, y: str, p: str, by=()) -> DataFrame:
    """V3: mean |e / y| * 100 over rows with a non-zero actual."""
    yy = F.col(y).cast("double")
    return df.groupBy(*by).agg((F.avg(F.when(yy != 0, F.abs((yy - F.col(p)) / yy))) * 100).alias("mape"))


def trend_line(df: DataFrame, y: str, p: str, by=()) -> DataFrame:
    """V4: least-squares line of predicted on actual plus the identity-line range."""
    return df.groupBy(*by).agg(
        F.regr_slope(F.col(p).cast("double"), F.col(y).cast("double")).alias("slope"),
        F.regr_intercept(F.col(p).cast("double"), F.col(y).cast("double")).alias("intercept"),
        F.least(F.min(y), F.min(p)).cast("double").alias("line_min"),
        F.greatest(F.max(y), F.max(p)).cast("double").alias("line_max"))


def accuracy(df: DataFrame, y: str, p: str, by=()) -> DataFrame:
    """V5: share of rows with predicted == actual; a missing actual or predicted
    value is never right."""
    return df.groupBy(*by).agg(
        F.avg(F.coalesce(F.col(y) == F.col(p), F.lit(False)).cast("double")).alias("accuracy"))


MISSING = "(missing)"
MAX_CLASSES = 1_000  # classes of a report; its size is their square


def all_labels(df: DataFrame, y: str, p: str, labels) -> list:
    """``labels``, then further observed values in order, then None if a value is
    missing: every row has its place in the matrix and the report."""
    seen = df.select(F.col(y).alias("v")).union(df.select(F.col(p).alias("v"))).distinct()
    rows = [r["v"] for r in seen.limit(MAX_CLASSES + 1).collect()]
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} distinct labels")
    listed = list(labels)
    more = sorted(v for v in rows if v is not None and v not in listed)
    return listed + more + ([None] if None in rows else [])


def confusion_matrix(df: DataFrame, y: str, p: str, labels, by=()) -> DataFrame:
    """V6: ``(actual, predicted, count)`` for every label pair (zeros kept).

    Observed values outside ``labels`` and missing ones (NULL) get rows and
    columns of their own (``all_labels``), so the counts sum to all rows. The
    pair grid (labels^2 rows) is generated from the list, not by joining data."""
    kind = df.schema[y].dataType
    labels = all_labels(df, y, p, labels)
    counts = df.groupBy(*by, F.col(y).alias("actual"), F.col(p).alias("predicted")).agg(
        F.count(F.lit(1)).alias("count"))
    pairs = F.array(*[F.struct(F.lit(a).cast(kind).alias("actual"),
                               F.lit(b).cast(kind).alias("predicted"))
                      for a in labels for b in labels])
    if by:
        keys = counts.select(*by).distinct()
    else:
        keys = df.sparkSession.range(1)
    grid = keys.select(*by, F.explode(pairs).alias("g")).select(*by, "g.actual", "g.predicted")
    g, c = grid.alias("g"), counts.alias("c")
    same = [F.col(f"g.{k}").eqNullSafe(F.col(f"c.{k}")) for k in [*by, "actual", "predicted"]]
    return g.join(c, same, "left").select(
        *[F.col(f"g.{k}").alias(k) for k in [*by, "actual", "predicted"]],
        F.coalesce("c.count", F.lit(0)).cast("bigint").alias("count"))


def classification_report(df: DataFrame, y: str, p: str, labels, by=()) -> DataFrame:
    """V7: per class precision / recall / F1 / support (0 when undefined),
    then ``accuracy``, ``macro avg`` and ``weighted avg`` rows.

    Every row counts: classes outside ``labels`` are reported like listed ones,
    and rows with a missing value as class ``(missing)``, which is never right
    and stays out of the macro average (it is no class)."""
    cm = confusion_matrix(df, y, p, labels, by)
    tp = F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("count")).otherwise(0))
    per_actual = cm.groupBy(*by, F.col("actual").alias("label")).agg(
        tp.alias("tp"), F.sum("count").alias("support"))
    per_pred = cm.groupBy(*by, F.col("predicted").alias("label")).agg(F.sum("count").alias("n_pred"))
    a, b = per_actual.alias("a"), per_pred.alias("b")
    cls = a.join(b, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in [*by, "label"]]).select(
        *[F.col(f"a.{k}").alias(k) for k in [*by, "label"]], "tp", "support", "n_pred")
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("n_pred").cast("double")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support").cast("double")), F.lit(0.0))
    cls = cls.select(*by, F.coalesce(F.col("label").cast("string"), F.lit(MISSING)).alias("label"), prec.alias("precision"),
                     rec.alias("recall"), "support", "tp")
    cls = cls.withColumn("f1", F.coalesce(F.try_divide(
        2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)))
    known = F.col("label") != MISSING
    tot = cls.groupBy(*by).agg(
        F.sum("support").alias("n"), F.sum("tp").alias("ntp"),
        F.avg(F.when(known, F.col("precision"))).alias("mp"),
        F.avg(F.when(known, F.col("recall"))).alias("mr"),
        F.avg(F.when(known, F.col("f1"))).alias("mf"),
        F.sum(F.col("precision") * F.col("support")).alias("wp"),
        F.sum(F.col("recall") * F.col("support")).alias("wr"),
        F.sum(F.col("f1") * F.col("support")).alias("wf"))
    acc = F.try_divide(F.col("ntp").cast("double"), F.col("n").cast("double"))
    summary = tot.select(*by, F.explode(F.array(
        F.struct(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), acc.alias("f1"), F.col("n").alias("support")),
        F.struct(F.lit("macro avg").alias("label"), F.col("mp").alias("precision"),
                 F.col("mr").alias("recall"), F.col("mf").alias("f1"), F.col("n").alias("support")),
        F.struct(F.lit("weighted avg").alias("label"),
                 F.try_divide(F.col("wp"), F.col("n").cast("double")).alias("precision"),
                 F.try_divide(F.col("wr"), F.col("n").cast("double")).alias("recall"),
                 F.try_divide(F.col("wf"), F.col("n").cast("double")).alias("f1"),
                 F.col("n").alias("support")))).alias("s")
    ).select(*by, "s.label", "s.precision", "s.recall", "s.f1", "s.support")
    return cls.select(*by, "label", "precision", "recall", "f1", "support").unionByName(summary)


def macro_f1(df: DataFrame, y: str, p: str, labels, by=()) -> DataFrame:
    """V8: unweighted mean of the per-class F1 (model selection score)."""
    rep = classification_report(df, y, p, labels, by)
    return rep.where(~F.col("label").isin("accuracy", "macro avg", "weighted avg", MISSING)).groupBy(*by).agg(
        F.avg("f1").alias("macro_f1"))


def cv_summary(scores: DataFrame, fold: str, score: str, by=()) -> DataFrame:
    """Mean of the fold scores and the scores ordered by fold."""
    return scores.groupBy(*by).agg(
        F.avg(score).alias("mean_score"),
        F.transform(F.array_sort(F.collect_list(F.struct(F.col(fold).alias("f"), F.col(score).alias("s")))),
                    lambda x: x["s"]).alias("scores"))


def silhouette_sq_euclidean(df: DataFrame, features: str, cluster: str) -> DataFrame:
    """Mean silhouette with squared Euclidean distance, linear in rows.

    Per cluster: count N, vector sum Y and sum of squared norms Q (k rows).
    For a point x the summed squared distance to cluster C is
    ``N |x|^2 - 2 x.Y + Q``; own cluster divides by N - 1, others by N;
    singleton clusters score 0. ``features`` is an array<double> column.
    """
    x = F.col(features)
    sq = F.aggregate(F.transform(x, lambda v: v * v), F.lit(0.0), lambda a, b: a + b)
    base = df.select(F.col(cluster).alias("c"), x.alias("x"), sq.alias("sq"))
    dim = len(base.select("x").first()[0])
    stats = base.groupBy("c").agg(
        F.count(F.lit(1)).alias("n"), F.sum("sq").alias("q"),
        *[F.sum(F.col("x")[i]).alias(f"y{i}") for i in range(dim)]).collect()
    # k rows of statistics (k = number of clusters, a model parameter)
    if len(stats) < 2:
        return df.sparkSession.range(1).select(F.lit(None).cast("double").alias("silhouette"))
    terms = {}
    for s in stats:
        ylit = F.array(*[F.lit(float(s[f"y{i}"])) for i in range(dim)])
        dot = F.aggregate(F.zip_with(F.col("x"), ylit, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
        terms[s["c"]] = (s["n"], F.lit(float(s["n"])) * F.col("sq") - 2 * dot + F.lit(float(s["q"])))
    own_n = F.element_at(F.create_map(*[v for c, (n, _) in terms.items() for v in (F.lit(c), F.lit(n))]), F.col("c"))
    a_expr = None
    b_expr = None
    for c, (n, tot) in terms.items():
        a_c = F.when(F.col("c") == F.lit(c), F.try_divide(tot, F.lit(float(n - 1))))
        a_expr = a_c if a_expr is None else F.coalesce(a_expr, a_c)
        b_c = F.when(F.col("c") != F.lit(c), tot / F.lit(float(n)))
        b_expr = b_c if b_expr is None else F.least(b_expr, b_c)
    scored = base.select(own_n.alias("own_n"), a_expr.alias("a"), b_expr.alias("b"))
    s = F.when(F.col("own_n") <= 1, F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    return scored.agg(F.avg(s).alias("silhouette"))
