"""Metric queries (V1-V8, V10, V11) over model-free predictions.

* regression: the persistence forecast on the nation x day panel (tomorrow's
  price predicted by today's);
* classification: a fixed rule predicting ``l_returnflag`` from discount and
  tax (one class is never predicted, which exercises the zero-division rule);
* silhouette: the given labels of ``embeddings`` as clusters.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepanel.operators import metrics, split
from tidepanel.plans.catalog import r, register, rounded
from tidepanel.plans.q_derive import NEXT_SQL, next_panel
from tidepanel.sources.tables import driver_table

FLAGS = ["A", "N", "R"]


def persistence(spark, sf):
    return next_panel(spark, sf).select("n_name", "d", F.col("price_next").alias("actual"),
                                        F.col("price").alias("predicted"))


PERSIST_SQL = NEXT_SQL + ",\npe AS (SELECT n_name, d, price_next AS actual, price AS predicted FROM ch)"


@register("metrics_regression_by_nation", f"""WITH {PERSIST_SQL}
SELECT n_name, {r('avg((actual - predicted) ^ 2)')} AS mse, {r('sqrt(avg((actual - predicted) ^ 2))')} AS rmse,
  {r('avg(abs(actual - predicted))')} AS mae,
  {r('CASE WHEN var_pop(actual) * count(*) > 0 THEN 1 - sum((actual - predicted) ^ 2) / (var_pop(actual) * count(*)) END')} AS r2
FROM pe GROUP BY 1""")
def metrics_regression_by_nation(spark, sf):
    return rounded(metrics.regression_metrics(persistence(spark, sf), "actual", "predicted", ["n_name"]))


@register("metrics_variance_decomposition", f"""WITH {PERSIST_SQL},
m AS (SELECT avg(actual) AS my FROM pe)
SELECT {r('sum((actual - my) ^ 2)')} AS sst, {r('sum((actual - predicted) ^ 2)')} AS sse,
       {r('sum((predicted - my) ^ 2)')} AS ssr FROM pe, m""")
def metrics_variance_decomposition(spark, sf):
    return rounded(metrics.variance_decomposition(persistence(spark, sf), "actual", "predicted"))


@register("metrics_mape", f"""WITH {PERSIST_SQL}
SELECT {r('avg(CASE WHEN actual <> 0 THEN abs((actual - predicted) / actual) END) * 100')} AS mape FROM pe""")
def metrics_mape(spark, sf):
    return rounded(metrics.mape(persistence(spark, sf), "actual", "predicted"))


@register("metrics_trend_line", f"""WITH {PERSIST_SQL}
SELECT {r('regr_slope(predicted, actual)')} AS slope, {r('regr_intercept(predicted, actual)', 4)} AS intercept,
  {r('least(min(actual), min(predicted))')} AS line_min, {r('greatest(max(actual), max(predicted))')} AS line_max FROM pe""")
def metrics_trend_line(spark, sf):
    t = metrics.trend_line(persistence(spark, sf), "actual", "predicted")
    return rounded(t).withColumn("intercept", F.round("intercept", 4))


def flag_rule(spark, sf):
    li = driver_table(spark, sf, "lineitem")
    pred = F.when(F.col("l_discount") > 0.05, F.lit("R")).when(F.col("l_tax") > 0.04, F.lit("A")) \
        .otherwise(F.lit("R"))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     F.col("l_returnflag").alias("actual"), pred.alias("predicted"))


FLAG_SQL = """fr AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag AS actual,
  CASE WHEN l_discount > 0.05 THEN 'R' WHEN l_tax > 0.04 THEN 'A' ELSE 'R' END AS predicted FROM lineitem)"""


@register("metrics_accuracy", f"WITH {FLAG_SQL}\nSELECT {r('avg(CASE WHEN actual = predicted THEN 1.0 ELSE 0.0 END)')} AS accuracy FROM fr")
def metrics_accuracy(spark, sf):
    return rounded(metrics.accuracy(flag_rule(spark, sf), "actual", "predicted"))


CM_SQL = f"""{FLAG_SQL},
lv AS (SELECT unnest(['A', 'N', 'R']) AS v),
g AS (SELECT a.v AS actual, p.v AS predicted FROM lv a, lv p),
c AS (SELECT actual, predicted, count(*) AS n FROM fr GROUP BY 1, 2),
cm AS (SELECT g.actual, g.predicted, CAST(coalesce(c.n, 0) AS BIGINT) AS count
       FROM g LEFT JOIN c ON g.actual = c.actual AND g.predicted = c.predicted)"""


@register("metrics_confusion_matrix", f"WITH {CM_SQL}\nSELECT * FROM cm")
def metrics_confusion_matrix(spark, sf):
    return metrics.confusion_matrix(flag_rule(spark, sf), "actual", "predicted", FLAGS)


REPORT_SQL = f"""{CM_SQL},
pa AS (SELECT actual AS label, sum(CASE WHEN actual = predicted THEN count ELSE 0 END) AS tp, sum(count) AS support FROM cm GROUP BY 1),
pp AS (SELECT predicted AS label, sum(count) AS n_pred FROM cm GROUP BY 1),
cls AS (SELECT pa.label, coalesce(CASE WHEN n_pred > 0 THEN tp / n_pred END, 0.0) AS precision,
               coalesce(CASE WHEN support > 0 THEN tp / support END, 0.0) AS recall, support, tp
        FROM pa JOIN pp ON pa.label = pp.label),
cf AS (SELECT *, coalesce(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) END, 0.0) AS f1 FROM cls),
rep AS (
  SELECT label, precision, recall, f1, CAST(support AS BIGINT) AS support FROM cf
  UNION ALL SELECT 'accuracy', NULL, NULL, sum(tp) / sum(support), CAST(sum(support) AS BIGINT) FROM cf
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM cf
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM cf)"""


@register("metrics_classification_report", f"""WITH {REPORT_SQL}
SELECT label, {r('precision')} AS precision, {r('recall')} AS recall, {r('f1')} AS f1, support FROM rep""")
def metrics_classification_report(spark, sf):
    return rounded(metrics.classification_report(flag_rule(spark, sf), "actual", "predicted", FLAGS))


# some predictions are a class outside the list, some values are missing
ODD_SQL = FLAG_SQL.replace("fr AS (SELECT", "fr AS (SELECT * REPLACE (CASE WHEN l_linenumber = 7 THEN NULL "
                           "WHEN l_linenumber = 6 THEN 'X' ELSE predicted END AS predicted, "
                           "CASE WHEN l_linenumber = 5 AND l_partkey % 2 = 0 THEN NULL ELSE actual END AS actual) "
                           "FROM (SELECT", 1) + ")"
ODD_CM_SQL = f"""{ODD_SQL},
lv AS (SELECT unnest(['A', 'N', 'R', 'X', NULL]) AS v),
g AS (SELECT a.v AS actual, p.v AS predicted FROM lv a, lv p),
c AS (SELECT actual, predicted, count(*) AS n FROM fr GROUP BY 1, 2),
cm AS (SELECT g.actual, g.predicted, CAST(coalesce(c.n, 0) AS BIGINT) AS count
       FROM g LEFT JOIN c ON g.actual IS NOT DISTINCT FROM c.actual AND g.predicted IS NOT DISTINCT FROM c.predicted)"""


def odd_flags(spark, sf):
    line = F.col("l_linenumber")
    return flag_rule(spark, sf).withColumns({
        "predicted": F.when(line == 7, F.lit(None)).when(line == 6, F.lit("X")).otherwise(F.col("predicted")),
        "actual": F.when((line == 5) & (F.col("l_partkey") % 2 == 0), F.lit(None)).otherwise(F.col("actual"))})


@register("metrics_confusion_unlisted", f"WITH {ODD_CM_SQL}\nSELECT * FROM cm")
def metrics_confusion_unlisted(spark, sf):
    return metrics.confusion_matrix(odd_flags(spark, sf), "actual", "predicted", FLAGS)


@register("metrics_report_unlisted", f"""WITH {ODD_CM_SQL},
pa AS (SELECT actual AS label, sum(CASE WHEN actual = predicted THEN count ELSE 0 END) AS tp, sum(count) AS support FROM cm GROUP BY 1),
pp AS (SELECT predicted AS label, sum(count) AS n_pred FROM cm GROUP BY 1),
cls AS (SELECT coalesce(pa.label, '(missing)') AS label, coalesce(CASE WHEN n_pred > 0 THEN tp / n_pred END, 0.0) AS precision,
               coalesce(CASE WHEN support > 0 THEN tp / support END, 0.0) AS recall, support, tp
        FROM pa JOIN pp ON pa.label IS NOT DISTINCT FROM pp.label),
cf AS (SELECT *, coalesce(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) END, 0.0) AS f1 FROM cls),
rep AS (
  SELECT label, precision, recall, f1, CAST(support AS BIGINT) AS support FROM cf
  UNION ALL SELECT 'accuracy', NULL, NULL, sum(tp) / sum(support), CAST(sum(support) AS BIGINT) FROM cf
  UNION ALL SELECT 'macro avg', avg(precision) FILTER (label <> '(missing)'), avg(recall) FILTER (label <> '(missing)'),
                   avg(f1) FILTER (label <> '(missing)'), CAST(sum(support) AS BIGINT) FROM cf
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM cf)
SELECT label, {r('precision')} AS precision, {r('recall')} AS recall, {r('f1')} AS f1, support FROM rep""")
def metrics_report_unlisted(spark, sf):
    return rounded(metrics.classification_report(odd_flags(spark, sf), "actual", "predicted", FLAGS))


@register("metrics_macro_f1", f"""WITH {REPORT_SQL}
SELECT {r('f1')} AS macro_f1 FROM rep WHERE label = 'macro avg'""")
def metrics_macro_f1(spark, sf):
    return rounded(metrics.macro_f1(flag_rule(spark, sf), "actual", "predicted", FLAGS))


@register("metrics_cv_summary", f"""WITH {FLAG_SQL},
f AS (SELECT CAST(CAST('0x' || substr(md5(CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR) || ':' ||
        CAST(l_partkey AS VARCHAR) || ':' || CAST(l_suppkey AS VARCHAR) || ':fold'), 1, 8) AS BIGINT) % 5 AS INTEGER) AS fold,
        actual, predicted FROM fr),
s AS (SELECT fold, round(avg(CASE WHEN actual = predicted THEN 1.0 ELSE 0.0 END), 6) AS acc FROM f GROUP BY 1)
SELECT {r('avg(acc)')} AS mean_score, list(acc ORDER BY fold) AS scores FROM s""")
def metrics_cv_summary(spark, sf):
    fr = split.kfold(flag_rule(spark, sf), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], 5)
    per_fold = rounded(metrics.accuracy(fr, "actual", "predicted", ["fold"]))
    return rounded(metrics.cv_summary(per_fold, "fold", "accuracy"))


EMB_SQL = """e AS (SELECT vec_id, label AS c, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
pairs AS (SELECT a.vec_id, a.c AS ca, b.c AS cb, list_sum(list_transform(list_zip(a.x, b.x), lambda t: (t[1] - t[2]) * (t[1] - t[2]))) AS d2
          FROM e a JOIN e b ON a.vec_id <> b.vec_id),
per AS (SELECT vec_id, ca, cb, avg(d2) AS md FROM pairs GROUP BY 1, 2, 3),
sz AS (SELECT c, count(*) AS n FROM e GROUP BY 1),
ab AS (SELECT p.vec_id, max(CASE WHEN ca = cb THEN md END) AS a, min(CASE WHEN ca <> cb THEN md END) AS b, any_value(sz.n) AS n
       FROM per p JOIN sz ON sz.c = p.ca GROUP BY 1)"""


@register("metrics_silhouette_sq_euclidean", f"""WITH {EMB_SQL}
SELECT {r('avg(CASE WHEN n <= 1 THEN 0.0 ELSE coalesce((b - a) / greatest(a, b), 0.0) END)')} AS silhouette FROM ab""")
def metrics_silhouette_sq_euclidean(spark, sf):
    e = driver_table(spark, sf, "embeddings").select(
        "label", F.col("embedding").cast("array<double>").alias("x"))
    return rounded(metrics.silhouette_sq_euclidean(e, "x", "label"))
