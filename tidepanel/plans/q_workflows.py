"""Workflow queries (Q1-Q5, Q7) and the market panel binding."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepanel.operators import derive
from tidepanel.plans import bindings as B
from tidepanel.plans import sqlparts as S
from tidepanel.plans import workflows as W
from tidepanel.plans.catalog import r, register, rounded
from tidepanel.plans.q_clean import PANEL_CLEAN_SQL, clean_panel
from tidepanel.plans.q_derive import NEXT_SQL, next_panel
from tidepanel.plans.q_models import rise_panel
from tidepanel.spec import feature_sets

MARKET_SQL = """po AS (SELECT l_orderkey, count(*) AS k, sum(l_extendedprice) AS s_price, sum(l_discount) AS s_disc,
         sum(l_tax) AS s_tax, sum(l_quantity) AS s_qty, sum(l_extendedprice * (1 - l_discount)) AS s_rev
       FROM lineitem GROUP BY 1),
mk AS (SELECT n.n_name, CAST(o.o_orderdate AS DATE) AS d, sum(k) AS n_lines, sum(s_price) AS s_price,
         sum(s_disc) AS s_disc, sum(s_tax) AS s_tax, sum(s_qty) AS s_qty, sum(s_rev) AS revenue
       FROM po JOIN orders o ON po.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
       JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY 1, 2)"""


@register("workflow_market_panel", f"""WITH {MARKET_SQL}
SELECT n_name, d, {r('s_price / n_lines')} AS avg_line_price, CAST(n_lines AS BIGINT) AS n_lines,
  {r('s_disc / n_lines')} AS avg_discount, {r('s_tax / n_lines')} AS avg_tax,
  {r('s_qty / n_lines')} AS avg_quantity, {r('revenue')} AS revenue FROM mk""")
def workflow_market_panel(spark, sf):
    return rounded(B.market_panel(spark, sf))


@register("workflow_profile_missing", f"""WITH {PANEL_CLEAN_SQL}
SELECT * FROM (VALUES ('n_name'), ('d'), ('price'), ('n_orders')) v("column") JOIN (
  SELECT 'n_name' AS c, count(*) - count(n_name) AS missing_raw, count(*) - count(n_name) AS missing_cleaned FROM pc
  UNION ALL SELECT 'd', count(*) - count(d), count(*) - count(d) FROM pc
  UNION ALL SELECT 'price', (SELECT count(*) - count(price) FROM panel), count(*) - count(price) FROM pc
  UNION ALL SELECT 'n_orders', count(*) - count(n_orders), count(*) - count(n_orders) FROM pc) m ON v."column" = m.c""".replace(
    'SELECT * FROM (VALUES', 'SELECT v."column", missing_raw, missing_cleaned FROM (VALUES'))
def workflow_profile_missing(spark, sf):
    raw = B.dirty_nation_day_panel(spark, sf)
    cleaned = clean_panel(spark, sf)
    res = W.profile_panel(raw, derive.bin_labels(
        derive.next_step_change(cleaned, B.PANEL_SPEC, "price", pct_col="pct", drop_last=False),
        "pct", "rise_level"), entity="n_name", measure="price", label_col="rise_level",
        labels=derive.RISE_LABELS, tables=["missing"])
    return res["missing"].where(F.col("column").isin("n_name", "d", "price", "n_orders"))


@register("workflow_classify_report")
def workflow_classify_report(spark, sf):
    p = rise_panel(spark, sf).drop("is_test", "fold")
    res = W.classify(p, numeric=["price", "n_orders", "d_ordinal"], categorical=["n_name"],
                     label="rise_level", labels=list(derive.RISE_LABELS), key_cols=["n_name", "d"])
    return rounded(res["report"])


@register("workflow_regress_metrics")
def workflow_regress_metrics(spark, sf):
    p = derive.add_date_ordinal(next_panel(spark, sf), "d", "d_ordinal")
    res = W.regress(p, numeric=["price", "n_orders", "d_ordinal"], categorical=["n_name"],
                    target="price_change_pct", key_cols=["n_name", "d"], alpha=3.0)
    return rounded(res["metrics"].crossJoin(res["variance"]))


RIDGE_Q3 = 3.0


def _q3_sql():
    """Ridge on two robust-scaled numeric features, from the 2 x 2 normal equations."""
    x = ["price", "n_orders"]
    test = ("CAST('0x' || substr(md5(n_name || ':' || CAST(d AS VARCHAR) || ':split'), 1, 8) AS BIGINT) "
            "% 10000 < 2000")
    return f"""WITH {NEXT_SQL},
dt AS (SELECT n_name, d, price, n_orders, price_change_pct AS y, {test} AS is_test FROM ch
       WHERE price_change_pct IS NOT NULL),
q AS (SELECT {', '.join(f"quantile_cont({c}, 0.5) AS md_{c}" for c in x)} FROM dt WHERE NOT is_test),
fl AS (SELECT y, is_test, {', '.join(f"coalesce(CAST({c} AS DOUBLE), md_{c}) AS {c}" for c in x)} FROM dt, q),
st AS (SELECT {', '.join(f"quantile_cont({c}, 0.5) AS m_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS s_{c}" for c in x)}
       FROM fl WHERE NOT is_test),
sc AS (SELECT y, is_test, (price - m_price) / CASE WHEN s_price = 0 THEN 1 ELSE s_price END AS x1,
              (n_orders - m_n_orders) / CASE WHEN s_n_orders = 0 THEN 1 ELSE s_n_orders END AS x2 FROM fl, st),
mo AS (SELECT avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my, var_pop(x1) * count(*) + {RIDGE_Q3} AS a11,
              covar_pop(x1, x2) * count(*) AS a12, var_pop(x2) * count(*) + {RIDGE_Q3} AS a22,
              covar_pop(x1, y) * count(*) AS s1, covar_pop(x2, y) * count(*) AS s2 FROM sc WHERE NOT is_test),
so AS (SELECT *, (a22 * s1 - a12 * s2) / (a11 * a22 - a12 * a12) AS b1,
              (a11 * s2 - a12 * s1) / (a11 * a22 - a12 * a12) AS b2 FROM mo)
SELECT 'price' AS feature, {r('b1')} AS coefficient, {r('abs(b1)')} AS abs_coefficient FROM so
UNION ALL SELECT 'n_orders', {r('b2')}, {r('abs(b2)')} FROM so"""


@register("workflow_regress_coefficients", _q3_sql())
def workflow_regress_coefficients(spark, sf):
    res = W.regress(next_panel(spark, sf), numeric=["price", "n_orders"], categorical=[],
                    target="price_change_pct", key_cols=["n_name", "d"], alpha=RIDGE_Q3)
    return rounded(res["coefficients"])


def next_step_base(spark, sf):
    return W.next_step_data(B.dirty_nation_day_panel(spark, sf), B.PANEL_SPEC, value="price",
                            measures=["price", "n_orders"], sentinel=B.SENTINEL)


@register("workflow_next_step_data", f"""WITH {S.PANEL},
c AS (SELECT n_name, d, n_orders, nullif(price, CAST(999.0 AS DOUBLE)) AS price FROM panel),
{S.interp_ctes('c', 'price', 'n_name', 'd', 'ip1')},
{S.interp_ctes('ip1', 'n_orders', 'n_name', 'd', 'ip2')},
m AS (SELECT quantile_cont(price_i, 0.5) AS mp, quantile_cont(n_orders_i, 0.5) AS mn FROM ip2),
f AS (SELECT n_name, d, coalesce(price_i, mp) AS price, coalesce(n_orders_i, mn) AS n_orders FROM ip2, m),
nx AS (SELECT *, lead(price) OVER (PARTITION BY n_name ORDER BY d) AS next_price FROM f)
SELECT n_name, d, {r('price')} AS price, {r('n_orders')} AS n_orders, {r('next_price')} AS next_price,
  {r('next_price - price')} AS next_price_change FROM nx WHERE next_price - price IS NOT NULL""")
def workflow_next_step_data(spark, sf):
    return rounded(next_step_base(spark, sf))


FEATURE_SETS = feature_sets(["price", "n_orders", "d_ordinal", "n_name"], {
    "all": [], "without_n_orders": ["n_orders"], "without_date": ["d_ordinal"], "without_nation": ["n_name"]})


@register("workflow_next_step_sweep")
def workflow_next_step_sweep(spark, sf):
    d = derive.add_date_ordinal(next_step_base(spark, sf), "d", "d_ordinal")
    res = W.next_step_regression(d, feature_sets=FEATURE_SETS, target="next_price_change",
                                 categorical=["n_name"], key_cols=["n_name", "d"])
    return rounded(res["sweep"])


@register("workflow_next_step_sweep_degree_2")
def workflow_next_step_sweep_degree_2(spark, sf):
    """All 32 combinations of feature set, imputer, scaler and degree (1, 2), products of
    dummies included, from the moments of one pass."""
    d = derive.add_date_ordinal(next_step_base(spark, sf), "d", "d_ordinal")
    res = W.next_step_regression(d, feature_sets=FEATURE_SETS, target="next_price_change",
                                 categorical=["n_name"], key_cols=["n_name", "d"], degrees=(1, 2))
    return rounded(res["sweep"])


@register("workflow_cluster_sweep")
def workflow_cluster_sweep(spark, sf):
    res = W.cluster_state(B.market_panel(spark, sf), measures=list(B.MARKET_MEASURES), keep=["n_name", "d"])
    out = rounded(res["sweep"]).withColumn("chosen", F.col("n_clusters") == F.lit(int(res["k"])))
    return out


def _q7_sql():
    cols = ["price", "n_orders"]
    tr = f"""WITH {PANEL_CLEAN_SQL},
cut AS (SELECT quantile_cont(CAST(date_diff('day', DATE '1970-01-01', d) AS DOUBLE), 0.8) AS c FROM pc),
sp AS (SELECT pc.*, CAST(date_diff('day', DATE '1970-01-01', d) AS DOUBLE) > c AS is_test FROM pc, cut),
st AS (SELECT {', '.join(f"quantile_cont({c}, 0.5) AS m_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS s_{c}" for c in cols)}
       FROM sp WHERE NOT is_test),
sc AS (SELECT {', '.join(f"(CAST({c} AS DOUBLE) - m_{c}) / CASE WHEN s_{c} = 0 OR s_{c} IS NULL THEN 1.0 ELSE s_{c} END AS {c}" for c in cols)} FROM sp, st WHERE NOT is_test)
"""
    parts = [f"""SELECT '{c}' AS "column", count({c}) AS count, {r(f'avg({c})')} AS mean, {r(f'stddev_samp({c})')} AS std,
  {r(f'min({c})')} AS min, {r(f'quantile_cont({c}, 0.25)')} AS p25, {r(f'quantile_cont({c}, 0.5)')} AS p50,
  {r(f'quantile_cont({c}, 0.75)')} AS p75, {r(f'max({c})')} AS max FROM sc""" for c in cols]
    return tr + S.union_all(parts)


@register("workflow_scaled_describe", _q7_sql())
def workflow_scaled_describe(spark, sf):
    res = W.scale_with_ordered_split(clean_panel(spark, sf), time_col="d", measures=["price", "n_orders"])
    return rounded(res["describe_after"])
