"""Further result tables of the workflows (Q1, Q3), column lists (F1, F5-F8), a tree and a
degree-2 model against exhaustive SQL (M1, M4, M8), assembled features (E10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepanel.operators import derive, encode, profile
from tidepanel.operators.models import tree
from tidepanel.plans import bindings as B
from tidepanel.plans import sqlparts as S
from tidepanel.plans import workflows as W
from tidepanel.plans.catalog import r, register, rounded
from tidepanel.plans.q_clean import PANEL_CLEAN_SQL, clean_panel
from tidepanel.plans.q_derive import LABEL_SQL, next_panel
from tidepanel.plans.q_encode import _CT_SQL, PLAN, _train_li
from tidepanel.plans.q_models import LI_KEYS
from tidepanel.plans.q_workflows import _q3_sql, RIDGE_Q3
from tidepanel.sources.tables import driver_table
from tidepanel.spec import categorical_columns, columns_with_prefix, drop_if_present, numeric_columns, select_columns

# ---- Q1: the tables of the panel's profile -------------------------------------------

PROFILE_SQL = f"""WITH {PANEL_CLEAN_SQL},
nx AS (SELECT *, lead(price) OVER (PARTITION BY n_name ORDER BY d) AS price_next FROM pc),
ch AS (SELECT *, price_next - price AS price_change,
         CASE WHEN price <> 0 THEN ((price_next - price) * 100.0) / price END AS price_change_pct FROM nx),
cl AS (SELECT *, {LABEL_SQL} AS rise_level FROM ch)"""
PROFILE_COLS = ["n_orders", "price", "price_next", "price_change", "price_change_pct"]


def profile_table(spark, sf, table):
    cleaned = derive.next_step_change(clean_panel(spark, sf), B.PANEL_SPEC, "price",
                                      pct_col="price_change_pct", drop_last=False)
    return W.profile_panel(
        B.dirty_nation_day_panel(spark, sf), derive.bin_labels(cleaned, "price_change_pct", "rise_level"),
        entity="n_name", measure="price", label_col="rise_level", labels=derive.RISE_LABELS, tables=[table])[table]


@register("workflow_profile_class_counts", PROFILE_SQL + """,
lv AS (SELECT unnest(['No_Increase', 'Slight_Increase', 'Large_Increase']) AS rise_level),
cnt AS (SELECT rise_level, count(*) AS c FROM cl GROUP BY 1)
SELECT coalesce(lv.rise_level, cnt.rise_level) AS rise_level, CAST(coalesce(cnt.c, 0) AS BIGINT) AS count
FROM lv FULL OUTER JOIN cnt ON lv.rise_level = cnt.rise_level""")
def workflow_profile_class_counts(spark, sf):
    return profile_table(spark, sf, "class_counts")


def _histogram_sql(col, bins=30):
    return f"""SELECT '{col}' AS "column", g.bin, {r(f'lo + g.bin * (hi - lo) / {bins}')} AS lo,
  {r(f'lo + (g.bin + 1) * (hi - lo) / {bins}')} AS hi, CAST(coalesce(c, 0) AS BIGINT) AS count
FROM (SELECT CAST(range AS INTEGER) AS bin FROM range({bins})) g,
     (SELECT CAST(min({col}) AS DOUBLE) AS lo, CAST(max({col}) AS DOUBLE) AS hi FROM cl) e
LEFT JOIN (SELECT least(CAST(floor(({col} - lo) / (hi - lo) * {bins}) AS INTEGER), {bins - 1}) AS bin, count(*) AS c
  FROM cl, (SELECT CAST(min({col}) AS DOUBLE) AS lo, CAST(max({col}) AS DOUBLE) AS hi FROM cl)
  WHERE {col} IS NOT NULL GROUP BY 1) h ON h.bin = g.bin"""


@register("workflow_profile_histograms", PROFILE_SQL + "\n" + S.union_all([_histogram_sql(c) for c in PROFILE_COLS]))
def workflow_profile_histograms(spark, sf):
    return rounded(profile_table(spark, sf, "histograms"))


def _corr_sql(a, b):
    x, y = (f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN CAST({c} AS DOUBLE) END" for c in (a, b))
    return f"SELECT '{a}' AS col_a, '{b}' AS col_b, {r(f'corr({x}, {y})')} AS corr FROM cl"


@register("workflow_profile_correlations", PROFILE_SQL + "\n" + S.union_all(
    [_corr_sql(a, b) for i, a in enumerate(PROFILE_COLS) for b in PROFILE_COLS[i + 1:]]))
def workflow_profile_correlations(spark, sf):
    out = rounded(profile_table(spark, sf, "correlations"))
    place = F.array(*[F.lit(c) for c in PROFILE_COLS])
    swap = F.array_position(place, F.col("col_a")) > F.array_position(place, F.col("col_b"))
    return out.select(F.when(swap, F.col("col_b")).otherwise(F.col("col_a")).alias("col_a"),
                      F.when(swap, F.col("col_a")).otherwise(F.col("col_b")).alias("col_b"), "corr")


# ---- Q3: test scores -------------------------------------------------------------------

@register("workflow_regress_scores", _q3_sql().rsplit("SELECT 'price' AS feature", 1)[0] + f""",
pr AS (SELECT y, my + b1 * (x1 - m1) + b2 * (x2 - m2) AS p FROM sc, so WHERE is_test)
SELECT {r('avg((y - p) ^ 2)')} AS mse, {r('sqrt(avg((y - p) ^ 2))')} AS rmse, {r('avg(abs(y - p))')} AS mae,
  {r('1 - sum((y - p) ^ 2) / (var_pop(y) * count(*))')} AS r2, {r('var_pop(y) * count(*)')} AS sst,
  {r('sum((y - p) ^ 2)')} AS sse, {r('count(*) * (var_pop(p) + (avg(p) - avg(y)) ^ 2)')} AS ssr,
  {r('regr_slope(p, y)')} AS slope, {r('regr_intercept(p, y)')} AS intercept FROM pr""")
def workflow_regress_scores(spark, sf):
    res = W.regress(next_panel(spark, sf), numeric=["price", "n_orders"], categorical=[],
                    target="price_change_pct", key_cols=["n_name", "d"], alpha=RIDGE_Q3)
    return rounded(res["metrics"].crossJoin(res["variance"]).crossJoin(
        res["trend"].select("slope", "intercept")))  # one row each


# ---- F1, F5-F8 ---------------------------------------------------------------------------

@register("frame_positive_box", f"""WITH {PANEL_CLEAN_SQL},
k AS (SELECT CAST(n_orders AS DOUBLE) AS x FROM pc WHERE n_orders > 2),
q AS (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3 FROM k),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT {r('any_value(q1)')} AS q1, {r('any_value(median)')} AS median, {r('any_value(q3)')} AS q3,
  min(CASE WHEN x >= lo THEN x END) AS whisker_lo, max(CASE WHEN x <= hi THEN x END) AS whisker_hi,
  count_if(x < lo OR x > hi) AS n_fliers, count(*) AS n FROM k, f HAVING count(*) > 0""")
def frame_positive_box(spark, sf):
    """the box of the rows beyond a threshold; no row where there are none."""
    return rounded(profile.five_number(clean_panel(spark, sf), "n_orders", where=F.col("n_orders") > 2))


@register("frame_column_roles", """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders""")
def frame_column_roles(spark, sf):
    """A list of columns, some absent ones dropped, in an order of its own."""
    orders = drop_if_present(driver_table(spark, sf, "orders"), ["o_orderpriority", "no such column"])
    return select_columns(orders, [c for c in columns_with_prefix(orders, "o_")
                                   if c in {"o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"}])


@register("frame_columns_by_type", """SELECT column_name AS "column",
  CASE WHEN column_type = 'VARCHAR' THEN 'categorical' ELSE 'numeric' END AS role FROM (DESCRIBE customer)
WHERE column_type IN ('VARCHAR', 'BIGINT', 'INTEGER', 'DOUBLE', 'FLOAT')""")
def frame_columns_by_type(spark, sf):
    """F7."""
    t = driver_table(spark, sf, "customer")
    return spark.createDataFrame([(c, "numeric") for c in numeric_columns(t)]
                                 + [(c, "categorical") for c in categorical_columns(t)], '`column` string, role string')


# ---- E10 -----------------------------------------------------------------------------------

@register("encode_assembled_values", _CT_SQL)
def encode_assembled_values(spark, sf):
    """Every place of the assembled vector under the name that the plan gives it."""
    from pyspark.ml.functions import vector_to_array
    li, train = _train_li(spark, sf)
    fitted = PLAN.fit(train)
    flat = fitted.transform(li)
    vectors = encode.assemble(flat, fitted.feature_names).withColumn("features", vector_to_array("features"))
    kinds = dict(flat.dtypes)
    return rounded(vectors.select(*LI_KEYS, *[
        F.col("features")[i].cast(kinds[name]).alias(name) for i, name in enumerate(fitted.feature_names)]))


# ---- M1, M4: a tree of depth 2 -------------------------------------------------------------

TREE_X = ["l_quantity", "l_discount", "l_tax", "is_open"]
FLAGS = ["A", "N", "R"]


def _tree_sql():
    """Exhaustive search of the split with the least Gini impurity, at the root and in both
    children. A split all of whose leaves predict the same class is no split of the result:
    the fit merges such leaves."""
    major = ["CASE WHEN {0}A >= {0}N AND {0}A >= {0}R THEN 'A' WHEN {0}N >= {0}R THEN 'N' ELSE 'R' END".format(s)
             for s in "lr"]
    value = "CASE f " + " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(TREE_X)) + " END"
    left, right = ("+".join(f"{s}{y} * {s}{y}" for y in FLAGS) for s in "lr")
    n_left, n_right = ("(" + " + ".join(f"{s}{y}" for y in FLAGS) + ")" for s in "lr")

    def search(name, rows):
        return f"""{name}v AS ({S.union_all([f"SELECT {i} AS f, {c} AS v, " + ", ".join(
            f"CAST(count_if(y = '{y}') AS DOUBLE) AS {y}" for y in FLAGS) + f" FROM {rows} GROUP BY {c}"
            for i, c in enumerate(TREE_X)])}),
{name}c AS (SELECT f, v, lead(v) OVER w AS up, {', '.join(
    f"sum({y}) OVER w AS l{y}, sum({y}) OVER (PARTITION BY f) - sum({y}) OVER w AS r{y}" for y in FLAGS)}
  FROM {name}v WINDOW w AS (PARTITION BY f ORDER BY v)),
{name}g AS (SELECT *, {n_left} + {n_right} AS n,
  1 - ({' + '.join(f'(l{y} + r{y}) ^ 2' for y in FLAGS)}) / ({n_left} + {n_right}) ^ 2 AS impurity,
  1 - (({left}) / {n_left} + ({right}) / {n_right}) / ({n_left} + {n_right}) AS after
  FROM {name}c WHERE up IS NOT NULL),
{name}b AS (SELECT f, (v + up) / 2 AS t, n, impurity, {major[0]} <> {major[1]} AS tells FROM {name}g WHERE impurity - after > 1e-12
  ORDER BY after, f, v LIMIT 1)"""

    names = "CASE f " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(TREE_X)) + " END"
    return f"""WITH b AS (SELECT CAST(l_quantity AS DOUBLE) AS l_quantity, CAST(l_discount AS DOUBLE) AS l_discount,
  CAST(l_tax AS DOUBLE) AS l_tax, CASE WHEN l_linestatus = 'O' THEN 1.0 ELSE 0.0 END AS is_open,
  l_returnflag AS y FROM lineitem),
{search('p', 'b')},
lo AS (SELECT b.* FROM b, pb WHERE {value} <= t),
hi AS (SELECT b.* FROM b, pb WHERE {value} > t),
{search('q', 'lo')},
{search('s', 'hi')}
""" + S.union_all([f"""SELECT CAST({d} AS INTEGER) AS depth, {names} AS feature, {r('t')} AS threshold,
  CAST(n AS BIGINT) AS n_samples, {r('impurity')} AS impurity FROM {t} WHERE tells{also}"""
                         for d, t, also in ((0, "pb", " OR (SELECT bool_or(tells) FROM (FROM qb UNION ALL FROM sb))"),
                                            (1, "qb", ""), (1, "sb", ""))])


@register("tree_depth2_splits", _tree_sql())
def tree_depth2_splits(spark, sf):
    li = driver_table(spark, sf, "lineitem").select(
        *TREE_X[:3], F.when(F.col("l_linestatus") == "O", 1.0).otherwise(0.0).alias("is_open"), "l_returnflag")
    frame = tree.prepare(li, TREE_X, "l_returnflag", FLAGS, keep=[])
    model = tree.fit(frame, impurity="gini", max_depth=2)
    nodes = tree.node_frame(tree.node_table(model, spark), TREE_X, FLAGS, spark)
    return rounded(nodes.where(~F.col("is_leaf")).select("depth", "feature", "threshold", "n_samples", "impurity"))
