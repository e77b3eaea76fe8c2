"""Encoding and scaling queries.

The SQL oracles spell the level columns of the driver data out (SQL needs
static column names); the Spark side learns the levels from the data.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepanel.operators import encode, split
from tidepanel.plans import bindings as B
from tidepanel.plans import sqlparts as S
from tidepanel.plans.catalog import r, register, rounded
from tidepanel.plans.q_clean import PANEL_CLEAN_SQL, clean_panel
from tidepanel.plans.q_impute import _LI_KEY_SQL, _LI_SPLIT_KEYS, _train_sql
from tidepanel.plans.q_profile import CLEAN_LI_SQL, MEAS, clean_lineitem
from tidepanel.sources.tables import driver_table

LI_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
# level lists of the driver data, used only to write the SQL oracles
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
REGION0_NATIONS = ["NATION_0", "NATION_10", "NATION_15", "NATION_20", "NATION_5"]
NATIONS = sorted(f"NATION_{i}" for i in range(25))
FLAGS = ["A", "N", "R"]
STATUSES = ["F", "O"]


def _oh_sql(col, levels, prefix=None, src_expr=None):
    prefix = prefix or col
    v = src_expr or col
    return ", ".join(f"CASE WHEN {v} = '{lv}' THEN 1 ELSE 0 END AS \"{prefix}_{lv}\"" for lv in levels)


@register("encode_one_hot", f"SELECT c_custkey, {_oh_sql('c_mktsegment', SEGMENTS)} FROM customer")
def encode_one_hot(spark, sf):
    c = driver_table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return encode.one_hot(c, "c_mktsegment")


@register("encode_dummies", f"WITH {S.DIRTY_PRIORITY}\nSELECT o_orderkey, {_oh_sql('o_orderpriority', PRIORITIES)} FROM dord")
def encode_dummies(spark, sf):
    o = B.dirty_orders_priority(spark, sf).select("o_orderkey", "o_orderpriority")
    return encode.dummies(o, "o_orderpriority")


@register("encode_unseen_levels", f"SELECT n_nationkey, {_oh_sql('n_name', REGION0_NATIONS)} FROM nation")
def encode_unseen_levels(spark, sf):
    n = driver_table(spark, sf, "nation")
    fit = n.where(F.col("n_regionkey") == 0)
    return encode.one_hot(n.select("n_nationkey", "n_name"), "n_name", fit_df=fit)


TRAIN_LI_SQL = f"{CLEAN_LI_SQL},\ntr AS ({_train_sql('cl', _LI_KEY_SQL)})"


def _train_li(spark, sf):
    li = clean_lineitem(spark, sf)
    return li, split.split_random(li, _LI_SPLIT_KEYS).where("NOT is_test").drop("is_test")


def _safe(s):
    return f"CASE WHEN {s} IS NULL OR {s} = 0 THEN 1.0 ELSE {s} END"


@register("encode_standard_scale", f"""WITH {TRAIN_LI_SQL},
s AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in MEAS)} FROM tr)
SELECT {S.LKEYS}, {', '.join(r(f'({c} - m_{c}) / ' + _safe(f's_{c}')) + f' AS {c}' for c in MEAS)} FROM cl, s""")
def encode_standard_scale(spark, sf):
    li, train = _train_li(spark, sf)
    return rounded(encode.standard_scale(li, MEAS, fit_df=train).select(*LI_KEYS, *MEAS))


@register("encode_robust_scale", f"""WITH {TRAIN_LI_SQL},
s AS (SELECT {', '.join(f'quantile_cont({c}, 0.5) AS m_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS s_{c}' for c in MEAS)} FROM tr)
SELECT {S.LKEYS}, {', '.join(r(f'({c} - m_{c}) / ' + _safe(f's_{c}')) + f' AS {c}' for c in MEAS)} FROM cl, s""")
def encode_robust_scale(spark, sf):
    li, train = _train_li(spark, sf)
    return rounded(encode.robust_scale(li, MEAS, fit_df=train).select(*LI_KEYS, *MEAS))


PLAN = encode.FeaturePlan(numeric=MEAS, categorical=["l_returnflag", "l_linestatus"],
                          imputer="median", scaler="standard", keep=LI_KEYS)

_CT_SQL = f"""WITH {TRAIN_LI_SQL},
med AS (SELECT {', '.join(f'quantile_cont({c}, 0.5) AS md_{c}' for c in MEAS)} FROM tr),
ti AS (SELECT {', '.join(f'coalesce({c}, md_{c}) AS {c}' for c in MEAS)} FROM tr, med),
st AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in MEAS)} FROM ti),
mf AS (SELECT (SELECT l_returnflag FROM tr WHERE l_returnflag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS mode_f,
              (SELECT l_linestatus FROM tr WHERE l_linestatus IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS mode_s)
SELECT {S.LKEYS},
  {', '.join(r(f'(coalesce({c}, md_{c}) - m_{c}) / ' + _safe(f's_{c}')) + f' AS {c}' for c in MEAS)},
  {_oh_sql('l_returnflag', FLAGS, src_expr='coalesce(l_returnflag, mode_f)')},
  {_oh_sql('l_linestatus', STATUSES, src_expr='coalesce(l_linestatus, mode_s)')}
FROM cl, med, st, mf"""


@register("encode_column_transformer", _CT_SQL)
def encode_column_transformer(spark, sf):
    li, train = _train_li(spark, sf)
    return rounded(PLAN.fit(train).transform(li))


D2_NUM = ["l_quantity", "l_discount"]
D2_PLAN = encode.FeaturePlan(numeric=D2_NUM, categorical=["l_linestatus"], imputer="median", scaler="standard",
                             degree=2, keep=LI_KEYS)


@register("encode_transformer_degree2", f"""WITH {TRAIN_LI_SQL},
med AS (SELECT {', '.join(f'quantile_cont({c}, 0.5) AS md_{c}' for c in D2_NUM)} FROM tr),
ti AS (SELECT {', '.join(f'coalesce({c}, md_{c}) AS {c}' for c in D2_NUM)} FROM tr, med),
st AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in D2_NUM)} FROM ti),
mf AS (SELECT (SELECT l_linestatus FROM tr WHERE l_linestatus IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS mode_s),
ba AS (SELECT {S.LKEYS},
  {', '.join(f"(coalesce({c}, md_{c}) - m_{c}) / " + _safe(f's_{c}') + f' AS {c}' for c in D2_NUM)},
  {_oh_sql('l_linestatus', STATUSES, src_expr='coalesce(l_linestatus, mode_s)')}
FROM cl, med, st, mf)
SELECT {S.LKEYS}, """ + ", ".join(
    r("CAST(" + ") * CAST(".join(f"{x} AS DOUBLE" for x in facs) + ")")
    + f' + 0.0 AS "{name}"' for name, facs in encode.polynomial_terms(
        D2_NUM + [f"l_linestatus_{v}" for v in STATUSES], 2)) + " FROM ba")
def encode_transformer_degree2(spark, sf):
    li, train = _train_li(spark, sf)
    out = rounded(D2_PLAN.fit(train).transform(li))
    # a negative value times a dummy's zero is -0.0: engines differ in how they show it
    return out.select(*LI_KEYS, *[(F.col(f"`{c}`") + F.lit(0.0)).alias(c)
                                  for c in out.columns if c not in LI_KEYS])


@register("encode_feature_names", f"""WITH {TRAIN_LI_SQL},
num AS (SELECT * FROM (VALUES {', '.join(f"({i}, '{c}')" for i, c in enumerate(MEAS))}) t(position, feature)),
f AS (SELECT DISTINCT l_returnflag AS v FROM tr WHERE l_returnflag IS NOT NULL),
s AS (SELECT DISTINCT l_linestatus AS v FROM tr WHERE l_linestatus IS NOT NULL),
nf AS (SELECT count(*) AS k FROM f)
SELECT CAST(position AS INTEGER) AS position, feature FROM num
UNION ALL SELECT CAST({len(MEAS)} + (SELECT count(*) FROM f f2 WHERE f2.v < f.v) AS INTEGER), 'l_returnflag_' || v FROM f
UNION ALL SELECT CAST({len(MEAS)} + k + (SELECT count(*) FROM s s2 WHERE s2.v < s.v) AS INTEGER), 'l_linestatus_' || v FROM s, nf""")
def encode_feature_names(spark, sf):
    _, train = _train_li(spark, sf)
    return PLAN.fit(train).names_table(spark)


POLY = ["l_quantity", "l_discount", "l_tax"]


def _poly_sql():
    parts = []
    for name, facs in encode.polynomial_terms(POLY, 2):
        parts.append(r(" * ".join(facs)) + f' AS "{name}"')
    return ", ".join(parts)


@register("encode_polynomial", f"WITH {CLEAN_LI_SQL}\nSELECT {S.LKEYS}, {_poly_sql()} FROM cl")
def encode_polynomial(spark, sf):
    li = clean_lineitem(spark, sf).select(*LI_KEYS, *POLY)
    return rounded(encode.polynomial(li, POLY, 2))


@register("encode_standardized_table", f"""WITH {PANEL_CLEAN_SQL},
s AS (SELECT avg(price) AS mp, stddev_pop(price) AS sp, avg(n_orders) AS mn, stddev_pop(n_orders) AS sn FROM pc)
SELECT CAST(date_diff('day', DATE '0001-01-01', d) + 1 AS BIGINT) AS Date_Ordinal,
  {r('(price - mp) / ' + _safe('sp'))} AS price, {r('(n_orders - mn) / ' + _safe('sn'))} AS n_orders,
  {_oh_sql('n_name', NATIONS)} FROM pc, s""")
def encode_standardized_table(spark, sf):
    p = clean_panel(spark, sf)
    return rounded(encode.standardized_table(p, date_col="d", numeric=["price", "n_orders"],
                                             categorical="n_name"))


@register("encode_assemble")
def encode_assemble(spark, sf):
    li, train = _train_li(spark, sf)
    fitted = PLAN.fit(train)
    return encode.assemble(fitted.transform(li), fitted.feature_names).select(*LI_KEYS, "features")
