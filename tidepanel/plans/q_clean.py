"""Cleaning queries."""

from __future__ import annotations

from tidepanel.operators import clean
from tidepanel.plans import bindings as B
from tidepanel.plans import sqlparts as S
from tidepanel.plans.catalog import r, register, rounded
from tidepanel.plans.q_profile import CLEAN_LI_SQL, MEAS, clean_lineitem

KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]


@register("clean_sentinel_to_null", f"WITH {CLEAN_LI_SQL}\nSELECT {S.LKEYS}, "
          "l_quantity, l_extendedprice, l_discount, l_tax FROM cl")
def clean_sentinel_to_null(spark, sf):
    return clean_lineitem(spark, sf).select(*KEYS, *MEAS)


@register("clean_threshold_to_null", f"""WITH {S.DIRTY_LINEITEM}
SELECT {S.LKEYS}, CASE WHEN l_quantity <= 100 THEN l_quantity END AS l_quantity,
       CASE WHEN l_tax <= 100 THEN l_tax END AS l_tax FROM dl""")
def clean_threshold_to_null(spark, sf):
    d = clean.threshold_to_null(B.dirty_lineitem(spark, sf), {"l_quantity": 100.0, "l_tax": 100.0})
    return d.select(*KEYS, "l_quantity", "l_tax")


@register("clean_drop_sentinel_rows", f"""WITH {S.DIRTY_LINEITEM}
SELECT {S.LKEYS}, l_quantity, l_discount FROM dl
WHERE l_quantity IS DISTINCT FROM CAST(999.0 AS DOUBLE) AND l_discount IS DISTINCT FROM CAST(-99.0 AS DOUBLE)""")
def clean_drop_sentinel_rows(spark, sf):
    d = clean.drop_sentinel_rows(B.dirty_lineitem(spark, sf), {"l_quantity": 999.0, "l_discount": -99.0})
    return d.select(*KEYS, "l_quantity", "l_discount")


@register("clean_clip", f"""WITH {S.DIRTY_LINEITEM}
SELECT {S.LKEYS},
  CASE WHEN l_quantity IS NOT NULL THEN least(greatest(l_quantity, -20.0), 20.0) END AS l_quantity,
  CASE WHEN l_discount IS NOT NULL THEN least(greatest(l_discount, -1.0), 1.0) END AS l_discount FROM dl""")
def clean_clip(spark, sf):
    d = clean.clip(B.dirty_lineitem(spark, sf), {"l_quantity": (-20, 20), "l_discount": (-1, 1)})
    return d.select(*KEYS, "l_quantity", "l_discount")


def _iqr_part(c):
    return (f"SELECT '{c}' AS \"column\", quantile_cont({c}, 0.25) AS q1, "
            f"quantile_cont({c}, 0.75) AS q3 FROM cl")


IQR_SQL = f"WITH {CLEAN_LI_SQL},\nq AS (" + S.union_all([_iqr_part(c) for c in MEAS]) + "),\n" + \
    "b AS (SELECT \"column\", q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, " \
    "q3 + 1.5 * (q3 - q1) AS upper FROM q)\n"


@register("clean_iqr_bounds", IQR_SQL + f"""SELECT "column", {r('q1')} AS q1, {r('q3')} AS q3,
  {r('iqr')} AS iqr, {r('lower')} AS lower, {r('upper')} AS upper FROM b""")
def clean_iqr_bounds(spark, sf):
    return rounded(clean.iqr_bounds(clean_lineitem(spark, sf), MEAS))


@register("clean_outlier_report", IQR_SQL + S.union_all([
    f"""SELECT '{c}' AS "column", {r('b.lower')} AS lower, {r('b.upper')} AS upper,
       count_if(cl.{c} < b.lower) AS n_low, count_if(cl.{c} > b.upper) AS n_high,
       count_if(cl.{c} < b.lower) + count_if(cl.{c} > b.upper) AS n_outliers
    FROM cl, b WHERE b."column" = '{c}' GROUP BY b.lower, b.upper""" for c in MEAS]))
def clean_outlier_report(spark, sf):
    return rounded(clean.outlier_report(clean_lineitem(spark, sf), MEAS))


PANEL_CLEAN_SQL = S.PANEL + """,
pc AS (SELECT n_name, d, n_orders, nullif(price, CAST(999.0 AS DOUBLE)) AS price FROM panel)"""


def clean_panel(spark, sf):
    return clean.sentinel_to_null(B.dirty_nation_day_panel(spark, sf), {"price": B.SENTINEL})


@register("clean_iqr_outliers", f"""WITH {PANEL_CLEAN_SQL},
q AS (SELECT quantile_cont(n_orders, 0.25) AS q1, quantile_cont(n_orders, 0.75) AS q3 FROM pc)
SELECT n_name, d, n_orders, {r('price')} AS price FROM pc, q
WHERE n_orders < q1 - 1.5 * (q3 - q1) OR n_orders > q3 + 1.5 * (q3 - q1)""")
def clean_iqr_outliers(spark, sf):
    return rounded(clean.iqr_outliers(clean_panel(spark, sf), "n_orders"))


@register("clean_recipe_a", f"""WITH {S.DIRTY_LINEITEM}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS l_shipdate,
  CAST(date_diff('day', DATE '0001-01-01', CAST(l_shipdate AS DATE)) + 1 AS BIGINT) AS ship_ordinal,
  CASE WHEN l_quantity <= 100 THEN l_quantity END AS l_quantity,
  nullif(l_discount, CAST(-99.0 AS DOUBLE)) AS l_discount FROM dl""")
def clean_recipe_a(spark, sf):
    d = clean.clean_recipe_a(B.dirty_lineitem(spark, sf), date_col="l_shipdate",
                             ordinal_col="ship_ordinal", upper_limits={"l_quantity": 100.0},
                             sentinels={"l_discount": -99.0})
    return d.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
                    "ship_ordinal", "l_quantity", "l_discount")


@register("clean_recipe_b", f"""WITH {S.DIRTY_LINEITEM},
n AS (SELECT *, nullif(l_quantity, CAST(999.0 AS DOUBLE)) AS q0, nullif(l_discount, CAST(-99.0 AS DOUBLE)) AS d0 FROM dl)
SELECT {S.LKEYS},
  CASE WHEN q0 IS NOT NULL THEN least(greatest(q0, -20.0), 20.0) END AS l_quantity,
  CASE WHEN d0 IS NOT NULL THEN least(greatest(d0, -1.0), 1.0) END AS l_discount FROM n""")
def clean_recipe_b(spark, sf):
    d = clean.clean_recipe_b(B.dirty_lineitem(spark, sf),
                             rules={"l_quantity": (999.0, -20.0, 20.0), "l_discount": (-99.0, -1.0, 1.0)})
    return d.select(*KEYS, "l_quantity", "l_discount")

