"""Derivation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepanel.functions.columns import hash_bucket
from tidepanel.operators import derive, impute
from tidepanel.plans import bindings as B
from tidepanel.plans import sqlparts as S
from tidepanel.plans.catalog import r, register, rounded
from tidepanel.plans.q_clean import PANEL_CLEAN_SQL, clean_panel
from tidepanel.sources.tables import driver_table

SPEC = B.PANEL_SPEC


def order_date_text(spark, sf):
    """orders with the order date as text, 5 % of it replaced by junk."""
    o = driver_table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    b = hash_bucket(F.concat(F.col("o_orderkey").cast("string"), F.lit(":date")), 100)
    return o.select("o_orderkey", F.when(b < 5, F.lit("not-a-date"))
                    .otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("date_text"))


ORDER_TEXT_SQL = f"""ot AS (SELECT o_orderkey,
  CASE WHEN {S.md5_bucket("CAST(o_orderkey AS VARCHAR) || ':date'")} < 5 THEN 'not-a-date'
       ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS date_text FROM orders)"""


@register("derive_parse_date", f"""WITH {ORDER_TEXT_SQL}
SELECT o_orderkey, date_text, CAST(try_strptime(date_text, '%Y-%m-%d') AS DATE) AS d FROM ot""")
def derive_parse_date(spark, sf):
    return derive.parse_dates(order_date_text(spark, sf), "date_text", out="d")


@register("derive_date_ordinal", """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d,
  CAST(date_diff('day', DATE '0001-01-01', CAST(o_orderdate AS DATE)) + 1 AS BIGINT) AS ordinal FROM orders""")
def derive_date_ordinal(spark, sf):
    o = driver_table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    return derive.add_date_ordinal(o, "d", "ordinal")


@register("derive_date_from_ordinal", """SELECT o_orderkey,
  CAST(date_diff('day', DATE '0001-01-01', CAST(o_orderdate AS DATE)) + 1 AS BIGINT) AS ordinal,
  CAST(DATE '0001-01-01' + INTERVAL (date_diff('day', DATE '0001-01-01', CAST(o_orderdate AS DATE))) DAY AS DATE) AS d_back
FROM orders""")
def derive_date_from_ordinal(spark, sf):
    o = driver_table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    o = derive.add_date_ordinal(o, "d", "ordinal")
    return derive.add_date_from_ordinal(o, "ordinal", "d_back").drop("d")


@register("derive_date_as_int", """SELECT o_orderkey,
  CAST(strftime(CAST(o_orderdate AS DATE), '%Y%m%d') AS INTEGER) AS d_int FROM orders""")
def derive_date_as_int(spark, sf):
    o = driver_table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return derive.add_date_as_int(o, "o_orderdate", "d_int").drop("o_orderdate")


FILLED_SQL = PANEL_CLEAN_SQL + f""",
f AS (SELECT n_name, d, n_orders,
  coalesce({S.ffill('price', 'n_name', 'd')}, {S.bfill('price', 'n_name', 'd')}) AS price FROM pc)"""


def filled_panel(spark, sf):
    return impute.ffill_bfill(clean_panel(spark, sf), SPEC, ["price"])


@register("derive_lead", f"""WITH {PANEL_CLEAN_SQL}
SELECT n_name, d, {r('price')} AS price,
  {r('lead(price) OVER (PARTITION BY n_name ORDER BY d)')} AS price_next FROM pc""")
def derive_lead(spark, sf):
    p = clean_panel(spark, sf).select("n_name", "d", "price")
    return rounded(derive.lead_value(p, SPEC, ["price"]))


NEXT_SQL = FILLED_SQL + """,
nx AS (SELECT *, lead(price) OVER (PARTITION BY n_name ORDER BY d) AS price_next FROM f),
ch AS (SELECT *, price_next - price AS price_change,
         CASE WHEN price = 0 THEN NULL ELSE ((price_next - price) * 100.0) / price END AS price_change_pct
       FROM nx WHERE price_next - price IS NOT NULL)"""


def next_panel(spark, sf):
    return derive.next_step_change(filled_panel(spark, sf), SPEC, "price",
                                   pct_col="price_change_pct")


@register("derive_next_step_change", f"""WITH {NEXT_SQL}
SELECT n_name, d, n_orders, {r('price')} AS price, {r('price_next')} AS price_next,
  {r('price_change')} AS price_change, {r('price_change_pct')} AS price_change_pct FROM ch""")
def derive_next_step_change(spark, sf):
    return rounded(next_panel(spark, sf))


# The rise labels and their bounds, as in operators/derive.py
LABEL_SQL = """CASE WHEN price_change_pct IS NULL THEN NULL WHEN price_change_pct <= 0 THEN 'No_Increase'
  WHEN price_change_pct <= 5 THEN 'Slight_Increase' ELSE 'Large_Increase' END"""


@register("derive_bin_labels", f"""WITH {NEXT_SQL}
SELECT n_name, d, {LABEL_SQL} AS rise_level FROM ch""")
def derive_bin_labels(spark, sf):
    p = derive.bin_labels(next_panel(spark, sf), "price_change_pct", "rise_level")
    return p.select("n_name", "d", "rise_level")


@register("derive_sorted_panel", f"""WITH {PANEL_CLEAN_SQL}
SELECT n_name, d, n_orders, {r('price')} AS price FROM pc""")
def derive_sorted_panel(spark, sf):
    return rounded(derive.sort_panel(clean_panel(spark, sf), SPEC))


@register("derive_category_code", f"""WITH {S.DIRTY_PRIORITY}
SELECT o_orderkey, o_orderpriority,
  CAST(CASE WHEN o_orderpriority IS NOT NULL THEN
    (SELECT count(DISTINCT o2.o_orderpriority) FROM dord o2 WHERE o2.o_orderpriority < dord.o_orderpriority) END
  AS INTEGER) AS priority_code FROM dord""")
def derive_category_code(spark, sf):
    o = B.dirty_orders_priority(spark, sf).select("o_orderkey", "o_orderpriority")
    return derive.category_code(o, "o_orderpriority", "priority_code")


@register("derive_relabel_dense", """WITH s AS (SELECT DISTINCT p_size FROM part)
SELECT p.p_partkey, p.p_size,
  CAST((SELECT count(*) FROM s WHERE s.p_size < p.p_size) AS INTEGER) AS size_code FROM part p""")
def derive_relabel_dense(spark, sf):
    p = driver_table(spark, sf, "part").select("p_partkey", "p_size")
    return derive.relabel_dense(p, "p_size", "size_code")


@register("derive_top_k", f"""WITH {PANEL_CLEAN_SQL}
SELECT n_name, d, {r('price')} AS price FROM pc WHERE price IS NOT NULL
ORDER BY price DESC, n_name, d LIMIT 10""")
def derive_top_k(spark, sf):
    p = clean_panel(spark, sf).where(F.col("price").isNotNull()).select("n_name", "d", "price")
    return rounded(derive.top_k(p, [F.desc("price"), F.asc("n_name"), F.asc("d")], 10))


@register("derive_argmax", f"""WITH {PANEL_CLEAN_SQL},
a AS (SELECT n_name, avg(price) AS mean_price FROM pc GROUP BY 1)
SELECT n_name, {r('mean_price')} AS mean_price FROM a ORDER BY mean_price DESC, n_name LIMIT 1""")
def derive_argmax(spark, sf):
    a = clean_panel(spark, sf).groupBy("n_name").agg(F.avg("price").alias("mean_price"))
    return rounded(derive.argbest(a, [F.desc("mean_price"), F.asc("n_name")]))
