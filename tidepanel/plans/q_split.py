"""Split and fold queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepanel.operators import split
from tidepanel.plans.catalog import register
from tidepanel.plans.q_clean import PANEL_CLEAN_SQL, clean_panel
from tidepanel.sources.tables import driver_table


def _h(key_sql, mod):
    return f"(CAST('0x' || substr(md5({key_sql}), 1, 8) AS BIGINT) % {mod})"


@register("split_random", f"""SELECT o_orderkey, {_h("CAST(o_orderkey AS VARCHAR) || ':split'", 10000)} < 2000 AS is_test
FROM orders""")
def split_random(spark, sf):
    o = driver_table(spark, sf, "orders").select("o_orderkey")
    return split.split_random(o, ["o_orderkey"], 0.2)


@register("split_random_summary", f"""SELECT {_h("CAST(o_orderkey AS VARCHAR) || ':split'", 10000)} < 2000 AS is_test,
  count(*) AS n FROM orders GROUP BY 1""")
def split_random_summary(spark, sf):
    o = split.split_random(driver_table(spark, sf, "orders"), ["o_orderkey"], 0.2)
    return o.groupBy("is_test").agg(F.count(F.lit(1)).alias("n"))


@register("split_stratified", f"""SELECT o_orderstatus, {_h("o_orderstatus || ':' || CAST(o_orderkey AS VARCHAR) || ':split'", 10000)} < 2000 AS is_test,
  count(*) AS n FROM orders GROUP BY 1, 2""")
def split_stratified(spark, sf):
    o = driver_table(spark, sf, "orders")
    o = split.split_stratified(o, ["o_orderkey"], "o_orderstatus", 0.2)
    return o.groupBy("o_orderstatus", "is_test").agg(F.count(F.lit(1)).alias("n"))


@register("split_ordered", f"""WITH {PANEL_CLEAN_SQL},
c AS (SELECT quantile_cont(CAST(date_diff('day', DATE '1970-01-01', d) AS DOUBLE), 0.8) AS cut FROM pc)
SELECT n_name, d, CAST(date_diff('day', DATE '1970-01-01', d) AS DOUBLE) > cut AS is_test FROM pc, c""")
def split_ordered(spark, sf):
    p = clean_panel(spark, sf).select("n_name", "d")
    return split.split_ordered(p, "d", 0.2)


@register("split_kfold", f"""SELECT o_orderkey, CAST({_h("CAST(o_orderkey AS VARCHAR) || ':fold'", 5)} AS INTEGER) AS fold
FROM orders""")
def split_kfold(spark, sf):
    o = driver_table(spark, sf, "orders").select("o_orderkey")
    return split.kfold(o, ["o_orderkey"], 5)


@register("split_stratified_kfold", f"""SELECT o_orderpriority,
  CAST({_h("o_orderpriority || ':' || CAST(o_orderkey AS VARCHAR) || ':fold'", 5)} AS INTEGER) AS fold,
  count(*) AS n FROM orders GROUP BY 1, 2""")
def split_stratified_kfold(spark, sf):
    o = split.stratified_kfold(driver_table(spark, sf, "orders"), ["o_orderkey"], "o_orderpriority", 5)
    return o.groupBy("o_orderpriority", "fold").agg(F.count(F.lit(1)).alias("n"))


def _ranked_sql(label, seed):
    return f"""t AS (SELECT o_orderkey, {label} AS label, CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || ':{seed}'), 1, 8) AS BIGINT) AS h FROM orders),
k AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY h) AS i, count(*) OVER (PARTITION BY label) AS n FROM t)"""


@register("split_stratified_exact", f"""WITH {_ranked_sql('o_orderstatus', 'split')}
SELECT o_orderkey, label AS o_orderstatus, i <= round(0.2 * n) AS is_test FROM k""")
def split_stratified_exact(spark, sf):
    o = driver_table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return split.split_stratified_exact(o, ["o_orderkey"], "o_orderstatus", 0.2)


@register("split_stratified_kfold_exact", f"""WITH {_ranked_sql('o_orderpriority', 'fold')}
SELECT o_orderkey, label AS o_orderpriority, CAST((i > round(0.2 * n))::INT + (i > round(0.4 * n))::INT
  + (i > round(0.6 * n))::INT + (i > round(0.8 * n))::INT AS INTEGER) AS fold FROM k""")
def split_stratified_kfold_exact(spark, sf):
    o = driver_table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return split.stratified_kfold_exact(o, ["o_orderkey"], "o_orderpriority", 5)
