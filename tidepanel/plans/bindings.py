"""Binding of the operators to the driver tables.

* nation x day panel: ``orders`` joined to ``customer`` and ``nation``,
  grouped by (n_name, order date): mean order price and order count;
* dirty-value injection by a key hash, identical on every engine with md5;
* a dirty row-level ``lineitem`` and an ``events`` series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.functions.columns import computed_once, hash_bucket
from tidepanel.session import bounded_broadcast
from tidepanel.sources.tables import driver_table
from tidepanel.spec import PanelSpec

# Fixed values of the dirty-value rule: buckets 0-6 of 100 -> NULL,
# 7-8 -> the sentinel, else the original value.
NULL_BUCKETS = 7
SENTINEL_BUCKETS = 2
SENTINEL = 999.0
LOW_SENTINEL = -99.0

# The nation x day panel has one row per entity and day, so its chunk width is
# fixed (a quarter): no extra job over the joined panel to find the date range.
# Events keep the derived width: their min/max reads only the time column.
PANEL_CHUNK_DAYS = 91.0
PANEL_SPEC = PanelSpec(entity=("n_name",), time="d", chunk_width=PANEL_CHUNK_DAYS)
EVENT_SPEC = PanelSpec(entity=("event_type",), time="ts", tiebreak=("event_id",))
LINEITEM_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
# sentinel used per dirty lineitem column
LINEITEM_SENTINELS = {"l_quantity": SENTINEL, "l_extendedprice": SENTINEL,
                      "l_discount": LOW_SENTINEL, "l_tax": SENTINEL}


def inject_dirty(col: str, key: Column, sentinel: float = SENTINEL) -> Column:
    return dirty_by(col, hash_bucket(key, 100), sentinel)


def dirty_by(col: str, b: Column, sentinel: float = SENTINEL) -> Column:
    """The value of `col` in a row of hash bucket `b`."""
    return (F.when(b < NULL_BUCKETS, F.lit(None).cast("double"))
            .when(b < NULL_BUCKETS + SENTINEL_BUCKETS, F.lit(float(sentinel)))
            .otherwise(F.col(col).cast("double")))


def customer_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(c_custkey, n_name); nation is a bounded dimension -> proven broadcast."""
    cust = driver_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = driver_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return cust.join(bounded_broadcast(nation, 10_000),
                     cust.c_nationkey == nation.n_nationkey).select("c_custkey", "n_name")


def nation_day_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(n_name, d, price, n_orders)``: one row per nation and order date.

    orders x customer is a shuffle join on the customer key (AQE splits a hot
    customer); the group-by is partially aggregated before its exchange.
    """
    orders = driver_table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    cn = customer_nation(spark, sf_dir)
    j = orders.join(cn, orders.o_custkey == cn.c_custkey)
    return j.groupBy("n_name", F.col("o_orderdate").cast("date").alias("d")).agg(
        F.avg("o_totalprice").alias("price"), F.count(F.lit(1)).alias("n_orders"))


def dirty_nation_day_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel with NULLs and 999.0 sentinels injected into ``price``."""
    p = nation_day_panel(spark, sf_dir)
    key = F.concat_ws(":", F.col("n_name"), F.col("d").cast("string"), F.lit("price"))
    return p.withColumn("price", inject_dirty("price", key))


def _lineitem_key() -> Column:
    return F.concat_ws(":", *[F.col(c).cast("string") for c in
                              ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])


def dirty_lineitem(spark: SparkSession, sf_dir: str, measures=LINEITEM_MEASURES) -> DataFrame:
    """Row-level lineitem with NULLs and sentinels in its measures; without those of the
    four that are not among ``measures``."""
    li = driver_table(spark, sf_dir, "lineitem").drop(
        *[c for c in LINEITEM_MEASURES if c not in measures])
    key = _lineitem_key()
    rows = computed_once(li, {f"_bucket_{c}": hash_bucket(F.concat(key, F.lit(":" + c)), 100)
                              for c in measures})
    return rows.withColumns({
        c: dirty_by(c, F.col(f"_bucket_{c}"), LINEITEM_SENTINELS[c])
        for c in measures}).drop(*[f"_bucket_{c}" for c in measures])


def dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with NULLs / 999.0 in ``value`` (key ``event_id:value``)."""
    ev = driver_table(spark, sf_dir, "events")
    key = F.concat(F.col("event_id").cast("string"), F.lit(":value"))
    return ev.withColumn("value", inject_dirty("value", key))


def dirty_orders_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with ``o_orderpriority`` missing in 7 % of rows (key ``o_orderkey:prio``)."""
    o = driver_table(spark, sf_dir, "orders")
    b = hash_bucket(F.concat(F.col("o_orderkey").cast("string"), F.lit(":prio")), 100)
    return o.withColumn("o_orderpriority",
                        F.when(b >= NULL_BUCKETS, F.col("o_orderpriority")))


MARKET_MEASURES = ("avg_line_price", "n_lines", "avg_discount", "avg_tax", "avg_quantity", "revenue")


def market_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six measures per nation and order date from lineitem x orders x customer.

    lineitem is first reduced to one row per order (partial sums, combined
    map-side); that aggregate is hash-partitioned by the order key, which is
    also the join key with orders, so the join adds no exchange on that side.
    """
    li = driver_table(spark, sf_dir, "lineitem")
    per_order = li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("k"), F.sum("l_extendedprice").alias("s_price"),
        F.sum("l_discount").alias("s_disc"), F.sum("l_tax").alias("s_tax"),
        F.sum("l_quantity").alias("s_qty"),
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("s_rev"))
    orders = driver_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = per_order.join(orders, per_order.l_orderkey == orders.o_orderkey)
    cn = customer_nation(spark, sf_dir)
    j = j.join(cn, j.o_custkey == cn.c_custkey)
    g = j.groupBy("n_name", F.col("o_orderdate").cast("date").alias("d")).agg(
        F.sum("k").alias("n_lines"), F.sum("s_price").alias("s_price"), F.sum("s_disc").alias("s_disc"),
        F.sum("s_tax").alias("s_tax"), F.sum("s_qty").alias("s_qty"), F.sum("s_rev").alias("revenue"))
    n = F.col("n_lines").cast("double")
    return g.select("n_name", "d", (F.col("s_price") / n).alias("avg_line_price"), "n_lines",
                    (F.col("s_disc") / n).alias("avg_discount"), (F.col("s_tax") / n).alias("avg_tax"),
                    (F.col("s_qty") / n).alias("avg_quantity"), "revenue")
