"""Reshaping and source round-trip queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidepanel.operators import encode, reshape
from tidepanel.plans import bindings as B
from tidepanel.plans import sqlparts as S
from tidepanel.plans.catalog import r, register, rounded
from tidepanel.plans.q_clean import PANEL_CLEAN_SQL, clean_panel
from tidepanel.plans.q_encode import PRIORITIES, _oh_sql
from tidepanel.plans.q_metrics import REPORT_SQL, flag_rule, persistence, PERSIST_SQL
from tidepanel.operators import metrics
from tidepanel.session import ensure_checkpoint_dir
from tidepanel.sources import sinks
from tidepanel.sources.tables import driver_table, read_panel_csv


@register("reshape_unstack", f"""WITH {PANEL_CLEAN_SQL}
SELECT n_name, d, 'price' AS variable, {r('price')} AS value FROM pc
UNION ALL SELECT n_name, d, 'n_orders', CAST(n_orders AS DOUBLE) FROM pc""")
def reshape_unstack(spark, sf):
    return rounded(reshape.unstack(clean_panel(spark, sf), ["n_name", "d"], ["price", "n_orders"]))


_MET = ["precision", "recall", "f1", "support"]
_LBL = ["A", "N", "R", "accuracy", "macro avg", "weighted avg"]


@register("reshape_transpose_report", f"""WITH {REPORT_SQL},
lo AS ({S.union_all([f"SELECT label, '{m}' AS metric, CAST({m} AS DOUBLE) AS v FROM rep" for m in _MET])})
SELECT metric, {', '.join(r(f"max(CASE WHEN label = '{lb}' THEN v END)") + f' AS "{lb}"' for lb in _LBL)}
FROM lo GROUP BY metric""")
def reshape_transpose_report(spark, sf):
    rep = metrics.classification_report(flag_rule(spark, sf), "actual", "predicted", ["A", "N", "R"])
    return rounded(reshape.transpose(rep, "label"))


@register("reshape_concat_columns", f"""WITH {S.DIRTY_PRIORITY},
s AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS sd FROM orders)
SELECT o.o_orderkey, {r('(o.o_totalprice - s.m) / s.sd')} AS o_totalprice, {_oh_sql('p.o_orderpriority', PRIORITIES, prefix='o_orderpriority')}
FROM orders o, s JOIN dord p ON o.o_orderkey = p.o_orderkey""")
def reshape_concat_columns(spark, sf):
    o = driver_table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    left = encode.standard_scale(o, ["o_totalprice"])
    right = encode.dummies(B.dirty_orders_priority(spark, sf).select("o_orderkey", "o_orderpriority"),
                           "o_orderpriority")
    return rounded(reshape.concat_columns(left, right, ["o_orderkey"]))


@register("reshape_semi_join", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem l
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderpriority = '1-URGENT')""")
def reshape_semi_join(spark, sf):
    li = driver_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    urgent = driver_table(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT") \
        .select(F.col("o_orderkey").alias("l_orderkey"))
    return reshape.keep_rows_of(li, urgent, ["l_orderkey"])


STATUS_NAMES = {"F": "finished", "O": "open", "P": "partial"}


@register("reshape_map_values", """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished'
  WHEN 'O' THEN 'open' WHEN 'P' THEN 'partial' END AS status_name FROM orders""")
def reshape_map_values(spark, sf):
    o = driver_table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return reshape.map_values(o, "o_orderstatus", STATUS_NAMES, "status_name").drop("o_orderstatus")


@register("reshape_scatter_table", f"""WITH {PERSIST_SQL}
SELECT n_name, d, {r('actual')} AS actual, {r('predicted')} AS predicted FROM pe""")
def reshape_scatter_table(spark, sf):
    return rounded(reshape.scatter_table(persistence(spark, sf), ["actual", "predicted"],
                                         key_cols=["n_name", "d"]))


@register("source_csv_roundtrip", f"""WITH {S.PANEL}
SELECT n_name, d, {r('price')} AS price, n_orders FROM panel""")
def source_csv_roundtrip(spark, sf):
    """S3 then S1: the dirty panel written as CSV to the shared checkpoint
    folder and read back with an explicit schema and date coercion."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tidepanel-csv/{uuid.uuid4().hex}"
    p = B.dirty_nation_day_panel(spark, sf)
    sinks.write_table(p, path, fmt="csv")
    back = read_panel_csv(spark, path, "n_name string, d string, price double, n_orders bigint", date_col="d")
    return rounded(back)
