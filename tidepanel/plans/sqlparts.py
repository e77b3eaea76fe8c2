"""DuckDB SQL fragments for the oracle queries (same bindings as
:mod:`tidepanel.plans.bindings`, written independently in SQL)."""

from __future__ import annotations


def md5_bucket(key_sql: str, n: int = 100) -> str:
    return f"(CAST('0x' || substr(md5({key_sql}), 1, 8) AS BIGINT) % {n})"


def dirty(col: str, key_sql: str, sentinel: float = 999.0) -> str:
    b = md5_bucket(key_sql)
    return (f"CASE WHEN {b} < 7 THEN NULL WHEN {b} < 9 THEN CAST({sentinel} AS DOUBLE) "
            f"ELSE CAST({col} AS DOUBLE) END")


PANEL_RAW = """panel_raw AS (
  SELECT n.n_name, CAST(o.o_orderdate AS DATE) AS d, avg(o.o_totalprice) AS price,
         count(*) AS n_orders
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY 1, 2)"""

PANEL = PANEL_RAW + """,
panel AS (
  SELECT n_name, d, n_orders,
         """ + dirty("price", "n_name || ':' || CAST(d AS VARCHAR) || ':price'") + """ AS price
  FROM panel_raw)"""

_LKEY = ("CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR) || ':' || "
         "CAST(l_partkey AS VARCHAR) || ':' || CAST(l_suppkey AS VARCHAR)")

DIRTY_LINEITEM = """dl AS (
  SELECT * REPLACE (
    """ + dirty("l_quantity", _LKEY + " || ':l_quantity'") + """ AS l_quantity,
    """ + dirty("l_extendedprice", _LKEY + " || ':l_extendedprice'") + """ AS l_extendedprice,
    """ + dirty("l_discount", _LKEY + " || ':l_discount'", -99.0) + """ AS l_discount,
    """ + dirty("l_tax", _LKEY + " || ':l_tax'") + """ AS l_tax)
  FROM lineitem)"""

DIRTY_EVENTS = """dev AS (
  SELECT * REPLACE (""" + dirty("value", "CAST(event_id AS VARCHAR) || ':value'") + """ AS value)
  FROM events)"""

DIRTY_PRIORITY = """dord AS (
  SELECT * REPLACE (CASE WHEN """ + md5_bucket("CAST(o_orderkey AS VARCHAR) || ':prio'") + """ >= 7
                         THEN o_orderpriority END AS o_orderpriority)
  FROM orders)"""

LKEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate"


def ffill(col: str, part: str, order: str) -> str:
    return (f"last_value({col} IGNORE NULLS) OVER (PARTITION BY {part} ORDER BY {order} "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")


def bfill(col: str, part: str, order: str) -> str:
    return (f"first_value({col} IGNORE NULLS) OVER (PARTITION BY {part} ORDER BY {order} "
            f"ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)")


def interp_ctes(src: str, col: str, part: str, order: str, name: str) -> str:
    """CTEs ``{name}_a``, ``{name}`` adding ``{col}_i`` = position interpolation."""
    return f"""{name}_a AS (
  SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY {order}) AS pos_ FROM {src}),
{name}_b AS (
  SELECT *, {ffill(col, part, order)} AS pv_, {bfill(col, part, order)} AS nv_,
    {ffill(f"CASE WHEN {col} IS NOT NULL THEN pos_ END", part, order)} AS pp_,
    {bfill(f"CASE WHEN {col} IS NOT NULL THEN pos_ END", part, order)} AS np_
  FROM {name}_a),
{name} AS (
  SELECT * EXCLUDE (pv_, nv_, pp_, np_),
    coalesce(CAST({col} AS DOUBLE),
             CASE WHEN pp_ IS NOT NULL AND np_ IS NOT NULL
                  THEN pv_ + (nv_ - pv_) * CAST(pos_ - pp_ AS DOUBLE) / CAST(np_ - pp_ AS DOUBLE) END,
             pv_, nv_) AS {col}_i
  FROM {name}_b)"""


def union_all(parts) -> str:
    return "\nUNION ALL\n".join(parts)
