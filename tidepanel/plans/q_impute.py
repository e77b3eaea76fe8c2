"""Imputation queries."""

from __future__ import annotations

from tidepanel.operators import impute, split
from tidepanel.plans import bindings as B
from tidepanel.plans import sqlparts as S
from tidepanel.plans.catalog import r, register, rounded
from tidepanel.plans.q_clean import PANEL_CLEAN_SQL, clean_panel
from tidepanel.plans.q_profile import CLEAN_LI_SQL, MEAS, clean_lineitem

SPEC = B.PANEL_SPEC
LI_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]


@register("impute_ffill", f"""WITH {PANEL_CLEAN_SQL}
SELECT n_name, d, n_orders, {r(S.ffill('price', 'n_name', 'd'))} AS price FROM pc""")
def impute_ffill(spark, sf):
    return rounded(impute.ffill(clean_panel(spark, sf), SPEC, ["price"]))


@register("impute_bfill", f"""WITH {PANEL_CLEAN_SQL}
SELECT n_name, d, n_orders, {r(S.bfill('price', 'n_name', 'd'))} AS price FROM pc""")
def impute_bfill(spark, sf):
    return rounded(impute.bfill(clean_panel(spark, sf), SPEC, ["price"]))


@register("impute_ffill_bfill", f"""WITH {PANEL_CLEAN_SQL}
SELECT n_name, d, n_orders,
  {r(f"coalesce({S.ffill('price', 'n_name', 'd')}, {S.bfill('price', 'n_name', 'd')})")} AS price FROM pc""")
def impute_ffill_bfill(spark, sf):
    return rounded(impute.ffill_bfill(clean_panel(spark, sf), SPEC, ["price"]))


@register("impute_interpolate", f"""WITH {PANEL_CLEAN_SQL},
{S.interp_ctes('pc', 'price', 'n_name', 'd', 'ip')}
SELECT n_name, d, n_orders, {r('price_i')} AS price FROM ip""")
def impute_interpolate(spark, sf):
    return rounded(impute.interpolate_linear(clean_panel(spark, sf), SPEC, ["price"]))


@register("impute_events_interpolate", f"""WITH {S.DIRTY_EVENTS},
c AS (SELECT event_id, ts, event_type, nullif(value, CAST(999.0 AS DOUBLE)) AS value FROM dev),
{S.interp_ctes('c', 'value', 'event_type', 'ts, event_id', 'ip')}
SELECT event_id, ts, event_type, {r('value_i')} AS value FROM ip""")
def impute_events_interpolate(spark, sf):
    ev = B.dirty_events(spark, sf).select("event_id", "ts", "event_type", "value")
    from tidepanel.operators import clean
    ev = clean.sentinel_to_null(ev, {"value": B.SENTINEL})
    return rounded(impute.interpolate_linear(ev, B.EVENT_SPEC, ["value"]))


@register("impute_time_series_fill", f"""WITH {PANEL_CLEAN_SQL},
{S.interp_ctes('pc', 'price', 'n_name', 'd', 'ip1')},
{S.interp_ctes('ip1', 'n_orders', 'n_name', 'd', 'ip2')},
m AS (SELECT quantile_cont(price_i, 0.5) AS mp, quantile_cont(n_orders_i, 0.5) AS mn FROM ip2)
SELECT n_name, d, {r('coalesce(price_i, mp)')} AS price, {r('coalesce(n_orders_i, mn)')} AS n_orders
FROM ip2, m""")
def impute_time_series_fill(spark, sf):
    p = clean_panel(spark, sf)
    return rounded(impute.time_series_fill(p, SPEC, ["price", "n_orders"]))


def _train_sql(src, key_sql):
    return (f"SELECT * FROM {src} WHERE CAST('0x' || substr(md5({key_sql} || ':split'), 1, 8) "
            f"AS BIGINT) % 10000 >= 2000")


_LI_KEY_SQL = ("CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR) || ':' || "
               "CAST(l_partkey AS VARCHAR) || ':' || CAST(l_suppkey AS VARCHAR)")
_LI_SPLIT_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _train_lineitem(spark, sf):
    li = clean_lineitem(spark, sf)
    return li, split.split_random(li, _LI_SPLIT_KEYS).where("NOT is_test").drop("is_test")


@register("impute_median_fit_train", f"""WITH {CLEAN_LI_SQL},
tr AS ({_train_sql('cl', _LI_KEY_SQL)}),
m AS (SELECT {', '.join(f'quantile_cont({c}, 0.5) AS m_{c}' for c in MEAS)} FROM tr)
SELECT {S.LKEYS}, {', '.join(r(f'coalesce({c}, m_{c})') + f' AS {c}' for c in MEAS)} FROM cl, m""")
def impute_median_fit_train(spark, sf):
    li, train = _train_lineitem(spark, sf)
    return rounded(impute.impute_median(li, MEAS, fit_df=train).select(*LI_KEYS, *MEAS))


@register("impute_mean_fit_train", f"""WITH {CLEAN_LI_SQL},
tr AS ({_train_sql('cl', _LI_KEY_SQL)}),
m AS (SELECT {', '.join(f'avg({c}) AS m_{c}' for c in MEAS)} FROM tr)
SELECT {S.LKEYS}, {', '.join(r(f'coalesce({c}, m_{c})') + f' AS {c}' for c in MEAS)} FROM cl, m""")
def impute_mean_fit_train(spark, sf):
    li, train = _train_lineitem(spark, sf)
    return rounded(impute.impute_mean(li, MEAS, fit_df=train).select(*LI_KEYS, *MEAS))


@register("impute_most_frequent", f"""WITH {S.DIRTY_PRIORITY},
tr AS ({_train_sql('dord', 'CAST(o_orderkey AS VARCHAR)')}),
m AS (SELECT o_orderpriority AS mode_v FROM tr WHERE o_orderpriority IS NOT NULL
      GROUP BY 1 ORDER BY count(*) DESC, o_orderpriority LIMIT 1)
SELECT o_orderkey, coalesce(o_orderpriority, mode_v) AS o_orderpriority FROM dord, m""")
def impute_most_frequent(spark, sf):
    o = B.dirty_orders_priority(spark, sf).select("o_orderkey", "o_orderpriority")
    train = split.split_random(o, ["o_orderkey"]).where("NOT is_test")
    return impute.impute_most_frequent(o, ["o_orderpriority"], fit_df=train)
