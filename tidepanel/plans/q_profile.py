"""Profiling queries (P1-P15) and the minimum end-to-end slice."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepanel.operators import clean, derive, impute, profile
from tidepanel.plans import bindings as B
from tidepanel.plans import sqlparts as S
from tidepanel.plans.catalog import r, register, rounded
from tidepanel.sources.tables import driver_table

LI_NUM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
          "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LI_ALL = LI_NUM[:4] + ["l_quantity", "l_extendedprice", "l_discount", "l_tax",
                       "l_returnflag", "l_linestatus", "l_shipdate"]
MEAS = list(B.LINEITEM_MEASURES)
CORR_COLS = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_partkey"]


def clean_lineitem(spark, sf, measures=B.LINEITEM_MEASURES):
    return clean.sentinel_to_null(B.dirty_lineitem(spark, sf, measures),
                                  {c: B.LINEITEM_SENTINELS[c] for c in measures})


# ---- minimum slice: panel -> dirty -> C1 -> I3 -> D6 -> D7 -> P12 ----------

def rise_level_distribution(spark, sf):
    p = B.dirty_nation_day_panel(spark, sf)
    p = clean.sentinel_to_null(p, {"price": B.SENTINEL})
    p = impute.ffill_bfill(p, B.PANEL_SPEC, ["price"])
    p = derive.next_step_change(p, B.PANEL_SPEC, "price", pct_col="price_change_pct")
    p = derive.bin_labels(p, "price_change_pct", "rise_level")
    return profile.class_distribution(p, "rise_level", derive.RISE_LABELS)


# Fixed values in it: the rise labels and their bounds, as in operators/derive.py
SQL_RISE = f"""WITH {S.PANEL},
c1 AS (SELECT n_name, d, nullif(price, CAST(999.0 AS DOUBLE)) AS price FROM panel),
f AS (SELECT n_name, d, coalesce({S.ffill('price', 'n_name', 'd')}, {S.bfill('price', 'n_name', 'd')}) AS price FROM c1),
n AS (SELECT *, lead(price) OVER (PARTITION BY n_name ORDER BY d) AS price_next FROM f),
ch AS (SELECT *, price_next - price AS chg FROM n),
pc AS (SELECT CASE WHEN price = 0 THEN NULL ELSE (chg * 100.0) / price END AS pct FROM ch WHERE chg IS NOT NULL),
lab AS (SELECT CASE WHEN pct IS NULL THEN NULL WHEN pct <= 0 THEN 'No_Increase'
                    WHEN pct <= 5 THEN 'Slight_Increase' ELSE 'Large_Increase' END AS rise_level FROM pc),
cnt AS (SELECT rise_level, count(*) AS c FROM lab GROUP BY 1),
lv AS (SELECT unnest(['No_Increase', 'Slight_Increase', 'Large_Increase']) AS rise_level)
SELECT coalesce(lv.rise_level, cnt.rise_level) AS rise_level, CAST(coalesce(cnt.c, 0) AS BIGINT) AS count
FROM lv FULL OUTER JOIN cnt ON lv.rise_level = cnt.rise_level"""

register("rise_level_distribution", SQL_RISE)(rise_level_distribution)


# ---- P1 / P2 ----------------------------------------------------------------

@register("profile_shape", """SELECT count(*) AS n_rows,
  (SELECT CAST(count(*) AS BIGINT) FROM (DESCRIBE lineitem)) AS n_columns FROM lineitem""")
def profile_shape(spark, sf):
    return profile.table_shape(driver_table(spark, sf, "lineitem"))


_TYPE_MAP = ("CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' "
             "WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' "
             "WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'DATE' THEN 'date' "
             "WHEN 'FLOAT' THEN 'float' ELSE lower(column_type) END")


@register("profile_column_types", f"""WITH t AS (SELECT column_name AS "column", {_TYPE_MAP} AS data_type FROM (DESCRIBE lineitem)),
nn AS ({S.union_all([f"SELECT '{c}' AS \"column\", count({c}) AS non_null FROM lineitem" for c in LI_ALL])})
SELECT t."column", t.data_type, nn.non_null FROM t JOIN nn ON t."column" = nn."column\"""")
def profile_column_types(spark, sf):
    return profile.column_types(driver_table(spark, sf, "lineitem"))


# ---- P3 / P4 -------------------------------------------------------------------

def _describe_sql_part(c):
    x = f"CAST({c} AS DOUBLE)"
    return (f"SELECT '{c}' AS \"column\", count({x}) AS count, {r(f'avg({x})')} AS mean, "
            f"{r(f'stddev_samp({x})')} AS std, {r(f'min({x})')} AS min, "
            f"{r(f'quantile_cont({x}, 0.25)')} AS p25, {r(f'quantile_cont({x}, 0.5)')} AS p50, "
            f"{r(f'quantile_cont({x}, 0.75)')} AS p75, {r(f'max({x})')} AS max FROM dl")


@register("profile_describe_numeric",
          f"WITH {S.DIRTY_LINEITEM}\n" + S.union_all([_describe_sql_part(c) for c in LI_NUM]))
def profile_describe_numeric(spark, sf):
    return rounded(profile.describe_numeric(B.dirty_lineitem(spark, sf), LI_NUM))


def _text_part(c, src):
    return (f"SELECT '{c}' AS \"column\", (SELECT count({c}) FROM {src}) AS count, "
            f"(SELECT count(DISTINCT {c}) FROM {src}) AS \"unique\", top, freq FROM "
            f"(SELECT {c} AS top, count(*) AS freq FROM {src} WHERE {c} IS NOT NULL "
            f"GROUP BY 1 ORDER BY freq DESC, top LIMIT 1)")


@register("profile_describe_text", f"WITH {S.DIRTY_PRIORITY}\n" + S.union_all(
    [_text_part("o_orderpriority", "dord"), _text_part("o_orderstatus", "dord")]))
def profile_describe_text(spark, sf):
    return profile.describe_categorical(B.dirty_orders_priority(spark, sf),
                                        ["o_orderpriority", "o_orderstatus"])


_ALL_COLS = ["o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus"]


def _all_part(c):
    x = f"CAST({c} AS DOUBLE)"
    if c in ("o_orderkey", "o_totalprice"):
        return (f"SELECT '{c}' AS \"column\", count({c}) AS count, NULL AS \"unique\", NULL AS top, NULL AS freq, "
                f"{r(f'avg({x})')} AS mean, {r(f'stddev_samp({x})')} AS std, {r(f'min({x})')} AS min, "
                f"{r(f'quantile_cont({x}, 0.25)')} AS p25, {r(f'quantile_cont({x}, 0.5)')} AS p50, "
                f"{r(f'quantile_cont({x}, 0.75)')} AS p75, {r(f'max({x})')} AS max FROM da")
    nulls = ", ".join(f"NULL AS {n}" for n in ("mean", "std", "min", "p25", "p50", "p75", "max"))
    return f"SELECT *, {nulls} FROM ({_text_part(c, 'da')})"


@register("profile_describe_all", f"WITH {S.DIRTY_PRIORITY},\nda AS (SELECT d.o_orderkey, o.o_totalprice, d.o_orderpriority, "
          "d.o_orderstatus FROM dord d JOIN orders o ON d.o_orderkey = o.o_orderkey)\n"
          + S.union_all([_all_part(c) for c in _ALL_COLS]))
def profile_describe_all(spark, sf):
    d = B.dirty_orders_priority(spark, sf).select("o_orderkey", "o_orderpriority", "o_orderstatus")
    o = driver_table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return rounded(profile.describe_all(d.join(o, "o_orderkey").select(*_ALL_COLS)))


# ---- P5 / P6 -------------------------------------------------------------------

@register("profile_missing_counts", f"WITH {S.DIRTY_LINEITEM}\n" + S.union_all(
    [f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_count FROM dl" for c in LI_ALL]))
def profile_missing_counts(spark, sf):
    return profile.missing_counts(B.dirty_lineitem(spark, sf), LI_ALL)


def _sent_part(c):
    if c in ("l_returnflag", "l_linestatus", "l_shipdate"):
        return f"SELECT '{c}' AS \"column\", CAST(0 AS BIGINT) AS sentinel_count"
    return (f"SELECT '{c}' AS \"column\", CAST(count_if(CAST({c} AS DOUBLE) = 999.0) AS BIGINT) "
            f"AS sentinel_count FROM dl")


@register("profile_sentinel_counts", f"WITH {S.DIRTY_LINEITEM}\n" + S.union_all(
    [_sent_part(c) for c in LI_ALL]))
def profile_sentinel_counts(spark, sf):
    return profile.sentinel_counts(B.dirty_lineitem(spark, sf), 999.0, LI_ALL)


# ---- P7 histogram ----------------------------------------------------------------

CLEAN_LI_SQL = S.DIRTY_LINEITEM + """,
cl AS (SELECT * REPLACE (nullif(l_quantity, CAST(999.0 AS DOUBLE)) AS l_quantity,
                         nullif(l_extendedprice, CAST(999.0 AS DOUBLE)) AS l_extendedprice,
                         nullif(l_discount, CAST(-99.0 AS DOUBLE)) AS l_discount,
                         nullif(l_tax, CAST(999.0 AS DOUBLE)) AS l_tax) FROM dl)"""


def _hist_part(c, bins):
    return f"""SELECT '{c}' AS "column", g.bin,
    {r(f"mm.mn + (g.bin * (mm.mx - mm.mn)) / {bins}")} AS lo,
    {r(f"mm.mn + ((g.bin + 1) * (mm.mx - mm.mn)) / {bins}")} AS hi,
    CAST(coalesce(h.c, 0) AS BIGINT) AS count
  FROM (SELECT CAST(range AS INTEGER) AS bin FROM range({bins})) g
  CROSS JOIN (SELECT min({c}) AS mn, max({c}) AS mx FROM cl) mm
  LEFT JOIN (SELECT CASE WHEN mx = mn THEN 0 ELSE LEAST(CAST(floor(({c} - mn) / (mx - mn) * {bins}) AS INTEGER), {bins - 1}) END AS bin,
                    count(*) AS c
             FROM cl, (SELECT min({c}) AS mn, max({c}) AS mx FROM cl) WHERE {c} IS NOT NULL GROUP BY 1) h
    ON h.bin = g.bin"""


@register("profile_histogram", f"WITH {CLEAN_LI_SQL}\n" + S.union_all([_hist_part(c, 30) for c in MEAS]))
def profile_histogram(spark, sf):
    return rounded(profile.histogram(clean_lineitem(spark, sf), MEAS, bins=30))


# ---- P8 / P9 box statistics by nation -------------------------------------------

@register("profile_box_by_nation", f"""WITH {S.PANEL},
c AS (SELECT n_name, nullif(price, CAST(999.0 AS DOUBLE)) AS price FROM panel),
q AS (SELECT n_name, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS median,
             quantile_cont(price, 0.75) AS q3 FROM c WHERE price IS NOT NULL GROUP BY 1),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM q),
a AS (SELECT f.n_name, any_value(q1) AS q1, any_value(median) AS median, any_value(q3) AS q3,
             min(CASE WHEN price >= lo_f THEN price END) AS whisker_lo,
             max(CASE WHEN price <= hi_f THEN price END) AS whisker_hi,
             count_if(price < lo_f OR price > hi_f) AS n_fliers, count(*) AS n
      FROM c JOIN f ON c.n_name = f.n_name WHERE price IS NOT NULL GROUP BY 1)
SELECT n_name, {r('q1')} AS q1, {r('median')} AS median, {r('q3')} AS q3,
       {r('whisker_lo')} AS whisker_lo, {r('whisker_hi')} AS whisker_hi, n_fliers, n,
       {r('CASE WHEN q1 > 0 THEN log10(q1) END')} AS log10_q1,
       {r('CASE WHEN median > 0 THEN log10(median) END')} AS log10_median,
       {r('CASE WHEN q3 > 0 THEN log10(q3) END')} AS log10_q3,
       {r('CASE WHEN whisker_lo > 0 THEN log10(whisker_lo) END')} AS log10_whisker_lo,
       {r('CASE WHEN whisker_hi > 0 THEN log10(whisker_hi) END')} AS log10_whisker_hi
FROM a""")
def profile_box_by_nation(spark, sf):
    p = clean.sentinel_to_null(B.dirty_nation_day_panel(spark, sf), {"price": B.SENTINEL})
    return rounded(profile.five_number(p, "price", ["n_name"], log_scale=True))


# ---- P10 / P11 correlations -------------------------------------------------------

def _corr_part(a, b):
    xa = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN CAST({a} AS DOUBLE) END"
    xb = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN CAST({b} AS DOUBLE) END"
    den = f"sqrt(var_pop({xa}) * var_pop({xb}))"
    return (f"SELECT '{a}' AS col_a, '{b}' AS col_b, "
            f"CASE WHEN {den} > 0 THEN covar_pop({xa}, {xb}) / {den} END AS corr FROM cl")


_PAIRS = [(CORR_COLS[i], CORR_COLS[j]) for i in range(len(CORR_COLS)) for j in range(i + 1, len(CORR_COLS))]
CORR_SQL = f"WITH {CLEAN_LI_SQL},\ncm AS (" + S.union_all([_corr_part(a, b) for a, b in _PAIRS]) + ")\n"


@register("profile_corr_matrix", CORR_SQL + f"SELECT col_a, col_b, {r('corr')} AS corr FROM cm")
def profile_corr_matrix(spark, sf):
    return rounded(profile.corr_matrix(clean_lineitem(spark, sf), CORR_COLS))


@register("profile_top_corr_pairs", CORR_SQL + f"""SELECT col_a, col_b, {r('corr')} AS corr,
  {r('abs(corr)')} AS abs_corr FROM cm WHERE corr IS NOT NULL AND abs(corr) < 1
ORDER BY abs(corr) DESC, col_a, col_b LIMIT 10""")
def profile_top_corr_pairs(spark, sf):
    return rounded(profile.top_correlated_pairs(clean_lineitem(spark, sf), CORR_COLS, 10))


# ---- P13 / P14 / P15 ----------------------------------------------------------------

@register("profile_value_counts", f"""WITH {S.DIRTY_PRIORITY}
SELECT o_orderpriority, count(*) AS count FROM dord GROUP BY 1""")
def profile_value_counts(spark, sf):
    return profile.value_counts(B.dirty_orders_priority(spark, sf), "o_orderpriority")


@register("profile_distinct_nations", f"""WITH {S.PANEL_RAW}
SELECT DISTINCT n_name FROM panel_raw WHERE n_name IS NOT NULL""")
def profile_distinct_nations(spark, sf):
    return profile.distinct_sorted(B.nation_day_panel(spark, sf), "n_name")


KDE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
KDE_POINTS, KDE_CUT = 200, 3.0


def _kde_sql(cols, points=KDE_POINTS, cut=KDE_CUT):
    """Exact Gaussian KDE in SQL: Scott bandwidth, ``points`` grid points over
    [min - cut*bw, max + cut*bw], kernel summed over every non-missing row."""
    st = S.union_all([f"""SELECT '{c}' AS "column", count(x) AS n, stddev_samp(x) AS sd, min(x) AS lo,
        max(x) AS hi FROM (SELECT CAST({c} AS DOUBLE) AS x FROM cl)""" for c in cols])
    vals = S.union_all([f"""SELECT '{c}' AS "column", CAST({c} AS DOUBLE) AS v FROM cl WHERE {c} IS NOT NULL"""
                        for c in cols])
    return f"""WITH {CLEAN_LI_SQL},
st AS ({st}),
sp AS (SELECT "column", CAST(n AS DOUBLE) AS n, sd * pow(CAST(n AS DOUBLE), -0.2) AS bw, lo, hi
       FROM st WHERE n > 0 AND sd IS NOT NULL AND sd <> 0),
grid AS (SELECT "column", CAST(g.i AS INTEGER) AS point, n, bw,
                (lo - {cut} * bw) + ((hi + {cut} * bw) - (lo - {cut} * bw)) * g.i / {points - 1} AS x
         FROM sp, range({points}) g(i)),
vals AS ({vals}),
dens AS (SELECT grid."column", grid.point, grid.x,
                sum(exp(-0.5 * ((grid.x - vals.v) / grid.bw) * ((grid.x - vals.v) / grid.bw)))
                / (any_value(grid.n) * any_value(grid.bw) * sqrt(2 * pi())) AS density
         FROM grid JOIN vals ON grid."column" = vals."column" GROUP BY 1, 2, 3)
SELECT "column", point, {r('x')} AS x, {r('density')} AS density FROM dens"""


@register("profile_kde_grid", _kde_sql(KDE_COLS))
def profile_kde_grid(spark, sf):
    return rounded(profile.kde_grid(clean_lineitem(spark, sf), KDE_COLS, points=KDE_POINTS,
                                    cut=KDE_CUT, method="exact"))
