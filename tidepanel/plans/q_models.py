"""Model queries: linear (M6-M11, X6), k-means (M12-M19), trees.

Linear oracles use the two-feature closed form in SQL; k-means is checked in
SQL with centres that SQL can compute too (class means of the embeddings);
spark.ml fits are rows-only.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepanel.operators import encode, split
from tidepanel.operators.models import linear
from tidepanel.plans.catalog import r, register, rounded
from tidepanel.plans.q_impute import _LI_KEY_SQL, _LI_SPLIT_KEYS
from tidepanel.plans.q_profile import CLEAN_LI_SQL, clean_lineitem
from tidepanel.sources.tables import driver_table

X = ["l_quantity", "l_discount"]
Y = "l_extendedprice"
LI_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]


def _fold_sql(mod=5):
    return (f"CAST(CAST('0x' || substr(md5({_LI_KEY_SQL} || ':fold'), 1, 8) AS BIGINT) % {mod} AS INTEGER)")


def _test_sql():
    return f"CAST('0x' || substr(md5({_LI_KEY_SQL} || ':split'), 1, 8) AS BIGINT) % 10000 < 2000"


LIN_DATA_SQL = CLEAN_LI_SQL + f""",
ld AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
              l_quantity AS x1, l_discount AS x2, l_extendedprice AS y,
              {_fold_sql()} AS fold, {_test_sql()} AS is_test
       FROM cl WHERE l_quantity IS NOT NULL AND l_discount IS NOT NULL AND l_extendedprice IS NOT NULL)"""


def lin_data(spark, sf):
    d = clean_lineitem(spark, sf, [*X, Y]).select(*LI_KEYS, *X, Y)
    d = d.where(F.col(X[0]).isNotNull() & F.col(X[1]).isNotNull() & F.col(Y).isNotNull())
    d = split.kfold(d, _LI_SPLIT_KEYS, 5)
    return split.split_random(d, _LI_SPLIT_KEYS, 0.2)


def _coef_sql(src, alpha=0.0, group=None):
    g = f"{group}, " if group else ""
    gb = f" GROUP BY {group}" if group else ""
    return f"""SELECT {g}count(*) AS n, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my,
      var_pop(x1) * count(*) + {alpha} AS a11, covar_pop(x1, x2) * count(*) AS a12,
      var_pop(x2) * count(*) + {alpha} AS a22,
      covar_pop(x1, y) * count(*) AS s1, covar_pop(x2, y) * count(*) AS s2 FROM {src}{gb}"""


def _solve_sql(stats):
    return f"""SELECT *, (a22 * s1 - a12 * s2) / (a11 * a22 - a12 * a12) AS b1,
      (a11 * s2 - a12 * s1) / (a11 * a22 - a12 * a12) AS b2 FROM {stats}"""


def _coef_table_sql(alpha):
    return f"""WITH {LIN_DATA_SQL},
st AS ({_coef_sql('ld', alpha)}),
so AS ({_solve_sql('st')})
SELECT 'l_quantity' AS feature, {r('b1')} AS coefficient, {r('abs(b1)')} AS abs_coefficient FROM so
UNION ALL SELECT 'l_discount', {r('b2')}, {r('abs(b2)')} FROM so
UNION ALL SELECT '(intercept)', {r('my - b1 * m1 - b2 * m2')}, {r('abs(my - b1 * m1 - b2 * m2)')} FROM so"""


def _coef_table(spark, model, digits=6):
    c = model.coefficients(spark)
    b0 = model.intercept_in_raw_units()
    icpt = spark.createDataFrame([("(intercept)", b0, abs(b0))],
                                 "feature string, coefficient double, abs_coefficient double")
    return rounded(c.unionByName(icpt), digits)


@register("linear_gram_stats", f"""WITH {LIN_DATA_SQL},
z AS (SELECT fold, 1.0 AS z0, x1 AS z1, x2 AS z2, y AS z3 FROM ld)
""" + "\nUNION ALL\n".join(
    f"SELECT fold AS \"group\", {i} AS i, {j} AS j, {r(f'sum(CAST(z{i} AS DOUBLE) * z{j})')} AS value FROM z GROUP BY fold"
    for i in range(4) for j in range(i, 4)))
def linear_gram_stats(spark, sf):
    st = linear.gram_stats(lin_data(spark, sf), X, Y, by="fold")
    return rounded(st)


@register("linear_ols_coefficients", _coef_table_sql(0.0))
def linear_ols_coefficients(spark, sf):
    m = linear.fit_linear(lin_data(spark, sf), X, Y)
    return _coef_table(spark, m)


@register("linear_ridge_coefficients", _coef_table_sql(3.0))
def linear_ridge_coefficients(spark, sf):
    m = linear.fit_linear(lin_data(spark, sf), X, Y, alpha=3.0)
    return _coef_table(spark, m)


@register("linear_predictions", f"""WITH {LIN_DATA_SQL},
st AS ({_coef_sql('(SELECT * FROM ld WHERE NOT is_test)')}),
so AS ({_solve_sql('st')})
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, {r('y')} AS actual,
  {r('so.my + b1 * (x1 - so.m1) + b2 * (x2 - so.m2)')} AS predicted,
  {r('y - (so.my + b1 * (x1 - so.m1) + b2 * (x2 - so.m2))')} AS residual
FROM ld, so WHERE is_test""")
def linear_predictions(spark, sf):
    d = lin_data(spark, sf)
    m = linear.fit_linear(d.where(~F.col("is_test")), X, Y)
    return rounded(linear.predictions_table(m, d.where(F.col("is_test")), Y, LI_KEYS))


@register("linear_cv_ols", f"""WITH {LIN_DATA_SQL},
fo AS (SELECT CAST(range AS INTEGER) AS f FROM range(5)),
tr AS (SELECT fo.f, ld.* FROM ld JOIN fo ON ld.fold <> fo.f),
st AS ({_coef_sql('tr', 0.0, 'f')}),
so AS ({_solve_sql('st')}),
pr AS (SELECT ld.fold, ld.y, so.my + b1 * (x1 - so.m1) + b2 * (x2 - so.m2) AS p FROM ld JOIN so ON ld.fold = so.f)
SELECT fold, count(*) AS n, {r('avg((y - p) ^ 2)')} AS mse, {r('sqrt(avg((y - p) ^ 2))')} AS rmse,
  {r('avg(abs(y - p))')} AS mae, {r('1 - sum((y - p) ^ 2) / (var_pop(y) * count(*))')} AS r2
FROM pr GROUP BY fold""")
def linear_cv_ols(spark, sf):
    return rounded(linear.cross_validate(lin_data(spark, sf), X, Y, "fold", 5))


def _poly2_sql(digits):
    """Normal equations of the degree-2 terms, by elimination and back substitution."""
    column = {X[0]: "x1", X[1]: "x2"}
    terms = encode.polynomial_terms(X, 2)
    k = len(terms)
    upper = [(i, j) for i in range(k) for j in range(i, k)]
    ctes = ["tm AS (SELECT " + ", ".join(
        " * ".join(f"CAST({column[f]} AS DOUBLE)" for f in facs) + f" AS t{i}" for i, (_, facs) in enumerate(terms))
        + ", CAST(y AS DOUBLE) AS y FROM ld)",
        "e0 AS (SELECT avg(y) AS my, " + ", ".join(f"avg(t{i}) AS m{i}, covar_pop(t{i}, y) AS s{i}" for i in range(k))
        + ", " + ", ".join(f"covar_pop(t{i}, t{j}) AS a{i}{j}" for i, j in upper) + " FROM tm)"]
    for p in range(k - 1):  # the rows below p without term p
        new = [f"a{i}{j} - a{p}{i} * a{p}{j} / a{p}{p} AS a{i}{j}" for i, j in upper if i > p]
        new += [f"s{i} - a{p}{i} * s{p} / a{p}{p} AS s{i}" for i in range(p + 1, k)]
        ctes.append(f"e{p + 1} AS (SELECT * REPLACE ({', '.join(new)}) FROM e{p})")
    before = f"e{k - 1}"
    for i in reversed(range(k)):
        known = "".join(f" - a{i}{j} * b{j}" for j in range(i + 1, k))
        ctes.append(f"b{i}t AS (SELECT *, (s{i}{known}) / a{i}{i} AS b{i} FROM {before})")
        before = f"b{i}t"
    out = [(name, f"b{i}") for i, (name, _) in enumerate(terms)]
    out.append(("(intercept)", "my" + "".join(f" - b{i} * m{i}" for i in range(k))))
    return f"WITH {LIN_DATA_SQL},\n" + ",\n".join(ctes) + "\n" + "\nUNION ALL ".join(
        f"SELECT '{name}' AS feature, {r(b, digits)} AS coefficient, {r(f'abs({b})', digits)} AS abs_coefficient "
        f"FROM {before}" for name, b in out)


@register("linear_poly2_coefficients", _poly2_sql(3))
def linear_poly2_coefficients(spark, sf):
    d = encode.polynomial(lin_data(spark, sf), X, 2)
    names = [n for n, _ in encode.polynomial_terms(X, 2)]
    m = linear.fit_linear(d, names, Y)
    return _coef_table(spark, m, 3)


@register("linear_onehot_predictions", """WITH t AS (SELECT o.o_orderkey, n.n_name, o.o_totalprice
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey)
SELECT o_orderkey, """ + r('avg(o_totalprice) OVER (PARTITION BY n_name) - avg(o_totalprice) OVER ()', 4)
          + " AS nation_effect FROM t")
def linear_onehot_predictions(spark, sf):
    """Least squares on the dummies of 25 nations (rank-deficient with the intercept):
    the prediction is the nation's mean. Shown as its distance from the mean of
    all orders: a mean of cents may end in a 5 at any digit, where engines round apart."""
    nation = driver_table(spark, sf, "nation").select("n_nationkey", "n_name")
    t = driver_table(spark, sf, "orders").join(
        driver_table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(
        F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey")).select(
        "o_orderkey", "n_name", "o_totalprice")
    levels = sorted(x["n_name"] for x in nation.collect())
    d = encode.one_hot(t, "n_name", levels=levels)
    m = linear.fit_linear(d, [f"n_name_{v}" for v in levels], "o_totalprice")
    overall = t.agg(F.avg("o_totalprice")).first()[0]
    return rounded(m.predict(d, "predicted").select(
        "o_orderkey", (F.col("predicted") - F.lit(overall)).alias("nation_effect")), 4)


# ---- k-means / PCA on the embeddings -------------------------------------------

from tidepanel.operators.models import cluster  # noqa: E402

EMB_DIM = 64
EMB_LONG_SQL = """el AS (SELECT vec_id, label, i, CAST(embedding[i] AS DOUBLE) AS v
        FROM (SELECT vec_id, label, embedding, generate_subscripts(embedding, 1) AS i FROM embeddings)),
lab AS (SELECT label, CAST(dense_rank() OVER (ORDER BY label) - 1 AS INTEGER) AS cluster FROM (SELECT DISTINCT label FROM embeddings)),
ce AS (SELECT lab.cluster, i, avg(v) AS m FROM el JOIN lab ON el.label = lab.label GROUP BY 1, 2),
dist AS (SELECT el.vec_id, ce.cluster, sum((el.v - ce.m) * (el.v - ce.m)) AS d FROM el JOIN ce ON el.i = ce.i GROUP BY 1, 2),
best AS (SELECT vec_id, cluster, d FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) AS rk FROM dist) WHERE rk = 1)"""


def embeddings(spark, sf):
    return driver_table(spark, sf, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))


def assigned_by_class_means(spark, sf):
    e = embeddings(spark, sf)
    centres = cluster.class_means(e, "x", "label")
    return cluster.assign(e, "x", centres)


@register("kmeans_assign_class_means", f"""WITH {EMB_LONG_SQL}
SELECT vec_id, cluster, {r('d')} AS sq_dist FROM best""")
def kmeans_assign_class_means(spark, sf):
    return rounded(assigned_by_class_means(spark, sf).select("vec_id", "cluster", "sq_dist"))


@register("kmeans_inertia_class_means", f"""WITH {EMB_LONG_SQL}
SELECT {r('sum(d)')} AS inertia, count(*) AS n FROM best""")
def kmeans_inertia_class_means(spark, sf):
    a = assigned_by_class_means(spark, sf)
    return rounded(a.agg(F.sum("sq_dist").alias("inertia"), F.count(F.lit(1)).alias("n")))


@register("kmeans_attach_cluster", f"""WITH {EMB_LONG_SQL}
SELECT b.vec_id, e.label, b.cluster FROM best b JOIN embeddings e ON b.vec_id = e.vec_id""")
def kmeans_attach_cluster(spark, sf):
    return assigned_by_class_means(spark, sf).select("vec_id", "label", "cluster")


@register("kmeans_cluster_profile", f"""WITH {EMB_LONG_SQL}
SELECT b.cluster, count(*) AS n, {', '.join(r(f'avg(CAST(e.embedding[{i + 1}] AS DOUBLE))') + f' AS mean_x{i}' for i in range(EMB_DIM))}
FROM best b JOIN embeddings e ON b.vec_id = e.vec_id GROUP BY 1""")
def kmeans_cluster_profile(spark, sf):
    a = assigned_by_class_means(spark, sf).withColumns(
        {f"x{i}": F.col("x")[i] for i in range(EMB_DIM)})
    return rounded(cluster.cluster_profile(a, "cluster", [f"x{i}" for i in range(EMB_DIM)]))


def _lloyd_sql(steps):
    """Lloyd iterations from the class means, unrolled."""
    ctes, before = [], "ce"
    for t in range(1, steps + 1):
        ctes.append(f"""ds{t} AS (SELECT el.vec_id, c.cluster, sum((el.v - c.m) * (el.v - c.m)) AS d
  FROM el JOIN {before} c ON el.i = c.i GROUP BY 1, 2),
as{t} AS (SELECT vec_id, cluster FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) AS rk
  FROM ds{t}) WHERE rk = 1),
ce{t} AS (SELECT a.cluster, el.i, avg(el.v) AS m FROM as{t} a JOIN el ON a.vec_id = el.vec_id GROUP BY 1, 2)""")
        before = f"ce{t}"
    return f"""WITH {EMB_LONG_SQL},
{', '.join(ctes)}
SELECT cluster, CAST(i - 1 AS INTEGER) AS i, {r('m')} AS value FROM {before}"""


@register("kmeans_lloyd_steps", _lloyd_sql(3))
def kmeans_lloyd_steps(spark, sf):
    import numpy as np
    e = embeddings(spark, sf)
    start = {0: np.array(cluster.class_means(e, "x", "label"))}
    res = cluster.batched_lloyd(e, "x", [(len(start[0]), 0)], max_iter=3, tol=0.0, start=start)[0]
    rows = [(c, i, float(v)) for c, centre in enumerate(res.centres) for i, v in enumerate(centre)]
    return rounded(spark.createDataFrame(rows, "cluster int, i int, value double"))


@register("kmeans_fit_centres")
def kmeans_fit_centres(spark, sf):
    e = embeddings(spark, sf)
    res = cluster.kmeans(e, "x", 10, restarts=10, seed=42)
    return rounded(cluster.centres_table(spark, res.centres, [f"x{i}" for i in range(len(res.centres[0]))]))


@register("kmeans_sweep")
def kmeans_sweep(spark, sf):
    table, _ = cluster.kmeans_sweep(embeddings(spark, sf), "x", range(2, 13), restarts=10, seed=42)
    return rounded(table)


@register("pca_2d")
def pca_2d(spark, sf):
    rows, _, _, _ = cluster.pca_2d(embeddings(spark, sf), "x", keep=["vec_id", "label"])
    return rounded(rows)


# ---- decision trees on the rise-level panel ---------------------------------------

from tidepanel.operators import derive  # noqa: E402
from tidepanel.operators.models import tree  # noqa: E402
from tidepanel.plans.q_derive import LABEL_SQL, NEXT_SQL, next_panel  # noqa: E402

RISE = list(derive.RISE_LABELS)
TREE_NUM = ["price", "n_orders", "d_ordinal"]


def rise_panel(spark, sf):
    """Labelled panel with the train/test split (stratified) and folds."""
    p = derive.bin_labels(next_panel(spark, sf), "price_change_pct", "rise_level")
    p = derive.add_date_ordinal(p, "d", "d_ordinal").where(F.col("rise_level").isNotNull())
    p = split.split_stratified(p, ["n_name", "d"], "rise_level", 0.2)
    return split.stratified_kfold(p, ["n_name", "d"], "rise_level", 5)


def tree_frame(spark, sf):
    p = rise_panel(spark, sf)
    train = p.where(~F.col("is_test"))
    plan = encode.FeaturePlan(numeric=TREE_NUM, categorical=["n_name"], imputer="median", scaler=None,
                              keep=["n_name_raw", "d", "rise_level", "is_test", "fold"])
    p2 = p.withColumn("n_name_raw", F.col("n_name"))
    fitted = plan.fit(train)
    feats = fitted.transform(p2)
    frame = tree.prepare(feats, fitted.feature_names, "rise_level", RISE,
                         keep=["n_name_raw", "d", "is_test", "fold"])
    return frame, fitted.feature_names


_SPLIT_KEY = "rise_level || ':' || n_name || ':' || CAST(d AS VARCHAR) || ':split'"


@register("tree_class_weights", f"""WITH {NEXT_SQL},
lb AS (SELECT n_name, d, {LABEL_SQL} AS rise_level FROM ch),
tr AS (SELECT * FROM lb WHERE rise_level IS NOT NULL
       AND CAST('0x' || substr(md5({_SPLIT_KEY}), 1, 8) AS BIGINT) % 10000 >= 2000),
c AS (SELECT rise_level, count(*) AS n FROM tr GROUP BY 1)
SELECT rise_level, {r('(SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * n)')} AS weight FROM c""")
def tree_class_weights(spark, sf):
    train = rise_panel(spark, sf).where(~F.col("is_test"))
    w = tree.class_weights(train, "rise_level")
    return rounded(spark.createDataFrame(sorted(w.items()), "rise_level string, weight double"))


def _fixed_fit(spark, sf):
    frame, names = tree_frame(spark, sf)
    train = frame.where(~F.col("is_test"))
    model = tree.fit(train, impurity="gini", max_depth=5, min_leaf=5)
    return model, names, frame


@register("tree_feature_importance")
def tree_feature_importance(spark, sf):
    model, names, _ = _fixed_fit(spark, sf)
    return rounded(tree.importances(model, names, spark, top=10))


@register("tree_nodes")
def tree_nodes(spark, sf):
    model, names, _ = _fixed_fit(spark, sf)
    return rounded(tree.node_frame(tree.node_table(model, spark), names, RISE, spark, max_depth=4))


@register("tree_rules")
def tree_rules(spark, sf):
    model, names, _ = _fixed_fit(spark, sf)
    return tree.rules(tree.node_table(model, spark), names, RISE, spark)


@register("tree_thresholds")
def tree_thresholds(spark, sf):
    model, names, _ = _fixed_fit(spark, sf)
    return tree.thresholds(tree.node_frame(tree.node_table(model, spark), names, RISE, spark))


@register("tree_grid_search")
def tree_grid_search(spark, sf):
    frame, _ = tree_frame(spark, sf)
    res = tree.grid_search(frame.where(~F.col("is_test")), "fold", RISE)
    return rounded(res.table)
