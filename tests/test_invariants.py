"""Invariants for operators that have no exact oracle, and layout independence."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepanel.operators import encode, metrics, quantiles, split
from tidepanel.operators.models import cluster, linear, tree
from tidepanel.plans import bindings as B

SF = "/root/testdata/sf0.001"


def test_exact_quantiles_window_path_matches_numpy(spark):
    # accuracy far below n forces the approximate-window + selection path
    rng = np.random.RandomState(0)
    vals = np.concatenate([rng.normal(size=3000), np.full(1500, 0.25), rng.exponential(size=500)])
    df = spark.createDataFrame([(float(v), int(i % 3)) for i, v in enumerate(vals)], "x double, g int")
    qs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = quantiles.quantile_values(df, ["x"], qs, accuracy=50)
    for q in qs:
        assert got[("x", q)] == pytest.approx(float(np.quantile(vals, q)), abs=1e-12)
    grouped = {(r["g"], r["q"]): r["value"] for r in quantiles.quantiles(df, ["x"], qs, ["g"], accuracy=50).collect()}
    for g in range(3):
        sub = vals[np.arange(len(vals)) % 3 == g]
        for q in qs:
            assert grouped[(g, q)] == pytest.approx(float(np.quantile(sub, q)), abs=1e-12)


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_layout_independence_of_panel_fill(spark, parts):
    from tidepanel.operators import impute
    p = B.dirty_nation_day_panel(spark, SF)
    p = p.withColumn("price", F.nullif("price", F.lit(999.0)))
    base = impute.interpolate_linear(p, B.PANEL_SPEC, ["price"])
    shuffled = impute.interpolate_linear(p.repartition(parts).orderBy(F.rand(7)), B.PANEL_SPEC, ["price"])
    cols = ["n_name", "d", "price"]
    assert base.select(cols).exceptAll(shuffled.select(cols)).count() == 0
    assert shuffled.count() == base.count()


def test_folds_partition_and_split_disjoint(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    f = split.kfold(o, ["o_orderkey"], 5)
    assert f.where(F.col("fold").isNull()).count() == 0
    assert f.groupBy("fold").count().count() == 5
    assert f.count() == o.count()
    s = split.split_random(o, ["o_orderkey"], 0.2)
    tr, te = s.where("NOT is_test"), s.where("is_test")
    assert tr.join(te, "o_orderkey").count() == 0
    assert tr.count() + te.count() == o.count()
    # stable under repartitioning
    s2 = split.split_random(o.repartition(7), ["o_orderkey"], 0.2)
    assert s.select("o_orderkey", "is_test").exceptAll(s2.select("o_orderkey", "is_test")).count() == 0


def test_ols_decomposition_and_closed_form(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    x = ["l_quantity", "l_discount", "l_tax"]
    m = linear.fit_linear(li, x, "l_extendedprice")
    pred = linear.predictions_table(m, li, "l_extendedprice")
    v = metrics.variance_decomposition(pred, "actual", "predicted").first()
    assert v["sst"] == pytest.approx(v["sse"] + v["ssr"], rel=1e-9)
    pdf = li.select(*x, "l_extendedprice").toPandas()
    X = np.column_stack([np.ones(len(pdf)), pdf[x].to_numpy()])
    beta = np.linalg.lstsq(X, pdf["l_extendedprice"].to_numpy(), rcond=None)[0]
    assert m.intercept_in_raw_units() == pytest.approx(beta[0], rel=1e-8)
    assert np.allclose(m.coef, beta[1:], rtol=1e-8)
    # ridge against its closed form on centred data
    r = linear.fit_linear(li, x, "l_extendedprice", alpha=3.0)
    Xc = pdf[x].to_numpy() - pdf[x].to_numpy().mean(0)
    yc = pdf["l_extendedprice"].to_numpy() - pdf["l_extendedprice"].mean()
    rb = np.linalg.solve(Xc.T @ Xc + 3.0 * np.eye(3), Xc.T @ yc)
    assert np.allclose(r.coef, rb, rtol=1e-8)


def test_robust_scaled_train_has_median_0_iqr_1(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    s = encode.robust_scale(li, ["l_extendedprice"])
    q = quantiles.quantile_values(s, ["l_extendedprice"], [0.25, 0.5, 0.75])
    assert q[("l_extendedprice", 0.5)] == pytest.approx(0.0, abs=1e-12)
    assert q[("l_extendedprice", 0.75)] - q[("l_extendedprice", 0.25)] == pytest.approx(1.0, rel=1e-12)


def test_kmeans_inertia_not_increasing_and_scores(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet").select(
        F.col("embedding").cast("array<double>").alias("x"))
    table, fits = cluster.kmeans_sweep(e, "x", range(2, 6), restarts=4)
    rows = sorted(table.collect(), key=lambda r: r["n_clusters"])
    inert = [r["inertia"] for r in rows]
    assert all(a >= b - 1e-9 for a, b in zip(inert, inert[1:]))
    lab = cluster.assign(e, "x", fits[3].centres)
    sil = metrics.silhouette_sq_euclidean(lab, "x", "cluster").first()[0]
    assert rows[1]["silhouette_score"] == pytest.approx(sil, abs=1e-9)


def test_tree_cut_equals_shallow_fit(spark):
    """A tree cut at depth 3 predicts like a depth-3 fit (greedy splits)."""
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    labels = ["A", "N", "R"]
    frame = tree.prepare(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "l_returnflag", labels)
    deep = tree.fit(frame, max_depth=8, min_leaf=5)
    shallow = tree.fit(frame, max_depth=3, min_leaf=5)
    nodes = tree.node_table(deep, spark)
    cut = tree.predict_with_cut(deep, frame, nodes, 3, 2, labels).select("predicted")
    direct = shallow.transform(frame).select(
        F.element_at(F.array(*[F.lit(v) for v in labels]), F.col("prediction").cast("int") + 1).alias("predicted"))
    a = [r[0] for r in cut.collect()]
    b = [r[0] for r in direct.collect()]
    assert a == b


def test_macro_f1_equals_report(spark):
    from tidepanel.plans.q_metrics import flag_rule
    fr = flag_rule(spark, SF)
    rep = {r["label"]: r for r in metrics.classification_report(fr, "actual", "predicted", ["A", "N", "R"]).collect()}
    assert metrics.macro_f1(fr, "actual", "predicted", ["A", "N", "R"]).first()[0] == pytest.approx(rep["macro avg"]["f1"])


def test_one_pass_sweep_equals_refits(spark):
    from tidepanel.operators import derive
    from tidepanel.operators.models import search
    from tidepanel.plans.q_workflows import next_step_base
    d = derive.add_date_ordinal(next_step_base(spark, SF), "d", "d_ordinal")
    d = split.kfold(split.split_random(d, ["n_name", "d"], 0.2), ["n_name", "d"], 5)
    sets = {"all": ["price", "n_orders", "d_ordinal", "n_name"], "numeric": ["price", "d_ordinal"]}
    fast, _ = search.model_sweep(d, sets, "next_price_change", categorical=["n_name"], scalers=("standard", "robust"))
    slow, _ = search.model_sweep(d, sets, "next_price_change", categorical=["n_name"], refit=True)
    a = {tuple(r[:4]): r for r in fast.collect()}
    b = {tuple(r[:4]): r for r in slow.collect()}
    assert a.keys() == b.keys() and len(a) == 8
    for key in a:
        for c in ["CV_MAE", "CV_RMSE", "CV_R2", "Test_MAE", "Test_MSE", "Test_RMSE", "Test_R2"]:
            assert a[key][c] == pytest.approx(b[key][c], rel=1e-6, abs=1e-9), (key, c)


def test_one_pass_sweep_equals_refits_at_degree_2(spark):
    from tidepanel.operators.models import search
    # a large offset, missing values in both kinds of column, levels apart per set
    d = spark.range(600).select(
        F.col("id").alias("k"), (F.col("id") % 5).cast("int").alias("fold"), (F.col("id") % 7 == 0).alias("is_test"),
        F.when(F.col("id") % 11 != 0, 739000 + F.hash("id") % 700).cast("double").alias("a"),
        F.when(F.col("id") % 13 != 0, F.hash("id", F.lit(1)) % 40).cast("double").alias("b"),
        F.when(F.col("id") % 17 != 0, F.concat(F.lit("L"), F.pmod(F.hash("id", F.lit(2)), F.lit(3)))).alias("c"))
    d = d.withColumn("y", F.coalesce(F.col("b"), F.lit(1.0)) * (F.col("a") - 739000) / 50
                     + F.when(F.col("c") == "L1", F.col("b")).otherwise(3.0) + F.hash("k", F.lit(3)) % 10)
    d = d.withColumn("y", F.coalesce("y", F.lit(2.0)))
    sets = {"all": ["a", "b", "c"], "one": ["b"]}
    fast, models = search.model_sweep(d, sets, "y", categorical=["c"], degrees=(1, 2))
    slow, refits = search.model_sweep(d, sets, "y", categorical=["c"], degrees=(2,), refit=True)
    a = {tuple(r[:5]): r for r in fast.collect()}
    b = {tuple(r[:5]): r for r in slow.collect()}
    assert len(a) == 16 and b.keys() == {key for key in a if key[3] == 2} and len(b) == 8
    assert {key[4] for key in b} == {"PolynomialRegression"}
    for key in b:
        for c in ["CV_MAE", "CV_RMSE", "CV_R2", "Test_MAE", "Test_MSE", "Test_RMSE", "Test_R2"]:
            assert a[key][c] == pytest.approx(b[key][c], rel=1e-6, abs=1e-9), (key, c)
    for key in refits:
        assert models[key][1].features == refits[key][1].features
        assert models[key][1].coef == pytest.approx(refits[key][1].coef, rel=1e-5, abs=1e-6), key
    best = {key[:4]: a[key]["CV_RMSE"] for key in a}
    assert best["all", "mean", "standard", 2] < best["all", "mean", "standard", 1]


def test_fact_tables_are_not_broadcast_from_estimates(spark):
    # the planner must not pick a broadcast for lineitem / orders from size
    # estimates; only the proven-small nation table is broadcast statically
    plan = B.market_panel(spark, SF)._jdf.queryExecution().executedPlan().toString()
    blocks = plan.split("BroadcastExchange")[1:]
    assert blocks, plan
    for b in blocks:
        scan = b[b.find("FileScan"):b.find("FileScan") + 300]
        assert "lineitem" not in scan and "orders" not in scan, scan


def test_kmeans_reports_the_centres_it_found(spark):
    from tidepanel.operators.models import cluster
    df = spark.createDataFrame([([0.0, 0.0],), ([0.0, 0.0],), ([5.0, 5.0],), ([9.0, 0.0],)],
                               "x array<double>")
    res = cluster.kmeans(df, "x", 5, restarts=3)
    assert res.k == len(res.centres) == 3 and res.cost < 1e-9
    table, fits = cluster.kmeans_sweep(df, "x", range(2, 6), restarts=2)
    assert {r.n_clusters for r in table.collect()} == set(fits) == {2, 3}


def test_kmeans_seeding_on_a_large_offset(spark):
    rows = [([1e6 + 20.0 * (i % 4) + (i % 3), 2e6 - 20.0 * (i % 4)],) for i in range(240)]
    df = spark.createDataFrame(rows, "x array<double>").repartition(3)
    res = cluster.kmeans(df, "x", 4, restarts=3)
    assert [round(c[0]) for c in res.centres] == [1_000_001, 1_000_021, 1_000_041, 1_000_061]


def test_kmeans_seeding_finds_separated_groups(spark):
    import numpy as np
    from tidepanel.operators.models import cluster
    rng = np.random.default_rng(4)
    centres = rng.uniform(-50, 50, (6, 3))
    rows = [((centres[i % 6] + rng.normal(0, 0.1, 3)).tolist(),) for i in range(600)]
    res = cluster.kmeans(spark.createDataFrame(rows, "x array<double>").repartition(5), "x", 6, restarts=4)
    assert all(min(np.abs(np.array(c) - true).max() for c in res.centres) < 0.2 for true in centres)


def test_kmeans_pass_over_packed_blocks(spark):
    """a pass reads whole blocks, dealt evenly, and every task returns one vector."""
    import numpy as np
    from tidepanel.operators.models import cluster
    rng = np.random.default_rng(9)
    X = np.round(rng.normal(0, 2, (5000, 3)))  # a lattice: many equal distances
    models = {0: X[:2], 1: X[2:7], 2: X[7:9], 3: np.concatenate([X[9:11], X[9:10]])}
    uneven = spark.createDataFrame([(x.tolist(),) for x in X], "x array<double>").repartition(3).coalesce(2)
    got = {}
    for parts in (1, 40):  # sums of few tasks, and of more than the driver adds
        blocks = cluster._packed(uneven.repartition(parts), "x")
        tasks = blocks.rdd.getNumPartitions()
        assert tasks >= parts and tasks % spark.sparkContext.defaultParallelism == 0
        rows = blocks.collect()
        assert sum(r.n for r in rows) == len(X) and max(r.n for r in rows) <= cluster.BLOCK_ROWS
        assert all(len(r.x) == r.n * 3 * 8 for r in rows)
        assert (parts == 40) == (tasks > cluster.FEW_PARTS)
        got[parts] = cluster._lloyd_sums(blocks, models, tasks)
        blocks.unpersist()
    for m, C in models.items():
        d = ((X[:, None] - C[None]) ** 2).sum(2)
        for n, sums, cost in (got[1][m], got[40][m]):
            assert n.sum() == len(X) and cost == pytest.approx(d.min(1).sum())
            assert np.allclose(sums.sum(0), X.sum(0))
            sure = [(np.isclose(d, d.min(1)[:, None])[:, c] & (np.isclose(d, d.min(1)[:, None]).sum(1) == 1)).sum()
                    for c in range(len(C))]
            near = np.isclose(d, d.min(1)[:, None]).sum(0)
            assert all(a <= b <= c for a, b, c in zip(sure, n, near))
    assert got[1][3][0][2] == 0  # of equal centres the first has the rows


def test_kmeans_marks_one_nearest_centre():
    import numpy as np
    from tidepanel.operators.models import cluster
    d = np.array([[1.0, 2.0, 3.0], [1.0, 1.0, np.nan], [4.0, 1.0, 0.0]])
    mark = np.empty(d.shape)
    least = cluster._mark_nearest(d, mark)
    assert mark.tolist() == [[1, 0, 0], [0, 1, 1], [0, 0, 0]]
    assert least[:2].tolist() == [1.0, 1.0] and np.isnan(least[2])


def test_moments_at_any_width(spark):
    import numpy as np
    from tidepanel.operators.models import linear
    rng = np.random.default_rng(8)
    x = rng.normal(1e4, 3, (400, 80))
    y = x @ rng.normal(size=80) + 5
    names = [f"f{i}" for i in range(80)]
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], [*names, "y"])
    m = linear.fit_linear(df, names, "y")
    want = np.linalg.lstsq(np.c_[np.ones(400), x], y, rcond=None)[0]
    assert np.allclose(m.coef, want[1:], atol=1e-6)


def test_report_accuracy_equals_accuracy(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "z"), (None, "a"), ("b", None), ("b", "b")],
                               "y string, p string")
    rep = {r.label: r for r in metrics.classification_report(df, "y", "p", ["a", "b"]).collect()}
    assert rep["accuracy"].f1 == metrics.accuracy(df, "y", "p").first().accuracy == 0.4
    assert rep["accuracy"].support == 5 and rep["(missing)"].support == 1 and "z" in rep


def test_ungrouped_quantiles_exchange_no_data_rows(spark, monkeypatch):
    import numpy as np
    vals = np.random.default_rng(2).integers(0, 400, 6000).astype(float).tolist() + [float("nan"), None]
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(6)
    monkeypatch.setattr(quantiles, "MOST_IN_WINDOW", 50)
    out = quantiles.quantiles(df, ["x"], [0.1, 0.5, 0.77], accuracy=40)
    clean = np.array(vals[:-2])
    for r in out.collect():
        assert abs(r["value"] - np.quantile(clean, r["q"])) < 1e-12
    # the only exchanges below the running sum carry counts per distinct value
    plan = out._jdf.queryExecution().sparkPlan().toString()
    scans = plan[plan.index("Generate"):]
    assert "Exchange" not in scans.replace("Exchange RoundRobinPartitioning", "")


def test_exact_stratification_counts(spark):
    rows = [(i, "rare" if i % 97 == 0 else "common" if i % 2 else None) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, y string")
    for r in split.split_stratified_exact(df, ["id"], "y", 0.2).groupBy("y").pivot("is_test").count().collect():
        n = (r["true"] or 0) + (r["false"] or 0)
        assert r["true"] == round(0.2 * n)
    folds = split.stratified_kfold_exact(df, ["id"], "y", 5).groupBy("y", "fold").count().collect()
    for y in ("rare", "common", None):
        sizes = [r["count"] for r in folds if r["y"] == y]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_missing_columns_are_named(spark):
    """the fill and the target name every required column that a table lacks."""
    from tidepanel.operators import derive, impute
    from tidepanel.spec import PanelSpec
    df, spec = spark.createDataFrame([(1, 2.0)], "e int, v double"), PanelSpec("e", "t")
    with pytest.raises(ValueError, match=r"\['t', 'w'\]"):
        impute.time_series_fill(df, spec, ["v", "w"])
    with pytest.raises(ValueError, match=r"\['t'\]"):
        derive.next_step_change(df, spec, "v")


def test_box_without_values_has_all_columns(spark):
    from tidepanel.operators import profile
    none = spark.createDataFrame([], "v double")
    some = spark.createDataFrame([(1.0,), (2.0,)], "v double")
    for log_scale in (False, True):
        empty = profile.five_number(none, "v", log_scale=log_scale)
        assert empty.count() == 0
        assert empty.columns == profile.five_number(some, "v", log_scale=log_scale).columns
