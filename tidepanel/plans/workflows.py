"""End-to-end workflows (Q1-Q8) composed from the operators.

Each returns a dict of lazy result DataFrames (plus small fitted values);
``run_all`` writes them and checks the outputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.operators import clean, derive, encode, impute, metrics, profile, split
from tidepanel.operators.models import cluster, linear, search, tree
from tidepanel.session import cut_lineage
from tidepanel.sources import sinks
from tidepanel.spec import PanelSpec, numeric_columns


def profile_panel(raw: DataFrame, cleaned: DataFrame, *, entity: str, measure: str,
                  label_col: str, labels, bins: int = 30, tables=None) -> dict:
    """Q1: missing values before/after cleaning, description, class counts,
    histograms, correlations and the per-entity spread of one measure. ``tables``: the
    names of those to make (all, if None)."""
    num = numeric_columns(cleaned)

    def missing():
        before, after = (profile.missing_counts(t).withColumnRenamed("missing_count", f"missing_{name}")
                         for t, name in ((raw, "raw"), (cleaned, "cleaned")))
        return before.join(after, "column", "full_outer")

    makers = {
        "missing": missing,
        "describe_raw": lambda: profile.describe_numeric(raw),
        "class_counts": lambda: profile.class_distribution(cleaned, label_col, labels),
        "histograms": lambda: profile.histogram(cleaned, num, bins),
        "correlations": lambda: profile.corr_matrix(cleaned, num),
        "box_by_entity": lambda: profile.five_number(cleaned, measure, [entity], log_scale=True),
    }
    return {name: makers[name]() for name in (makers if tables is None else tables)}


def classify(labelled: DataFrame, *, numeric, categorical, label: str, labels, key_cols,
             test_fraction: float = 0.2, grid: dict | None = None) -> dict:
    """Q2: split and folds stratified with exact counts of every class, feature plan fitted
    on train, shared-fit grid search by macro F1, refit, test report/confusion,
    importances, node table, CV accuracy of the chosen setting."""
    # the panel is made once: thresholds, fitted statistics, fits and scores all read it
    data = cut_lineage(labelled.where(F.col(label).isNotNull()))
    data = split.split_stratified_exact(data, key_cols, label, test_fraction)
    data = split.stratified_kfold_exact(data, key_cols, label, 5)
    train = data.where(~F.col("is_test"))
    plan = encode.FeaturePlan(numeric=list(numeric), categorical=list(categorical), imputer="median",
                              scaler=None, keep=[label, "is_test", "fold"])
    fp = plan.fit(train)
    frame = tree.prepare(fp.transform(data), fp.feature_names, label, labels, keep=["is_test", "fold"])
    res = tree.grid_search(frame.where(~F.col("is_test")), "fold", labels, **(grid or {}))
    b = res.best
    model = tree.fit(frame.where(~F.col("is_test")), impurity=b["criterion"], max_depth=b["max_depth"],
                     min_leaf=b["min_leaf"], balanced=(b["class_weight"] == "balanced"))
    spark = data.sparkSession
    nodes = tree.node_table(model, spark)
    test = tree.predict_with_cut(model, frame.where(F.col("is_test")), nodes, b["max_depth"],
                                 b["min_split"], labels).select(F.col("_label_raw").alias("actual"), "predicted")
    return {
        "grid": res.table,
        "best": b,
        "report": metrics.classification_report(test, "actual", "predicted", labels),
        "confusion": metrics.confusion_matrix(test, "actual", "predicted", labels),
        "accuracy": metrics.accuracy(test, "actual", "predicted"),
        "importances": tree.importances(model, fp.feature_names, spark, top=10),
        "nodes": tree.node_frame(nodes, fp.feature_names, labels, spark, max_depth=4),
        "rules": tree.rules(nodes, fp.feature_names, labels, spark),
        "depth": tree.tree_depth(nodes),
        "cv_accuracy": res.fold_accuracy,
    }


def regress(df: DataFrame, *, numeric, categorical, target: str, key_cols, alpha: float = 3.0,
            test_fraction: float = 0.2) -> dict:
    """Q3: rows with a target, random split, feature plan on train, ridge,
    test metrics, variance decomposition, trend line, coefficients, predictions."""
    data = split.split_random(df.where(F.col(target).isNotNull()), key_cols, test_fraction)
    train = data.where(~F.col("is_test"))
    plan = encode.FeaturePlan(numeric=list(numeric), categorical=list(categorical), imputer="median",
                              scaler="robust", keep=[*key_cols, target, "is_test"])
    fp = plan.fit(train)
    tr = fp.transform(train)
    model = linear.fit_linear(tr, fp.feature_names, target, alpha=alpha)
    te = fp.transform(data.where(F.col("is_test")))
    pred = linear.predictions_table(model, te, target, key_cols)
    spark = df.sparkSession
    return {
        "metrics": metrics.regression_metrics(pred, "actual", "predicted"),
        "variance": metrics.variance_decomposition(pred, "actual", "predicted"),
        "trend": metrics.trend_line(pred, "actual", "predicted"),
        "coefficients": model.coefficients(spark, top=30),
        "predictions": pred,
    }


def next_step_data(dirty: DataFrame, spec: PanelSpec, *, value: str, measures, sentinel: float,
                   clip_to=(None, None)) -> DataFrame:
    """Data part of Q4: recipe B cleaning, time-series fill (interpolate,
    ffill/bfill, median), next-row change as the target."""
    cleaned = clean.clean_recipe_b(dirty, rules={value: (sentinel, clip_to[0], clip_to[1])})
    filled = impute.time_series_fill(cleaned, spec, list(measures))
    return derive.next_step_change(filled, spec, value, next_col=f"next_{value}",
                                   change_col=f"next_{value}_change")


def next_step_regression(data: DataFrame, *, feature_sets: dict, target: str, categorical, key_cols,
                         degrees=(1,)) -> dict:
    """Q4: the sweep over feature sets x imputers x scalers x degrees, ranked;
    best combination's predictions and coefficients."""
    d = split.split_random(data, key_cols, 0.2)
    d = split.kfold(d, key_cols, 5)
    table, fitted = search.model_sweep(d, feature_sets, target, categorical=categorical, degrees=degrees)
    ranked = search.rank_sweep(table)
    best = ranked.first()
    fp, model = fitted[(best["feature_set"], best["imputer_strategy"], best["scaler_name"],
                        best["polynomial_degree"])]
    test = fp.transform(d.where(F.col("is_test")))
    spark = data.sparkSession
    return {"sweep": ranked, "top5": ranked.limit(5), "best": best.asDict(),
            "predictions": linear.predictions_table(model, test, target),
            "coefficients": model.coefficients(spark, top=30)}


def cluster_state(df: DataFrame, *, measures, keep, ks=range(2, 13), restarts: int = 10,
                  fixed_k: int | None = None) -> dict:
    """Q5: median imputation + robust scaling (fitted on all rows, as in the
    reference), k sweep with inertia and silhouette, best k (or ``fixed_k``),
    refit, centres, cluster sizes, PCA and the keyed cluster view."""
    base = cut_lineage(df.select(*keep, *measures))  # fitted statistics reuse one materialisation
    filled = impute.impute_median(base, list(measures))
    scaled = encode.robust_scale(filled, list(measures))
    arr = scaled.select(*keep, F.array(*[F.col(m) for m in measures]).alias("x"))
    sweep, fits = cluster.kmeans_sweep(arr, "x", ks, restarts=restarts)
    k = fixed_k or cluster.select_k(sweep).first()["n_clusters"]
    res = fits.get(k) or cluster.kmeans(arr, "x", k, restarts=restarts)
    labelled = cluster.assign(arr, "x", res.centres)
    spark = df.sparkSession
    pcs, load, var, means = cluster.pca_2d(labelled, "x", keep=[*keep, "cluster"])
    return {"sweep": sweep, "k": k,
            "centres": cluster.centres_table(spark, res.centres, list(measures)),
            "counts": profile.value_counts(labelled, "cluster"),
            "view": labelled.select(*keep, "cluster"),
            "pca": pcs, "pca_centres": cluster.project_centres(spark, res.centres, means, load),
            "explained_variance": [float(v) for v in var]}


def scale_with_ordered_split(df: DataFrame, *, time_col: str, measures, test_fraction: float = 0.2) -> dict:
    """Q7: outlier report, ordered split, robust scaling fitted on the
    training part; description and densities of the whole table before scaling and
    of the training part after it."""
    d = split.split_ordered(df, time_col, test_fraction)
    train = d.where(~F.col("is_test"))
    scaled = encode.robust_scale(d, list(measures), fit_df=train)
    scaled_train = scaled.where(~F.col("is_test"))
    return {"outliers": clean.outlier_report(df, list(measures)),
            "describe_before": profile.describe_numeric(df, list(measures)),
            "describe_after": profile.describe_numeric(scaled_train, list(measures)),
            "kde_before": profile.kde_grid(df, list(measures)),
            "kde_after": profile.kde_grid(scaled_train, list(measures)),
            "scaled": scaled}


# results with a row per input row: written by as many tasks as made them
ROW_LEVEL = ("view", "predictions", "pca", "scaled")


def run_workflows(workflows: dict) -> tuple[dict[str, DataFrame], dict]:
    """Run the given workflows (name -> function without arguments that returns one of
    this module's result dicts) one after the other: their tables by
    ``workflow.table`` and their fitted values by the same names."""
    tables, values = {}, {}
    for name, run in workflows.items():
        for key, value in run().items():
            (tables if isinstance(value, DataFrame) else values)[f"{name}.{key}"] = value
    return tables, values


def run_all(spark, outputs: dict[str, DataFrame], summary: dict, out_dir: str) -> str:
    """Q8: write, audit and publish every result table (CSV; report tables as one file
    each) and the summary JSON, then check the published files against the manifest."""
    sinks.publish_outputs(spark, outputs, out_dir, row_level={
        name for name in outputs if name.rsplit(".", 1)[-1] in ROW_LEVEL})
    path = sinks.write_metrics_json(spark, summary, f"{out_dir}/summary")
    sinks.assert_outputs(spark, [path])
    sinks.audit_outputs(spark, out_dir)
    return out_dir
