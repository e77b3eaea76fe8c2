"""Decision trees and the shared-fit grid search.

Fits are ``spark.ml`` ``DecisionTreeClassifier`` (distributed histogram
building). The node table of a fitted tree is read from its saved ``data``
folder (pre-order node ids). ``leafCol`` gives each row's pre-order leaf
index, so a tree cut at a smaller depth or at nodes with fewer than
``min_split`` rows (the greedy splits above the cut are the same) predicts by
a small ``(setting, leaf) -> class`` map: one deep fit per
(criterion, min_leaf, class_weight, fold) scores every (depth, min_split)
setting in one join and one aggregation.
"""

from __future__ import annotations

import itertools
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.session import bounded_broadcast, ensure_checkpoint_dir, right_sized

SPARK_MAX_DEPTH = 30  # deepest tree spark.ml grows ("no limit")
DEEP_TREE = 10  # above this depth node ids are cached per row


def class_weights(df: DataFrame, label: str) -> dict:
    """M2: balanced weights n / (k n_c) per class (k rows)."""
    rows = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()
    total = sum(r["n"] for r in rows)
    k = len(rows)
    return {r[label]: total / (k * r["n"]) for r in rows}


@dataclass
class TreeData:
    """Prepared training frame: feature vector, numeric label, optional weight."""
    frame: DataFrame
    features: list[str]
    labels: list


def prepare(df: DataFrame, features, label: str, labels, *, keep=()) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    code = F.element_at(F.create_map(*itertools.chain.from_iterable(
        (F.lit(v), F.lit(float(i))) for i, v in enumerate(labels))), F.col(label))
    base = df.select(*keep, *features, code.alias("_label"), F.col(label).alias("_label_raw"))
    return VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="error").transform(base)


def fit(frame: DataFrame, *, impurity: str = "gini", max_depth: int = SPARK_MAX_DEPTH,
        min_leaf: int = 1, balanced: bool = False, max_bins: int = 256, seed: int = 42):
    """M1: fit on a prepared frame (``_features``, ``_label``)."""
    from pyspark.ml.classification import DecisionTreeClassifier
    data = frame
    params = dict(featuresCol="_features", labelCol="_label", impurity=impurity,
                  maxDepth=int(min(max_depth, SPARK_MAX_DEPTH)), minInstancesPerNode=int(min_leaf),
                  maxBins=max_bins, seed=seed, leafCol="_leaf")
    if max_depth > DEEP_TREE:
        # deep fits: rows carry their node id (checkpointed every 10 levels to
        # the session's checkpoint folder) instead of re-walking the tree
        ensure_checkpoint_dir(frame.sparkSession)
        params.update(cacheNodeIds=True, checkpointInterval=10)
    if balanced:
        w = class_weights(frame, "_label")
        wmap = F.create_map(*itertools.chain.from_iterable((F.lit(k), F.lit(v)) for k, v in w.items()))
        data = frame.withColumn("_w", F.element_at(wmap, F.col("_label")))
        params["weightCol"] = "_w"
    return DecisionTreeClassifier(**params).fit(data)


def node_table(model, spark) -> list[dict]:
    """M4: nodes of a fitted tree (bounded by the model size), pre-order ids,
    with depth and parent. Read from the model's saved Parquet node data in
    the checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tidepanel-trees/{uuid.uuid4().hex}"
    model.write().overwrite().save(path)
    rows = spark.read.parquet(f"{path}/data").collect()
    nodes = {r["id"]: r.asDict(recursive=True) for r in rows}
    nodes[0]["depth"], nodes[0]["parent"] = 0, None
    for i in sorted(nodes):
        n = nodes[i]
        for ch in (n["leftChild"], n["rightChild"]):
            if ch is not None and ch >= 0:
                nodes[ch]["depth"] = n["depth"] + 1
                nodes[ch]["parent"] = i
    return [nodes[i] for i in sorted(nodes)]


def node_frame(nodes: list[dict], feature_names, labels, spark, max_depth: int | None = None) -> DataFrame:
    rows = []
    for n in nodes:
        if max_depth is not None and n["depth"] > max_depth:
            continue
        leaf = n["leftChild"] < 0
        fi = n["split"]["featureIndex"]
        thr = n["split"]["leftCategoriesOrThreshold"]
        rows.append((int(n["id"]), int(n["depth"]), n["parent"], bool(leaf),
                     None if leaf else feature_names[fi], None if leaf or not thr else float(thr[0]),
                     int(n["rawCount"]), float(n["impurity"]),
                     str(labels[int(np.argmax(n["impurityStats"]))]),
                     None if leaf else int(n["leftChild"]), None if leaf else int(n["rightChild"])))
    schema = ("id int, depth int, parent int, is_leaf boolean, feature string, threshold double, "
              "n_samples bigint, impurity double, predicted string, left int, right int")
    return spark.createDataFrame(rows, schema)


def tree_depth(nodes: list[dict]) -> int:
    """M3: levels below the root."""
    return max(n["depth"] for n in nodes)


def rules(nodes: list[dict], feature_names, labels, spark) -> DataFrame:
    """M4: one row per leaf with the conditions on its path, root first."""
    by_id = {n["id"]: n for n in nodes}
    rows = []
    for n in nodes:
        if n["leftChild"] >= 0:
            continue
        path, at = [], n
        while at["parent"] is not None:
            up = by_id[at["parent"]]
            cut = up["split"]["leftCategoriesOrThreshold"][0]
            sign = "<=" if up["leftChild"] == at["id"] else ">"
            path.append(f"{feature_names[up['split']['featureIndex']]} {sign} {cut:.6g}")
            at = up
        rows.append((int(n["id"]), int(n["depth"]), " and ".join(reversed(path)) or "all rows",
                     int(n["rawCount"]), str(labels[int(np.argmax(n["impurityStats"]))])))
    return spark.createDataFrame(
        rows, "leaf int, depth int, rule string, n_samples bigint, predicted string")


def importances(model, feature_names, spark, top: int | None = 10) -> DataFrame:
    """M3: impurity-gain importance per feature, descending."""
    imp = model.featureImportances.toArray()
    df = spark.createDataFrame([(f, float(v)) for f, v in zip(feature_names, imp)],
                               "feature string, importance double").orderBy(F.desc("importance"), "feature")
    return df.limit(top) if top else df


def thresholds(nodes_df: DataFrame) -> DataFrame:
    """M5: sorted split thresholds per feature."""
    return nodes_df.where(~F.col("is_leaf")).groupBy("feature").agg(
        F.array_sort(F.collect_list("threshold")).alias("thresholds"))


def leaf_predictions(nodes: list[dict], settings: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(setting index, leaf index, class index) for trees cut at
    ``depth <= max_depth`` and at nodes with fewer than ``min_split`` rows."""
    leaves = [n for n in nodes if n["leftChild"] < 0]
    by_id = {n["id"]: n for n in nodes}
    out = []
    for li, leaf in enumerate(leaves):
        path = []
        cur = leaf
        while cur is not None:
            path.append(cur)
            cur = by_id.get(cur["parent"]) if cur["parent"] is not None else None
        path.reverse()  # root .. leaf
        for si, (max_depth, min_split) in enumerate(settings):
            stop = path[-1]
            for node in path:
                if node["depth"] >= max_depth or node["rawCount"] < min_split or node["leftChild"] < 0:
                    stop = node
                    break
            out.append((si, li, int(np.argmax(stop["impurityStats"]))))
    return out


@dataclass
class GridResult:
    table: DataFrame          # one row per setting: params + mean macro F1 + fold scores
    best: dict
    fold_accuracy: list = field(default_factory=list)


# The grid (criteria, depths, split and leaf sizes, weightings) that the
# classification workflow searches
def grid_search(frame: DataFrame, fold_col: str, labels, *, criteria=("gini", "entropy"),
                depths=(3, 4, 5, 6, None), min_splits=(5, 10, 20, 30), min_leaves=(5, 10, 20, 30),
                class_weights_=(None, "balanced"), k: int = 5, parallel: int = 8) -> GridResult:
    """Every setting of the grid scored by k-fold macro F1 with shared fits.

    ``frame`` is a prepared frame (see :func:`prepare`) with a fold column.
    """
    spark = frame.sparkSession
    depth_vals = [SPARK_MAX_DEPTH if d is None else int(d) for d in depths]
    cuts = [(d, s) for d in depth_vals for s in min_splits]
    fit_keys = [(c, ml, cw) for c in criteria for ml in min_leaves for cw in class_weights_]
    frame, _ = right_sized(frame)
    try:
        jobs = [(fk, f) for fk in fit_keys for f in range(k)]

        def run(job):
            (crit, ml, cw), f = job
            train = frame.where(F.col(fold_col) != F.lit(f))
            test = frame.where(F.col(fold_col) == F.lit(f))
            model = fit(train, impurity=crit, max_depth=max(depth_vals), min_leaf=ml,
                        balanced=(cw == "balanced"))
            nodes = node_table(model, spark)
            lp = spark.createDataFrame(leaf_predictions(nodes, cuts), "setting int, leaf int, pred int")
            scored = model.transform(test).select(F.col("_leaf").cast("int").alias("leaf"),
                                                  F.col("_label").cast("int").alias("actual"))
            joined = scored.join(bounded_broadcast(lp, 1_000_000), "leaf")
            counts = joined.groupBy("setting", "actual", "pred").agg(F.count(F.lit(1)).alias("n")).collect()
            return (crit, ml, cw, f), counts

        with ThreadPoolExecutor(max_workers=max(1, parallel)) as ex:
            results = list(ex.map(run, jobs))
    finally:
        frame.unpersist()

    nlab = len(labels)
    rows = []
    for (crit, ml, cw, f), counts in results:
        cm = {}
        for r in counts:
            cm.setdefault(r["setting"], np.zeros((nlab, nlab)))[r["actual"], r["pred"]] += r["n"]
        for si, (d, s) in enumerate(cuts):
            m = cm.get(si, np.zeros((nlab, nlab)))
            rows.append((crit, d, s, ml, cw or "none", f, _macro_f1(m), float(np.trace(m) / max(m.sum(), 1))))
    table = spark.createDataFrame(rows, "criterion string, max_depth int, min_split int, min_leaf int, "
                                        "class_weight string, fold int, macro_f1 double, accuracy double")
    summary = table.groupBy("criterion", "max_depth", "min_split", "min_leaf", "class_weight").agg(
        F.avg("macro_f1").alias("mean_macro_f1"), F.avg("accuracy").alias("mean_accuracy"),
        F.transform(F.array_sort(F.collect_list(F.struct("fold", "accuracy"))), lambda x: x["accuracy"])
        .alias("fold_accuracy"))
    # grid order for ties: first setting in the declared grid wins
    order = {key: i for i, key in enumerate(
        (c, d, s, ml, cw or "none") for c in criteria for d in depth_vals for s in min_splits
        for ml in min_leaves for cw in class_weights_)}
    best_rows = sorted(summary.collect(), key=lambda r: (
        -round(r["mean_macro_f1"], 12),
        order[(r["criterion"], r["max_depth"], r["min_split"], r["min_leaf"], r["class_weight"])]))
    best = best_rows[0].asDict()
    return GridResult(summary, best, list(best["fold_accuracy"]))


def _macro_f1(m: np.ndarray) -> float:
    f1s = []
    for c in range(m.shape[0]):
        tp = m[c, c]
        p = tp / m[:, c].sum() if m[:, c].sum() else 0.0
        r = tp / m[c, :].sum() if m[c, :].sum() else 0.0
        f1s.append(2 * p * r / (p + r) if p + r else 0.0)
    return float(np.mean(f1s))


def predict_with_cut(model, frame: DataFrame, nodes, max_depth: int, min_split: int, labels) -> DataFrame:
    """Predictions of the tree cut at (max_depth, min_split), as labels."""
    lp = leaf_predictions(nodes, [(max_depth, min_split)])
    mp = F.create_map(*itertools.chain.from_iterable((F.lit(li), F.lit(str(labels[c]))) for _, li, c in lp))
    return model.transform(frame).withColumn("predicted", F.element_at(mp, F.col("_leaf").cast("int")))

