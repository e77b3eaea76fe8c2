"""Model-combination sweep (R6) for linear regression.

Every combination (feature set x imputer x scaler x degree) fits its
preprocessing on the training split, cross-validates on the training folds,
refits on all training rows and scores the test split. For degrees 1 and 2 all
combinations come from one moment pass (affine maps of the same moments);
``refit=True`` (and higher degrees) fit each combination separately.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.operators import metrics
from tidepanel.operators.encode import FeaturePlan
from tidepanel.operators.models import linear

# The columns of the sweep's result table
SWEEP_SCHEMA = ("feature_set string, imputer_strategy string, scaler_name string, polynomial_degree int, "
                "model_name string, CV_MAE double, CV_RMSE double, CV_R2 double, Test_MAE double, "
                "Test_MSE double, Test_RMSE double, Test_R2 double")


def model_sweep(df: DataFrame, feature_sets: dict, y: str, *, categorical=(), test_col: str = "is_test",
                fold_col: str = "fold", k: int = 5, imputers=("median", "mean"),
                scalers=("standard", "robust"), degrees=(1,), alpha: float = 0.0, refit: bool = False):
    """Returns ``(table, fitted)`` -- the metrics table (one row per
    combination) and the fitted plan/model per combination. Degrees 1 and 2 run
    in a fixed number of passes (:func:`model_sweep_moments`); higher degrees
    refit per combination."""
    spark = df.sparkSession
    if set(degrees) <= {1, 2} and not refit:
        return model_sweep_moments(df, feature_sets, y, categorical=categorical, test_col=test_col,
                                   fold_col=fold_col, k=k, imputers=imputers, scalers=scalers,
                                   degrees=degrees, alpha=alpha)
    base = df.persist()
    rows, fitted = [], {}
    try:
        train = base.where(~F.col(test_col))
        test = base.where(F.col(test_col))
        for fs_name, feats in feature_sets.items():
            num = [c for c in feats if c not in set(categorical)]
            cat = [c for c in feats if c in set(categorical)]
            for imp in imputers:
                for sc in scalers:
                    for deg in degrees:
                        plan = FeaturePlan(numeric=num, categorical=cat, imputer=imp, scaler=sc, degree=deg,
                                           keep=[y, fold_col])
                        fp = plan.fit(train)
                        names = fp.feature_names
                        tr = fp.transform(train)
                        cv = linear.cross_validate(tr, names, y, fold_col, k, alpha=alpha).agg(
                            F.avg("mae").alias("mae"), F.avg("rmse").alias("rmse"), F.avg("r2").alias("r2")).first()
                        model = linear.fit_linear(tr, names, y, alpha=alpha)
                        te = fp.transform(test)
                        tm = metrics.regression_metrics(linear.predictions_table(model, te, y),
                                                        "actual", "predicted").first()
                        name = "LinearRegression" if deg == 1 else "PolynomialRegression"
                        rows.append((fs_name, imp, sc, int(deg), name, cv["mae"], cv["rmse"], cv["r2"],
                                     tm["mae"], tm["mse"], tm["rmse"], tm["r2"]))
                        fitted[(fs_name, imp, sc, deg)] = (fp, model)
    finally:
        base.unpersist()
    table = spark.createDataFrame(rows, SWEEP_SCHEMA)
    return table, fitted


def rank_sweep(table: DataFrame, top: int | None = None) -> DataFrame:
    """Sort by CV RMSE then test RMSE; mathematically tied rows (equal up to
    rounding) are ordered by their names."""
    out = table.orderBy(F.round("CV_RMSE", 9), F.round("Test_RMSE", 9), "feature_set", "imputer_strategy",
                        "scaler_name", "polynomial_degree")
    return out.limit(top) if top else out


# ---- one-pass sweep for degrees 1 and 2 -----------------------------------------

def _base_columns(num, cat, levels, scale):
    """Base vector b: per numeric column its value in units of ``scale`` (centre, spread)
    with NULL -> 0 and a NULL indicator; per categorical column one indicator per level
    and a NULL indicator. Every degree-1 feature of every combination is affine in b.
    Returns names, the column each entry comes from, whether it is an indicator, exprs."""
    names, family, indicator, exprs = [], [], [], []
    for c in num:
        centre, spread = scale[c]
        names += [f"x0:{c}", f"m:{c}"]
        indicator += [False, True]
        exprs += [F.coalesce((F.col(c).cast("double") - F.lit(centre)) / F.lit(spread), F.lit(0.0)),
                  F.col(c).isNull().cast("double")]
        family += [c, c]
    for c in cat:
        for lv in levels[c]:
            names.append(f"l:{c}:{lv}")
            exprs.append(F.coalesce((F.col(c) == F.lit(lv)).cast("double"), F.lit(0.0)))
        names.append(f"mc:{c}")
        exprs.append(F.col(c).isNull().cast("double"))
        family += [c] * (len(levels[c]) + 1)
        indicator += [True] * (len(levels[c]) + 1)
    return names, family, indicator, exprs


class _Products:
    """Positions of products of base entries in [b, products]: an indicator is its own
    square, two entries of one column never differ from 0 together, and the other
    products are columns of their own (only those that a feature set has)."""

    def __init__(self, family, indicator, feature_sets):
        together = {(a, b) for fs in feature_sets.values() for a in fs for b in fs}
        self.at = {}
        self.pairs = []
        for i, a in enumerate(family):
            for j in range(i, len(family)):
                if a == family[j] and (i != j or indicator[i]):
                    self.at[i, j] = i if i == j else None
                elif (a, family[j]) in together:
                    self.at[i, j] = len(family) + len(self.pairs)
                    self.pairs.append((i, j))

    def of(self, p, p0, q, q0, width):
        """(row, constant) of (p.b + p0)(q.b + q0) over [b, products]."""
        import numpy as np
        row = np.zeros(width)
        row[:len(p)] = p0 * q + q0 * p
        for i in np.flatnonzero(p):
            for j in np.flatnonzero(q):
                at = self.at[min(i, j), max(i, j)]
                if at is not None:
                    row[at] += p[i] * q[j]
        return row, p0 * q0


def model_sweep_moments(df: DataFrame, feature_sets: dict, y: str, *, categorical=(),
                        test_col: str = "is_test", fold_col: str = "fold", k: int = 5,
                        imputers=("median", "mean"), scalers=("standard", "robust"), degrees=(1,),
                        alpha: float = 0.0):
    """R6 for degrees 1 and 2 in a fixed number of passes, whatever the number of
    combinations: train-split statistics (quantile passes, level counts), one
    moment pass grouped by fold / test over the base vector, then per
    combination an affine map of the moments (mu_z = A mu + a,
    C_z = A C A^T) gives every CV fold fit, held-out SSE, and the test SSE;
    one numpy scoring pass gives all MAEs. Same results as refitting each
    combination (preprocessing fitted on the training split).

    Products of two affine features are affine in [b, b_i b_j], so degree 2 is the
    same map one order higher. Its moments are as wide as the products that can
    differ from 0: about half the square of (numeric columns + levels)."""
    import numpy as np
    from pyspark.sql import types as T

    from tidepanel.operators import impute
    from tidepanel.operators.encode import FittedFeaturePlan, level_counts
    from tidepanel.operators.quantiles import quantile_values
    from tidepanel.session import right_sized

    spark = df.sparkSession
    cat_all = [c for c in dict.fromkeys(c for fs in feature_sets.values() for c in fs) if c in set(categorical)]
    num_all = [c for c in dict.fromkeys(c for fs in feature_sets.values() for c in fs) if c not in set(categorical)]
    base, _ = right_sized(df.where(F.col(y).isNotNull()).select(*num_all, *cat_all, y, fold_col, test_col))
    try:
        train = base.where(~F.col(test_col))
        med = impute.fit_median(train, num_all) if "median" in imputers else {}
        spread = train.agg(*[f(F.col(c).cast("double")).alias(f"{n}{i}") for i, c in enumerate(num_all)
                             for n, f in (("mu", F.avg), ("sd", F.stddev_pop))],
                           F.count(F.lit(1)).alias("n")).first()
        mean = {c: spread[f"mu{i}"] for i, c in enumerate(num_all)}
        unit = {c: (mean[c] or 0.0, spread[f"sd{i}"] or 1.0) for i, c in enumerate(num_all)}
        lv_mode = {c: level_counts(train, c) for c in cat_all}
        levels = {c: lv_mode[c][0] for c in cat_all}
        modes = {c: lv_mode[c][1] for c in cat_all}
        fills = {"median": med, "mean": mean}
        # robust scaling needs quantiles of the imputed columns: one call for all
        rob = {}
        if "robust" in scalers:
            filled_cols = {f"{imp}|{c}": F.coalesce(F.col(c).cast("double"), F.lit(fills[imp][c]))
                           for imp in imputers for c in num_all}
            fr = train.select(*[e.alias(n) for n, e in filled_cols.items()])
            qv = quantile_values(fr, list(filled_cols), [0.25, 0.5, 0.75])
            for n in filled_cols:
                lo, md, hi = qv[(n, 0.25)], qv[(n, 0.5)], qv[(n, 0.75)]
                iqr = (hi - lo) if hi is not None and lo is not None else None
                rob[n] = (md, iqr if iqr else 1.0)
        bnames, family, indicator, bexprs = _base_columns(num_all, cat_all, levels, unit)
        products = _Products(family, indicator, feature_sets if 2 in degrees else {})
        grp = F.when(F.col(test_col), F.lit(-1)).otherwise(F.col(fold_col).cast("int")).alias("_g")
        bframe = base.select(grp, *[e.alias(n) for n, e in zip(bnames, bexprs)], F.col(y).cast("double").alias(y))
        groups = linear.moment_stats(bframe, bnames, y, by="_g", products=products.pairs)
        idx = {n: i for i, n in enumerate(bnames)}
        nb = len(bnames)
        width = nb + len(products.pairs)
        train_groups = [g for g in groups if g != -1]
        total = None
        for g in train_groups:
            total = groups[g] if total is None else linear.merge(total, groups[g])

        combos, fitted, rows = [], {}, []
        for fs_name, feats in feature_sets.items():
            num = [c for c in feats if c not in set(categorical)]
            cat = [c for c in feats if c in set(categorical)]
            for imp in imputers:
                for sc in scalers:
                    scale = {}
                    for c in num:
                        v = fills[imp][c]
                        if sc == "standard":
                            i0, im = idx[f"x0:{c}"], idx[f"m:{c}"]
                            c0, s0 = unit[c]
                            gap = v - c0
                            mu = c0 + s0 * total.mu[i0] + gap * total.mu[im]
                            var = (s0 * s0 * total.C[i0, i0] + gap * gap * total.C[im, im]
                                   + 2 * s0 * gap * total.C[i0, im]) / total.n
                            sd = float(np.sqrt(max(var, 0.0)))
                            scale[c] = (float(mu), sd if sd else 1.0)
                        elif sc == "robust":
                            scale[c] = rob[f"{imp}|{c}"]
                        else:
                            scale[c] = (0.0, 1.0)
                    rows_, consts = [], []
                    for c in num:
                        ctr, s = scale[c]
                        c0, s0 = unit[c]
                        row = np.zeros(nb)
                        row[idx[f"x0:{c}"]] = s0 / s
                        row[idx[f"m:{c}"]] = (fills[imp][c] - c0) / s
                        rows_.append(row)
                        consts.append((c0 - ctr) / s)
                    for c in cat:
                        for lv in levels[c]:
                            row = np.zeros(nb)
                            row[idx[f"l:{c}:{lv}"]] = 1.0
                            if lv == modes[c]:
                                row[idx[f"mc:{c}"]] = 1.0
                            rows_.append(row)
                            consts.append(0.0)
                    for deg in degrees:
                        plan = FeaturePlan(numeric=num, categorical=cat, imputer=imp, scaler=sc, degree=deg,
                                           keep=[y, fold_col])
                        fp = FittedFeaturePlan(plan, {c: fills[imp][c] for c in num}, scale,
                                               {c: modes[c] for c in cat}, {c: levels[c] for c in cat})
                        # the features over [b, products] in the plan's order, then y
                        terms = [(np.pad(row, (0, width - nb)), c) for row, c in zip(rows_, consts)]
                        if deg == 2:
                            terms += [products.of(rows_[i], consts[i], rows_[j], consts[j], width)
                                      for i in range(len(rows_)) for j in range(i, len(rows_))]
                        A = np.zeros((len(terms) + 1, width + 1))
                        A[:-1, :-1] = [row for row, _ in terms]
                        A[-1, -1] = 1.0
                        a = np.array([*(c for _, c in terms), 0.0])

                        def zmom(M, A=A, a=a):
                            return linear.Moments(M.n, A @ M.mu + a, A @ M.C @ A.T)

                        models = {}
                        cv = []
                        ztotal = zmom(total)
                        for f in range(k):
                            if f not in groups:
                                continue
                            zf = zmom(groups[f])
                            b0, beta = linear.solve_moments(ztotal.minus(zf), alpha)
                            cv.append((f, zf.n, linear.sse_moments(zf, b0, beta), zf.C[-1, -1]))
                            models[f] = (b0, beta)
                        b0, beta = linear.solve_moments(ztotal, alpha)
                        models[-1] = (b0, beta)
                        zt = zmom(groups[-1]) if -1 in groups else None
                        combos.append((fs_name, imp, sc, deg, A, a, models, cv, zt))
                        fitted[(fs_name, imp, sc, deg)] = (
                            fp, linear.LinearModel(fp.feature_names, b0, beta, {}))

        # all MAEs: predictions are linear in the base vector -> one numpy pass
        W, W0, keys = [], [], []
        for ci, (_, _, _, _, A, a, models, _, _) in enumerate(combos):
            for g, (b0, beta) in models.items():
                w = A[:-1, :-1].T @ beta
                W.append(w)
                W0.append(b0 + float(beta @ a[:-1]))
                keys.append((ci, g))
        Wm = np.array(W).T  # width x models
        pairs = products.pairs
        W0v = np.array(W0)
        key_arr = np.array(keys)
        cols = ["_g", *bnames, y]

        def score(batches):
            import pandas as pd
            acc = {}
            for pdf in batches:
                if len(pdf) == 0:
                    continue
                X = pdf[bnames].to_numpy(dtype="float64")
                yv = pdf[y].to_numpy(dtype="float64")
                g = pdf["_g"].to_numpy()
                P = np.column_stack([X, *(X[:, i] * X[:, j] for i, j in pairs)]) @ Wm + W0v
                for j, (ci, gg) in enumerate(key_arr):
                    sel = g == gg
                    if sel.any():
                        e = np.abs(yv[sel] - P[sel, j]).sum()
                        a_ = acc.get((ci, gg), (0.0, 0))
                        acc[(ci, gg)] = (a_[0] + float(e), a_[1] + int(sel.sum()))
            yield pd.DataFrame([(int(c), int(g), s, n) for (c, g), (s, n) in acc.items()],
                               columns=["ci", "g", "s", "n"])

        sch = T.StructType([T.StructField("ci", T.IntegerType()), T.StructField("g", T.IntegerType()),
                            T.StructField("s", T.DoubleType()), T.StructField("n", T.LongType())])
        parts = bframe.select(*cols).mapInPandas(score, sch).groupBy("ci", "g").agg(
            F.sum("s").alias("s"), F.sum("n").alias("n")).collect()  # combos x groups rows
        mae = {(r["ci"], r["g"]): r["s"] / r["n"] for r in parts}
    finally:
        base.unpersist()

    for ci, (fs_name, imp, sc, deg, A, a, models, cv, zt) in enumerate(combos):
        model_name = "LinearRegression" if deg == 1 else "PolynomialRegression"
        cv_rmse = float(np.mean([np.sqrt(max(sse, 0) / n) for _, n, sse, _ in cv]))
        cv_r2 = float(np.mean([1 - sse / sst for _, n, sse, sst in cv if sst > 0]))
        cv_mae = float(np.mean([mae[(ci, f)] for f, _, _, _ in cv]))
        if zt is not None and zt.n > 0:
            b0, beta = models[-1]
            sse = linear.sse_moments(zt, b0, beta)
            t_mse = sse / zt.n
            t_r2 = 1 - sse / zt.C[-1, -1] if zt.C[-1, -1] > 0 else None
            rows.append((fs_name, imp, sc, deg, model_name, cv_mae, cv_rmse, cv_r2, mae.get((ci, -1)),
                         float(t_mse), float(np.sqrt(max(t_mse, 0))), t_r2 if t_r2 is None else float(t_r2)))
        else:
            rows.append((fs_name, imp, sc, deg, model_name, cv_mae, cv_rmse, cv_r2, None, None, None, None))
    return spark.createDataFrame(rows, SWEEP_SCHEMA), fitted
