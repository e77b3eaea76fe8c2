"""Pairwise-complete correlations and the dealing out of scans."""
import numpy as np
import pandas as pd

from tidepanel.operators import profile
from tidepanel.sources import tables


def frame(spark, x, names, parts=5):
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in x]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names)).repartition(parts)


def test_correlations_of_many_columns_with_gaps(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 24)) @ rng.normal(size=(24, 24)) + 1e6 * np.arange(24)
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 5] = 0.1          # no spread
    x[:, 7] = np.nan       # nothing there
    x[:200, 8] = np.nan    # never together
    x[200:, 9] = np.nan
    names = [f"v{i}" for i in range(24)]
    got = {(r.col_a, r.col_b): r["corr"] for r in profile.corr_matrix(frame(spark, x, names), names).collect()}
    want = pd.DataFrame(x, columns=names).corr(min_periods=2)
    assert len(got) == 24 * 23 // 2
    for (a, b), value in got.items():
        if {a, b} & {"v5", "v7"} or {a, b} == {"v8", "v9"}:
            assert value is None
        else:
            assert abs(value - want.loc[a, b]) < 1e-9
    every = profile.corr_matrix(frame(spark, x, names), names[:4], pairs="all").collect()
    assert len(every) == 16


def test_correlations_of_no_rows(spark):
    empty = spark.createDataFrame([], "a double, b double")
    assert [tuple(r) for r in profile.corr_matrix(empty, ["a", "b"]).collect()] == [("a", "b", None)]


def test_scan_of_one_row_group_is_dealt_out(spark):
    table = tables.driver_table(spark, "/root/testdata/sf0.1", "lineitem")
    counts = [len(p) for p in table.select("l_orderkey").rdd.mapPartitions(
        lambda rows: [[0] * sum(1 for _ in rows)]).collect()]
    some = [c for c in counts if c]
    assert len(some) > 1 and max(some) <= 2 * sum(some) / len(some)
    small = tables.driver_table(spark, "/root/testdata/sf0.001", "nation")
    assert small.rdd.getNumPartitions() == 1


def test_columns_of_very_different_sizes():
    """Least squares keeps its digits where the co-moments alone are badly conditioned, and
    is of minimum norm where columns are dependent."""
    from tidepanel.operators.models.linear import Moments, solve_moments
    rng = np.random.default_rng(5)
    q, d = rng.integers(1, 51, 5000).astype(float), rng.integers(0, 11, 5000) / 100
    x = np.stack([q, d, q * q, q * d, d * d], axis=1)
    for names, columns in (("independent", x), ("dependent", np.c_[x[:, :2], x[:, 0]])):
        y = columns @ np.arange(1.0, columns.shape[1] + 1) * 100 + rng.normal(size=5000)
        full = np.c_[columns, y]
        mu = full.mean(axis=0)
        _, beta = solve_moments(Moments(len(y), mu, (full - mu).T @ (full - mu)))
        centred = columns - mu[:-1]
        size = centred.std(axis=0)
        want = (np.linalg.lstsq(centred / size, y - mu[-1], rcond=None)[0] / size if names == "independent"
                else np.linalg.lstsq(centred, y - mu[-1], rcond=None)[0])
        assert np.allclose(beta, want, rtol=1e-8), names
