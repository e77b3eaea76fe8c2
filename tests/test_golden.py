"""Golden micro-panels with hand-computed expectations (FIXTURES.md F2)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tidepanel import PanelSpec
from tidepanel.operators import clean, derive, encode, impute, metrics, profile, quantiles
from tidepanel.sources.tables import normalise_missing

D = dt.date
SCHEMA = "entity string, time date, x double"


def panel(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def series(df, col, entity="A"):
    return [r[col] for r in df.where(F.col("entity") == entity).orderBy("time").collect()]


A_VALUES = [None, 1.0, None, None, 4.0, None]


def a_rows(days=(1, 2, 3, 4, 5, 6)):
    return [("A", D(2024, 1, d), v) for d, v in zip(days, A_VALUES)]


@pytest.mark.parametrize("width", [None, 1.0, 2.0, 100.0])
def test_inner_null_run(spark, width):
    spec = PanelSpec(entity="entity", time="time", chunk_width=width)
    df = panel(spark, a_rows() + [("B", D(2024, 1, 1), None), ("B", D(2024, 1, 2), None)])
    assert series(impute.interpolate_linear(df, spec, ["x"]), "x") == [1, 1, 2, 3, 4, 4]
    assert series(impute.ffill(df, spec, ["x"]), "x") == [None, 1, 1, 1, 4, 4]
    assert series(impute.bfill(df, spec, ["x"]), "x") == [1, 1, 4, 4, 4, None]
    assert series(impute.ffill_bfill(df, spec, ["x"]), "x") == [1, 1, 1, 1, 4, 4]
    # all-NULL entity stays NULL after I4 / I3
    assert series(impute.interpolate_linear(df, spec, ["x"]), "x", "B") == [None, None]
    assert series(impute.ffill_bfill(df, spec, ["x"]), "x", "B") == [None, None]


def test_irregular_dates_interpolate_by_position(spark):
    spec = PanelSpec(entity="entity", time="time", chunk_width=2.0)
    df = panel(spark, a_rows(days=(1, 2, 3, 4, 9, 10)))
    assert series(impute.interpolate_linear(df, spec, ["x"]), "x") == [1, 1, 2, 3, 4, 4]


def test_time_series_fill_uses_global_median(spark):
    spec = PanelSpec(entity="entity", time="time")
    df = panel(spark, a_rows() + [("B", D(2024, 1, 1), None), ("B", D(2024, 1, 2), None)])
    out = impute.time_series_fill(df, spec, ["x"])
    # filled A = 1,1,2,3,4,4 -> median 2.5
    assert series(out, "x", "B") == [2.5, 2.5]


def test_one_row_entity_dropped_by_next_step(spark):
    spec = PanelSpec(entity="entity", time="time")
    df = panel(spark, [("C", D(2024, 1, 1), 7.0), ("A", D(2024, 1, 1), 1.0), ("A", D(2024, 1, 2), 3.0)])
    lead = derive.lead_value(df, spec, ["x"])
    assert series(lead, "x_next", "C") == [None]
    out = derive.next_step_change(df, spec, "x")
    assert out.where("entity = 'C'").count() == 0
    assert [r["x_change"] for r in out.collect()] == [2.0]


def test_sentinels(spark):
    df = spark.createDataFrame([(1.0,), (999.0,), (None,)], "x double")
    assert clean.drop_sentinel_rows(df, {"x": 999.0}).count() == 2
    assert [r[0] for r in clean.sentinel_to_null(df, {"x": 999.0}).collect()] == [1.0, None, None]


def test_policies_on_large_non_sentinel(spark):
    df = spark.createDataFrame([(150.0,)], "x double")
    a = clean.clean_recipe_a(df, upper_limits={"x": 100.0})
    b = clean.clean_recipe_b(df, rules={"x": (999.0, -20.0, 20.0)})
    assert a.first()[0] is None
    assert b.first()[0] == 20.0


def test_bin_edges(spark):
    vals = [-1.0, 0.0, 0.0001, 5.0, 5.0001, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, x double")
    out = [r[0] for r in derive.bin_labels(df, "x", "lab").orderBy("i").select("lab").collect()]
    assert out == ["No_Increase", "No_Increase", "Slight_Increase", "Slight_Increase", "Large_Increase", None]


def test_quantiles_and_fences(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    b = clean.iqr_bounds(df, ["x"]).first()
    assert (b["q1"], b["q3"]) == (1.75, 4.75)
    assert (b["lower"], b["upper"]) == (-2.75, 9.25)
    assert quantiles.quantile_values(df, ["x"], [0.5])[("x", 0.5)] == 2.5
    assert [r[0] for r in clean.iqr_outliers(df, "x").collect()] == [10.0]


def test_constant_column(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 2.0), (5.0, 3.0)], "c double, y double")
    assert [r[0] for r in encode.standard_scale(df, ["c"]).collect()] == [0.0, 0.0, 0.0]
    assert [r[0] for r in encode.robust_scale(df, ["c"]).collect()] == [0.0, 0.0, 0.0]
    assert profile.corr_matrix(df, ["c", "y"]).first()["corr"] is None


def test_mode_tie_goes_to_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "v string")
    assert impute.fit_most_frequent(df, ["v"]) == {"v": "a"}
    assert [r[0] for r in impute.impute_most_frequent(df, ["v"]).collect()][-1] == "a"


def test_unseen_level_all_zeros(spark):
    train = spark.createDataFrame([("a",), ("b",)], "v string")
    test = spark.createDataFrame([("c",), (None,)], "v string")
    out = encode.one_hot(test, "v", fit_df=train).collect()
    assert [tuple(r) for r in out] == [(0, 0), (0, 0)]
    with pytest.raises(ValueError):
        encode.one_hot(test, "v", fit_df=train, handle_unknown="error")


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert [r[0] for r in normalise_missing(df).collect()] == [None, 1.0]


def test_class_never_predicted(spark):
    df = spark.createDataFrame([(0, 0), (1, 1), (2, 1), (2, 0)], "y int, p int")
    rep = {r["label"]: r for r in metrics.classification_report(df, "y", "p", [0, 1, 2]).collect()}
    assert rep["2"]["precision"] == 0.0 and rep["2"]["f1"] == 0.0
    assert rep["2"]["support"] == 2
    macro = metrics.macro_f1(df, "y", "p", [0, 1, 2]).first()[0]
    assert math.isclose(macro, rep["macro avg"]["f1"])


def test_histogram_maximum_in_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in range(5)], "x double")
    h = profile.histogram(df, ["x"], bins=2).orderBy("bin").collect()
    assert [r["count"] for r in h] == [2, 3]


def test_empty_table_keeps_schema(spark):
    df = spark.createDataFrame([], "entity string, time date, x double")
    spec = PanelSpec(entity="entity", time="time")
    assert impute.ffill_bfill(df, spec, ["x"]).columns == df.columns
    assert impute.interpolate_linear(df, spec, ["x"]).count() == 0
    assert profile.missing_counts(df).count() == 3
    assert profile.table_shape(df).first()["n_rows"] == 0
    assert clean.outlier_report(df, ["x"]).first()["n_outliers"] == 0


def test_kde_exact_matches_numpy_and_binned_is_close(spark):
    import numpy as np
    rng = np.random.RandomState(3)
    vals = np.concatenate([rng.normal(0, 1, 300), rng.normal(6, 0.5, 100)])
    df = spark.createDataFrame([(float(v),) for v in vals] + [(None,)], "x double")
    exact = {r["point"]: r for r in profile.kde_grid(df, ["x"], points=50).collect()}
    n, sd = len(vals), vals.std(ddof=1)
    bw = sd * n ** (-0.2)
    grid = np.linspace(vals.min() - 3 * bw, vals.max() + 3 * bw, 50)
    want = np.exp(-0.5 * ((grid[:, None] - vals[None, :]) / bw) ** 2).sum(1) / (n * bw * math.sqrt(2 * math.pi))
    assert sorted(exact) == list(range(50))
    for i in range(50):
        assert exact[i]["x"] == pytest.approx(grid[i], rel=1e-12, abs=1e-12)
        assert exact[i]["density"] == pytest.approx(want[i], rel=1e-9, abs=1e-15)
    binned = {r["point"]: r["density"] for r in
              profile.kde_grid(df, ["x"], points=50, method="binned").collect()}
    assert max(abs(binned[i] - want[i]) for i in range(50)) < 1e-3 * want.max()
