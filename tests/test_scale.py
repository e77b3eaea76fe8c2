"""Work per row that must not grow with the size of a group or the number of passes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepanel.spec import PanelSpec


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString().lower()


def test_backward_fills_read_every_row_once(spark):
    # a frame from the current row to the end is evaluated anew for every row
    from tidepanel.operators import impute
    known = [None, 2.0, None, None, 8.0, None, 5.0, None]
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(known)], "k string, t long, v double")
    spec = PanelSpec(entity=("k",), time="t", chunk_width=3.0)
    for fill, wanted in ((impute.interpolate_linear, [2.0, 2.0, 4.0, 6.0, 8.0, 6.5, 5.0, 5.0]),
                         (impute.bfill, [2.0, 2.0, 8.0, 8.0, 8.0, 5.0, 5.0, None])):
        out = fill(df, spec, ["v"])
        assert "unboundedfollowing" not in plan_of(out)
        assert [r["v"] for r in out.orderBy("t").collect()] == wanted


def test_hashes_of_a_row_are_made_once(spark, tmpdir_path):
    # pushed below a projection, a filter on the cleaned columns repeated their hashes
    from tidepanel.plans import bindings as B
    from tidepanel.plans import q_models
    rows = [(i, i % 7, i % 5, i % 3, float(i % 50), 100.0 + i, i % 10 / 100, 0.02, i) for i in range(400)]
    rows += [(None, 1, 1, 1, 5.0, None, 0.1, None, 1), rows[0]]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                          "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                          "day int").withColumn("l_shipdate", F.date_add(F.lit("2024-01-01").cast("date"), "day")
                                                ).drop("day").write.parquet(f"{tmpdir_path}/lineitem.parquet")
    data = q_models.lin_data(spark, tmpdir_path)
    read = data.where(~F.col("is_test")).select(*q_models.X, q_models.Y)
    assert plan_of(read).count("md5(") == 4  # three measures and the split
    li = spark.read.parquet(f"{tmpdir_path}/lineitem.parquet")
    plain = li.withColumns({c: B.inject_dirty(c, F.concat(B._lineitem_key(), F.lit(":" + c)), s)
                            for c, s in B.LINEITEM_SENTINELS.items()})
    got = B.dirty_lineitem(spark, tmpdir_path)
    assert got.columns == plain.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect()))


@pytest.mark.parametrize("most", [10, 1])
def test_holders_of_set_aside_kmers_are_counted_per_text(spark, monkeypatch, most):
    # a join made a row for every probe of every member of a large group
    from tidepanel.llm import near_copies
    monkeypatch.setattr(near_copies, "MOST_ASIDE", most)
    rows = [(1, [-5, 2, 3, 4, 9]), (2, [2, 3, 4]), (3, []), (4, [2, 3]), (4, [4, 9]), (5, [7, 8])]
    nodes = spark.createDataFrame(rows, "id long, probes array<long>")
    aside = spark.createDataFrame([(-5,), (2,), (3,), (4,), (9,)], "kmer long")
    found = near_copies.holders_of(nodes, aside)
    assert sorted(r["id"] for r in found.collect()) == [1, 4]
    if most > 1:
        assert "leftsemi" not in plan_of(found)


def test_memory_of_sketches_is_bounded():
    import tracemalloc
    from tidepanel.llm import near_copies
    rng = np.random.default_rng(1)
    h = rng.integers(0, 2 ** 63, 100_000, dtype=np.uint64)
    m = rng.integers(0, 2 ** 63, 32, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    tracemalloc.start()
    keys = near_copies.sketch_keys(h, m, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16e6
    one_by_one = [near_copies.sketch_keys(h, m[i:i + 1], 3)[0] for i in range(len(m))]
    assert keys.tolist() == one_by_one
