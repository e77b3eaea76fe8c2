import glob
import json
import os

import pytest

from tidepanel.sources import sinks
from tidepanel.sources.tables import read_panel_csv

SMALL_GRID = {"criteria": ("gini",), "depths": (3,), "min_splits": (5,), "min_leaves": (5,),
              "class_weights_": (None,)}


def test_csv_roundtrip_and_bom(spark, tmpdir_path):
    df = spark.createDataFrame([("A", "2024-01-02", 1.5), ("B", "bad", None)], "c string, d string, x double")
    p = sinks.write_table(df, f"{tmpdir_path}/t", single_file=True)
    back = read_panel_csv(spark, p, "c string, d string, x double", date_col="d").orderBy("c").collect()
    assert back[0]["d"].isoformat() == "2024-01-02" and back[1]["d"] is None
    b = sinks.write_table_csv_bom(df, f"{tmpdir_path}/bom")
    part = glob.glob(f"{b}/part-*.csv")[0]
    with open(part, "rb") as fh:
        assert fh.read(3) == b"\xef\xbb\xbf"


def test_metrics_json_and_assert_outputs(spark, tmpdir_path):
    m = {"best_params": {"depth": 3, "criterion": "gini"}, "cv_accuracy_scores": [0.5, 0.6], "acc": 0.7}
    p = sinks.write_metrics_json(spark, m, f"{tmpdir_path}/m")
    part = glob.glob(f"{p}/part-*.json")[0]
    with open(part) as fh:
        got = json.loads(fh.readline())
    assert got["best_params"]["criterion"] == "gini" and got["cv_accuracy_scores"] == [0.5, 0.6]
    sinks.assert_outputs(spark, [p])
    with pytest.raises(FileNotFoundError) as e:
        sinks.assert_outputs(spark, [p, os.path.join(tmpdir_path, "nope1"), os.path.join(tmpdir_path, "nope2")])
    assert "nope1" in str(e.value) and "nope2" in str(e.value)


def damage(path, change):
    part = glob.glob(f"{path}/part-*")[0]
    with open(part) as fh:
        text = fh.read()
    with open(part, "w") as fh:
        fh.write(change(text))
    crc = os.path.join(path, f".{os.path.basename(part)}.crc")
    if os.path.exists(crc):
        os.remove(crc)


def test_published_outputs_are_audited(spark, tmpdir_path):
    one = spark.createDataFrame([("A", 1.5, None), ("B, \"b\"", None, 2), ("", 0.1, 3), ("A", 1.5, None)],
                                "s string, x double, n int")
    none = one.where("n > 5")
    out = f"{tmpdir_path}/run"
    sinks.publish_outputs(spark, {"one": one, "none": none}, out, row_level={"one"})
    assert not os.path.exists(f"{out}/{sinks.STAGING}")
    facts = {r["name"]: r for r in sinks.audit_outputs(spark, out).collect()}
    assert (facts["one"]["n_rows"], facts["none"]["n_rows"]) == (4, 0)
    assert facts["one"]["columns"] == ["s", "x", "n"] and facts["none"]["checksum"] == "0"
    # the same rows in another order and layout have the same checksum
    sinks.publish_outputs(spark, {"one": one.repartition(3, "s")}, out)
    assert sinks.audit_outputs(spark, out).first()["checksum"] == facts["one"]["checksum"]
    for change in (lambda t: t.replace("1.5", "1.6", 1), lambda t: t[:t.rindex("A")],
                   lambda t: t.replace("s,x,n", "s,n,x"), lambda t: t + "A,1.5,\n"):
        sinks.publish_outputs(spark, {"one": one}, out)
        sinks.audit_outputs(spark, out)
        damage(f"{out}/one", change)
        with pytest.raises(ValueError, match="one"):
            sinks.audit_outputs(spark, out)


def test_rows_lost_while_writing_are_not_published(spark, tmpdir_path):
    out = f"{tmpdir_path}/run"
    broken = spark.createDataFrame([("two\nlines",)], "s string")
    with pytest.raises(ValueError, match="t: 1 rows"):
        sinks.publish_outputs(spark, {"t": broken}, out)
    assert not os.path.exists(f"{out}/t") and not os.path.exists(f"{out}/{sinks.MANIFEST}")
    sinks.publish_outputs(spark, {"t": broken}, out, fmt="parquet")
    assert sinks.audit_outputs(spark, out).first()["n_rows"] == 1


def test_four_workflows_end_to_end(spark, tmpdir_path):
    from pyspark.sql import functions as F

    from tidepanel.plans import workflows as W
    h = [F.pmod(F.hash("id", F.lit(i)), F.lit(100)).cast("double") for i in range(3)]
    d = spark.range(240).select(
        F.col("id"), F.concat(F.lit("E"), (F.col("id") % 4).cast("string")).alias("e"),
        h[0].alias("a"), F.when(F.col("id") % 9 != 0, h[1]).alias("b"),
        (h[0] * 2 + h[2] / 10).alias("y"))
    d = d.withColumn("label", F.when(F.col("a") > 50, "high").otherwise("low")).persist()
    labels = ["low", "high"]
    tables, values = W.run_workflows({
        "profile": lambda: W.profile_panel(d, d.where("b IS NOT NULL"), entity="e", measure="a",
                                           label_col="label", labels=labels, bins=5),
        "classify": lambda: W.classify(d, numeric=["a", "b"], categorical=["e"], label="label", labels=labels,
                                       key_cols=["id"], grid=SMALL_GRID),
        "regress": lambda: W.regress(d, numeric=["a", "b"], categorical=["e"], target="y", key_cols=["id"]),
        "cluster": lambda: W.cluster_state(d, measures=["a", "b"], keep=["id"], ks=range(2, 4), restarts=2),
    })
    out = W.run_all(spark, tables, {k: v for k, v in values.items() if k.split(".")[1] in ("best", "k", "depth")},
                    f"{tmpdir_path}/all")
    facts = {r["name"]: r["n_rows"] for r in sinks.audit_outputs(spark, out).collect()}
    assert set(facts) == set(tables)
    assert {"profile.missing", "classify.confusion", "regress.coefficients", "cluster.centres"} <= set(facts)
    assert facts["cluster.view"] == 240 and facts["cluster.centres"] == values["cluster.k"]
    with open(glob.glob(f"{out}/summary/part-*.json")[0]) as fh:
        assert json.loads(fh.readline())["cluster.k"] == values["cluster.k"]
    damage(f"{out}/classify.report", lambda t: t[:-3])
    with pytest.raises(ValueError, match="classify.report"):
        sinks.audit_outputs(spark, out)
    d.unpersist()
