"""Columns by name, rejected lines, levels of saved models, node rows and the model store."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from helioframe.catalog.fitted import FIT
from helioframe.catalog.models import prepared
from helioframe.plans.boosted import fit_hurdle
from helioframe.plans.boosting import leaf_medians
from helioframe.plans.models import FittedModel, load_model
from helioframe.plans.store import ModelStore
from helioframe.plans.tree_tables import NODE_SCHEMA, score_nodes, tree_nodes
from helioframe.sources.artifacts import save_description
from helioframe.sources.tables import read_panel, read_plain, read_with_rejects


def write(path, text):
    path.write_text(text)
    return str(path)


def test_columns_are_bound_by_name(spark, tmp_path):
    path = write(tmp_path / "a.csv", "wind,more,temp_a\n1,x,9\n2,,\n")
    assert read_plain(spark, path, "temp_a double, wind double").collect() == [(9.0, 1.0), (None, 2.0)]
    other = write(tmp_path / "b.csv", "temp_a,wind\n5,6\n")
    both = read_plain(spark, [path, other], "temp_a double, wind double")
    assert sorted(map(tuple, both.collect()), key=str) == [(5.0, 6.0), (9.0, 1.0), (None, 2.0)]
    with pytest.raises(ValueError, match="rain"):
        read_plain(spark, path, "rain double")
    with pytest.raises(Exception):
        read_plain(spark, str(tmp_path / "*.csv"), "temp_a double, wind double").collect()


def test_bad_values_are_errors_nulls_or_set_aside(spark, tmp_path):
    path = write(tmp_path / "a.csv", "wind,temp_a\n1,oops\n2,3\n4\n5,6,7\n")
    with pytest.raises(Exception):
        read_plain(spark, path, "temp_a double, wind double").collect()
    lenient = read_plain(spark, path, "temp_a double, wind double", strict=False)
    assert {r.wind: r.temp_a for r in lenient.collect()} == {1.0: None, 2.0: 3.0, 4.0: None, 5.0: 6.0}
    good, rejected = read_with_rejects(spark, path, "temp_a double, wind double")
    assert good.collect() == [(3.0, 2.0)]
    assert sorted(r.line for r in rejected.collect()) == ["1,oops", "4", "5,6,7"]
    assert rejected.where(F.col("file").endswith("a.csv")).count() == 3
    dated = write(tmp_path / "c.csv", "x,time\n1,2024-01-01 00:00:00+00:00\n")
    assert read_panel(spark, dated, "time string, x int").columns == ["time", "x"]


def test_node_rows_of_a_description():
    text = (
        "DecisionTreeRegressionModel: uid=x, depth=2, numNodes=5, numFeatures=2\n"
        "  If (feature 1 <= 0.5)\n   Predict: 1.5\n  Else (feature 1 > 0.5)\n"
        "   If (feature 0 in {0.0,2.0})\n    Predict: -2.0E-4\n   Else (feature 0 not in {0.0,2.0})\n    Predict: 3.0\n"
    )
    assert tree_nodes(text) == [
        (0, 1, 0.5, None, 1, 2, None), (1, None, None, None, None, None, 1.5), (2, 0, None, [0.0, 2.0], 3, 4, None),
        (3, None, None, None, None, None, -2e-4), (4, None, None, None, None, None, 3.0),
    ]


def test_medians_of_small_and_large_leaves(spark):
    df = spark.range(5000).select((F.col("id") % 3).cast("int").alias("leaf"), F.pmod(F.col("id") * 7919, F.lit(1013)).cast("double").alias("v"))
    expected = {}
    for leaf in range(3):
        values = sorted(float(i * 7919 % 1013) for i in range(5000) if i % 3 == leaf)
        expected[leaf] = (len(values), values[(len(values) - 1) // 2])
    assert leaf_medians(df, "leaf", "v") == expected
    assert leaf_medians(df, "leaf", "v", sketch_rows=50) == expected
    flat = df.withColumn("v", F.lit(1.0))
    assert leaf_medians(flat, "leaf", "v", sketch_rows=50) == {k: (n, 1.0) for k, (n, _) in expected.items()}


def test_store_and_levels(spark, tmp_path):
    params = replace(FIT, boost_rounds=1)
    p = prepared(spark, SF_DIR, params)
    model = fit_hurdle(p, params)
    store = ModelStore(spark, str(tmp_path / "store"), keep=2)
    with pytest.raises(FileNotFoundError):
        store.best()
    paths = []
    for epoch, mae in enumerate([3.0, float("nan"), 1.0, 2.0, 1.0]):
        model.metrics = {"mae": mae}
        paths.append(store.save(model, epoch))
    assert [path is None for path in paths] == [False, True, False, False, False]
    assert [(r.place, r.epoch, r.mae) for r in store.ranked().collect()] == [(1, 2, 1.0), (2, 4, 1.0)]
    assert sorted(f.name[:2] for f in (tmp_path / "store").iterdir()) == ["ma", "v-", "v-"]
    again = store.best(need_classifier=True)

    # Groups that the model does not know share the category of a missing group.
    rows = p.test.limit(20)
    new, null = (rows.withColumn("pv_id", F.lit(g).cast("string")) for g in ("new plant", None))
    scores = [[r.prediction for r in again.score(d.orderBy("row_id")).select("prediction").collect()] for d in (new, null)]
    assert scores[0] == scores[1]
    kept = {r.row_id: r.prediction for r in model.score(p.test).select("row_id", "prediction").collect()}
    assert kept == {r.row_id: r.prediction for r in again.score(p.test).select("row_id", "prediction").collect()}


def test_a_save_that_is_cut_short_leaves_the_model_before(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "m")
    model = FittedModel("plain_boosted", ["a"], {}, metrics={"mae": 1.0})
    model.save(path, spark)
    later = FittedModel("plain_boosted", ["a", "b"], {}, metrics={"mae": 0.5})

    def dies(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr("helioframe.plans.models.save_description", dies)
        with pytest.raises(RuntimeError):
            later.save(path, spark)
    assert load_model(spark, path).features == ["a"]
    later.save(path, spark)
    assert load_model(spark, path).features == ["a", "b"]
    save_description(spark, str(tmp_path / "n"), {"version": "x"})


def test_walk_looks_categories_up_without_a_loop_per_row(spark, capsys):
    """Odd codes go right as a search of the list says; no list is searched for a scored row."""
    nodes = spark.createDataFrame([
        (0, 1.0, 0, 0, None, [0.0, 3.0], 1, 2, None), (0, 1.0, 1, 1, 0.5, None, 3, 4, None),
        (0, 1.0, 2, None, None, None, None, None, 100.0), (0, 1.0, 3, None, None, None, None, None, 1.0),
        (0, 1.0, 4, None, None, None, None, None, 2.0), (1, 0.5, 0, None, None, None, None, None, 8.0)], NODE_SCHEMA)
    nan = float("nan")
    asked = [(3.0, 0.5), (0.0, 0.6), (0.0, nan), (1.0, 0.0), (3.5, 0.0), (nan, 0.0), (-1.0, 0.0), (99.0, 0.0)]
    rows = spark.createDataFrame([(i, list(a)) for i, a in enumerate(asked)], "id int, at array<double>")
    out = score_nodes(rows, ["id"], "at", nodes)
    assert {r["id"]: r["margin"] for r in out.collect()} == dict(enumerate([5.0, 6.0, 6.0, 104.0, 104.0, 104.0, 104.0, 104.0]))
    out.explain(True)
    assert not any("array_contains" in line and "_at" in line for line in capsys.readouterr().out.split("\n"))
