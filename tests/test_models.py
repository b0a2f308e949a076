from __future__ import annotations

import math
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from helioframe.catalog.models import SHORT, prepared
from helioframe.fixtures import view
from helioframe.functions.scalars import sigmoid
from helioframe.operators import ranges
from helioframe.params import RunParams
from helioframe.plans.boosted import fit_hurdle, fit_positive_classifier, patience_cut
from helioframe.plans.jobs import evaluate, score_saved_models, train_and_deliver
from helioframe.plans.linear import fit_two_head
from helioframe.plans.models import load_model
from helioframe.plans.prepare import prepare


@pytest.fixture(scope="module")
def trees(spark):
    return prepared(spark, SF_DIR, SHORT)


def test_parameters():
    assert not replace(SHORT, scale_features=True).checked().scale_features
    assert RunParams().checked().scale_features
    for bad in (RunParams(model="other"), RunParams(inference_only=True),
                RunParams(model="lightgbm", inference_only=True)):
        with pytest.raises(ValueError):
            bad.checked()
    boost = RunParams(model="lightgbm").boosting()
    assert (boost.rounds, boost.max_depth, boost.min_leaf_rows, boost.patience) == (800, 7, 80, 50)


def test_patience():
    assert patience_cut([3, 2, 2.5, 2.5, 1], 2) == (2, True)
    assert patience_cut([3, 2, 2.5, 1], 2) == (4, False)
    assert patience_cut([5], 1) == (1, False)


def test_prepared_splits(trees):
    ids = [{r["pv_id"] for r in d.select("pv_id").distinct().collect()} for d in (trees.train, trees.val, trees.test)]
    assert not ids[0] & ids[1] and not ids[0] & ids[2] and not ids[1] & ids[2]
    assert len(trees.features) == 28 and trees.features == sorted(trees.features)
    for d in (trees.train, trees.val, trees.test):
        assert d.filter(" OR ".join(f"{c} IS NULL" for c in trees.features)).isEmpty()


def test_standardised_training_split(spark):
    p = prepared(spark, SF_DIR, replace(SHORT, model="feedforward"))
    assert len(p.features) == 27 and "pv_idx" not in p.features
    row = p.train.agg(*[F.avg(c).alias(f"{c}_m") for c in p.features], *[F.stddev_pop(c).alias(f"{c}_s") for c in p.features]).first()
    for c in p.features:
        assert row[f"{c}_m"] == pytest.approx(0.0, abs=1e-9)
        assert row[f"{c}_s"] == pytest.approx(1.0) or row[f"{c}_s"] == pytest.approx(0.0)


def test_options_of_the_fill(spark):
    """Readings of rows without a target only help when the fill comes first."""
    schema = "row_id int, time timestamp_ntz, pv_id string, type string, temp_a double, nins double"
    sql = "SELECT * FROM VALUES {} AS t(row_id, time, pv_id, type, temp_a, nins)"
    rows = [
        "(1, timestamp_ntz'2024-01-01 00:00:00', 'a', 'train', 9D, CAST(NULL AS DOUBLE))",
        "(2, timestamp_ntz'2024-01-01 01:00:00', 'a', 'train', CAST(NULL AS DOUBLE), 1D)",
        "(3, timestamp_ntz'2024-01-01 00:00:00', 'b', 'train', 5D, 2D)",
        "(4, timestamp_ntz'2024-01-01 00:00:00', 'c', 'test', CAST(NULL AS DOUBLE), 0D)",
    ]
    df = spark.sql(sql.format(", ".join(rows)))
    assert df.columns == [c.split()[0] for c in schema.split(", ")]
    train, test = df.filter("type = 'train'"), df.filter("type = 'test'")
    template = test.select("time", "pv_id", "type")
    base = replace(SHORT, val_ratio=0.5)

    def temps(params):
        p = prepare(train, test, template, params)
        both = p.train.select("row_id", "temp_a").union(p.val.select("row_id", "temp_a")).union(p.test.select("row_id", "temp_a"))
        return {r[0]: r[1] for r in both.collect()}

    assert temps(base) == {2: 5.0, 3: 5.0, 4: 0.0}
    assert temps(replace(base, fill_before_filter=True)) == {2: 9.0, 3: 5.0, 4: 0.0}
    assert temps(replace(base, fill_before_filter=True, means_from_train=True))[4] in (5.0, 9.0)


def test_preparation_with_split_groups(spark, trees, monkeypatch):
    """Cutting every series into ranges changes nothing but the plan."""
    monkeypatch.setattr(ranges, "PIECE_ROWS", 100)
    obs = view(spark, SF_DIR, "obs")
    cut = prepare(obs.filter("type = 'train'"), obs.filter("type = 'test'"),
                  view(spark, SF_DIR, "template"), SHORT, max_group_rows=20)
    for ours, theirs in ((cut.train, trees.train), (cut.val, trees.val), (cut.test, trees.test)):
        cols = sorted(ours.columns)
        rounded = [[F.round(c, 9).alias(c) if c in cut.features else c for c in cols]]
        a, b = ours.select(*rounded[0]), theirs.select(*rounded[0])
        assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_hurdle_model(spark, trees, tmp_path):
    params = replace(SHORT, boost_rounds=10, boost_patience=5, boost_sample_fraction=1.0)
    model = fit_hurdle(trees, params)
    scores = model.score(trees.test).select("row_id", "prediction").collect()
    assert len(scores) == trees.test.count()
    assert all(math.isfinite(r["prediction"]) and r["prediction"] >= 0 for r in scores)
    head = model.heads(trees.test).select(F.max(F.abs(sigmoid(F.col("logit")) - F.col("probability")))).first()
    assert head[0] < 1e-12
    model.metrics = evaluate(model, trees.val, params)
    median = trees.train.agg(F.median("nins")).first()[0]
    assert model.metrics["mae"] < trees.val.agg(F.avg(F.abs(F.col("nins") - median))).first()[0]

    path = model.save(str(tmp_path / "m"), spark)
    again = {r["row_id"]: r["prediction"] for r in load_model(spark, path, True).score(trees.test).collect()}
    assert again == {r["row_id"]: r["prediction"] for r in scores}

    result = score_saved_models(trees, replace(params, inference_only=True, model_paths=(path, path)))
    assert result.per_model.count() == 3  # one row per given path, and the ensemble
    assert result.metrics["mae"] == pytest.approx(model.metrics["mae"])
    assert result.submission.count() == trees.template.count()


def test_unsaved_models(spark, trees, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_model(spark, str(tmp_path / "nothing"))
    p = prepared(spark, SF_DIR, replace(SHORT, model="two_head"))
    model = fit_two_head(p, replace(SHORT, model="two_head"))
    model.metrics = {"mae": float("nan")}
    assert model.save(str(tmp_path / "x"), spark) is None
    model.metrics = {"mae": 1.0}
    model.parts.pop("classifier")
    path = model.save(str(tmp_path / "y"), spark)
    with pytest.raises(ValueError):
        load_model(spark, path, need_classifier=True)


def test_two_head_round_trip(spark, tmp_path):
    params = replace(SHORT, model="two_head")
    p = prepared(spark, SF_DIR, params)
    result = train_and_deliver(p, params, str(tmp_path / "m"))
    scores = lambda m: sorted((r["row_id"], r["prediction"]) for r in m.score(p.test).collect())
    assert scores(result.model) == scores(load_model(spark, result.model_path))
    assert result.metrics["mae"] > 0


def test_no_positives_predicts_zero(spark):
    obs = view(spark, SF_DIR, "obs").withColumn("nins", F.lit(0.0))
    p = prepare(obs.filter("type = 'train'"), obs.filter("type = 'test'"), view(spark, SF_DIR, "template"), SHORT)
    model = fit_hurdle(p, SHORT)
    assert "regressor" not in model.parts
    assert {r["prediction"] for r in model.score(p.test).select("prediction").collect()} == {0.0}


def test_first_rounds_do_not_depend_on_later_ones(trees):
    from helioframe.plans.boosted import LABEL
    from helioframe.plans.models import FittedModel
    from helioframe.session import stage

    model = FittedModel("m", [c for c in trees.features if c != "pv_idx"], {})
    rows = stage(model.encode(trees.train).select("_x", (F.col("nins") > 0).cast("double").alias(LABEL)))
    boost = replace(SHORT.boosting(), patience=0)
    long, _, _ = fit_positive_classifier(rows, None, replace(boost, rounds=6), 1, 64)
    short, _, _ = fit_positive_classifier(rows, None, replace(boost, rounds=3), 1, 64)
    trees_of = lambda m: [t.toDebugString.split("\n", 1)[1] for t in m.stages[0].trees]
    assert trees_of(long)[:3] == trees_of(short)
