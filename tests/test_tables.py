from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helioframe.operators.ensemble import ensemble_aligned, ensemble_mean, stack_models
from helioframe.operators.profile import corr_matrix, describe, histogram, quantiles
from helioframe.operators.runs import best_runs, early_stop, training_progress
from helioframe.operators.submit import fill_template
from helioframe.catalog.sources import FILE_COLUMNS, write_trio
from helioframe.sources.tables import SUBMISSION_SCHEMA, read_panel, read_predictions, read_trio, write_delivery

KEYS = "time string, pv_id string, type string"


def test_template_key_without_prediction_gets_zero(frame):
    template = frame([("t1", "a", "test"), ("t2", "a", "test")], KEYS)
    preds = frame([("t1", "a", "test", 5.0)], KEYS + ", nins double")
    assert {r["time"]: r["nins"] for r in fill_template(template, preds).collect()} == {"t1": 5.0, "t2": 0.0}


def test_repeated_prediction_key_is_an_error(frame):
    template = frame([("t1", "a", "test")], KEYS)
    preds = frame([("t1", "a", "test", 5.0), ("t1", "a", "test", 6.0)], KEYS + ", nins double")
    with pytest.raises(Exception, match="more than one row"):
        fill_template(template, preds).collect()


def test_ensembles_differ_on_missing_predictions(frame):
    a = frame([("k1", 1.0), ("k2", 2.0), ("k3", 3.0)], "k string, p double")
    b = frame([("k1", 3.0), ("k2", None)], "k string, p double")
    long = stack_models({"a": a, "b": b})
    assert {r["k"]: r["pred"] for r in ensemble_mean(long, ["k"], "p").collect()} == {"k1": 2.0, "k2": 2.0, "k3": 3.0}
    assert {r["k"]: r["pred"] for r in ensemble_aligned(long, ["k"], ["a", "b"], "p").collect()} == {"k1": 2.0, "k2": None}


def _early_stop(values, patience):
    best, count, best_epoch = float("inf"), 0, None
    for epoch, v in enumerate(values):
        if v is not None and v == v and v < best:
            best, count, best_epoch = v, 0, epoch
        else:
            count += 1
            if count >= patience:
                return epoch, best_epoch, None if best_epoch is None else best
    return None, best_epoch, None if best_epoch is None else best


@pytest.mark.parametrize("limit", [None, 20])
def test_early_stop_equals_a_loop(frame, limit):
    rnd = random.Random(2)
    runs = {
        f"r{i}": [rnd.choice([None, float("nan"), *[float(rnd.randrange(50)) for _ in range(6)]])
                  for _ in range(200 if i == 0 else 30)]
        for i in range(12)
    }
    rows = [(r, e, v) for r, vs in runs.items() for e, v in enumerate(vs)]
    df = frame(rows, "run string, epoch int, mae double").repartition(7)
    got = {r["run"]: (r["stop_epoch"], r["best_epoch"], r["best_mae"])
           for r in early_stop(df, "run", "epoch", "mae", 5, limit, 25).collect()}
    assert got == {r: _early_stop(vs, 5) for r, vs in runs.items()}


def test_progress_counts_from_the_last_gain(frame):
    df = frame([("r", e, v) for e, v in enumerate([3.0, 3.0, None, 2.0, 5.0])], "run string, epoch int, mae double")
    got = sorted((r["epoch"], r["improved"], r["epochs_without_gain"]) for r in
                 training_progress(df, "run", "epoch", "mae").collect())
    assert got == [(0, True, 0), (1, False, 1), (2, False, 2), (3, True, 0), (4, False, 1)]


def test_best_runs_skip_values_that_are_not_finite(frame):
    values = [float("inf"), 2.0, None, 1.0, 2.0, float("nan")]
    df = frame([("r", e, v) for e, v in enumerate(values)], "run string, epoch int, mae double")
    got = sorted((r["place"], r["epoch"]) for r in best_runs(df, "run", "epoch", "mae", 2).collect())
    assert got == [(1, 3), (2, 1)]
    assert best_runs(df, "run", "epoch", "mae", 0).count() == 1


def test_best_runs_limits_before_the_shuffle(frame, capsys):
    df = frame([("r", 1, 1.0)], "run string, epoch int, mae double")
    best_runs(df, "run", "epoch", "mae", 3).explain()
    assert "WindowGroupLimit" in capsys.readouterr().out


@pytest.mark.parametrize("accuracy, small_rows", [(100, 10**6), (100, 0), (3, 0)])
@pytest.mark.parametrize("rule", ["nearest", "linear"])
def test_quantiles_equal_brute_force(spark, rule, accuracy, small_rows):
    rnd = np.random.default_rng(4)
    n = 4000
    a = np.where(rnd.random(n) < 0.4, 3.0, rnd.normal(size=n).round(4) * 10)
    b = rnd.exponential(size=n)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double").repartition(6)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {(r["column_name"], r["prob"]): r["value"] for r in
           quantiles(df, ["a", "b"], probs, rule, accuracy=accuracy, small_rows=small_rows).collect()}
    for name, values in (("a", np.sort(a)), ("b", np.sort(b))):
        for p in probs:
            exact = np.quantile(values, p) if rule == "linear" else values[int(np.floor((n - 1) * p + 0.5))]
            assert got[name, p] == pytest.approx(exact, rel=1e-12), (name, p)


def test_describe_of_an_empty_column(frame):
    df = frame([(1.0, None), (2.0, None), (4.0, None)], "a double, b double")
    rows = {r["column_name"]: r for r in describe(df, ["a", "b"]).collect()}
    assert rows["a"]["q50"] == 2.0 and rows["a"]["count"] == 3
    assert rows["b"]["q50"] is None and rows["b"]["null_count"] == 3 and rows["b"]["mean"] is None
    rough = {r["column_name"]: r for r in describe(df, ["a", "b"], approximate=True).collect()}
    assert rough["a"]["q50"] == 2.0


def test_histogram_covers_all_bins(frame):
    df = frame([(0.0, 5.0), (1.0, 5.0), (20.0, None)], "a double, c double")
    got = {(r["column_name"], r["bin"]): r["n"] for r in histogram(df, ["a", "c"]).collect()}
    assert len(got) == 40 and sum(got.values()) == 5
    assert got["a", 0] == 1 and got["a", 1] == 1 and got["a", 19] == 1 and got["c", 10] == 2


def test_correlation_is_symmetric(spark):
    df = spark.range(50).select(
        F.col("id").alias("a"), (-F.col("id")).alias("b"), F.lit(1.0).alias("flat"),
        F.lit(None).cast("double").alias("none"),
    )
    got = {(r["column_x"], r["column_y"]): r["corr"] for r in corr_matrix(df, df.columns).collect()}
    assert len(got) == 16 and got["a", "flat"] is got["none", "b"] is got["flat", "flat"] is None
    assert got["a", "b"] == got["b", "a"] == pytest.approx(-1.0) and got["a", "a"] == pytest.approx(1.0)


def test_delivery_round_trip(spark, frame, tmp_path):
    df = frame([("2024-01-01 00:00:00+00:00", "a", "test", 1.5)], KEYS + ", nins double")
    path = str(tmp_path / "m1.csv")
    write_delivery(df, path, single_file=True)
    back = read_panel(spark, path, schema=df.schema)
    assert back.first()["nins"] == 1.5
    write_delivery(back, str(tmp_path / "m2.csv"))
    both = read_predictions(spark, [path, str(tmp_path / "m2.csv")])
    assert {r["model"] for r in both.collect()} == {"m1", "m2"}
    assert both.select("time").distinct().count() == 1


def test_observations_of_one_second_stay_apart(spark, frame, tmp_path):
    """Two observations of one plant in one second have different keys, in the inputs and in the delivery."""
    events = spark.sql("""SELECT * FROM VALUES
        (0L, timestamp_ntz'2024-01-01 10:49:26.417201', 5L, 1D), (1L, timestamp_ntz'2024-01-01 10:49:26.476071', 5L, 2D),
        (2L, timestamp_ntz'2024-01-01 10:49:27', 5L, 3D) AS t(event_id, ts, user_id, value)""")
    events.write.parquet(str(tmp_path / "events.parquet"))
    raw = read_trio(spark, write_trio(spark, str(tmp_path)), FILE_COLUMNS)
    out = fill_template(raw.template, raw.test)
    assert sorted(r["nins"] for r in out.filter("year(time) = 2024").collect()) == [0.0, 2.0, 3.0]
    write_delivery(out, str(tmp_path / "sent.csv"))
    back = read_panel(spark, str(tmp_path / "sent.csv"), SUBMISSION_SCHEMA)
    assert back.exceptAll(out.select(*back.columns)).isEmpty() and back.select("time").distinct().count() == out.count()
    texts = {r[0] for r in spark.read.option("header", True).csv(str(tmp_path / "sent.csv")).select("time").collect()}
    assert "2024-01-01 10:49:27+00:00" in texts and "2024-01-01 10:49:26.417201+00:00" in texts
