"""Null and repeated keys, missing scores, times in other spellings, infinite values."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from helioframe.functions import errors as E
from helioframe.functions.calendar import parse_time
from helioframe.operators.columns import attach_by_key
from helioframe.operators.ensemble import ensemble_aligned
from helioframe.operators.groups import missing_groups
from helioframe.operators.metrics import leaderboard
from helioframe.operators.profile import histogram
from helioframe.operators.sampling import label_rows, subsample
from helioframe.operators.submit import KEYS, fill_template
from helioframe.plans.models import FittedModel
from helioframe.session import broadcast_if_small, scratch_path, scratch_run, stage


def test_rows_with_null_keys_are_sampled(frame):
    df = frame([(i if i % 4 else None, i) for i in range(40)], "k int, v int")
    assert {r["split"] for r in label_rows(df, ["k", "v"], 0.6, 1).collect()} == {"train", "valid"}
    assert label_rows(df, ["k", "v"], 0.6, 1).filter("split = 'train'").count() == 24
    assert subsample(df, ["k", "v"], 0.5, 1).count() == 20


def test_null_prediction_keys_match_nothing(frame):
    template = frame([("t1", "a", "test"), (None, "a", "test")], "time string, pv_id string, type string")
    preds = frame([(None, "a", "test", 5.0), (None, "a", "test", 6.0), ("t1", "a", "test", 7.0)], "time string, pv_id string, type string, nins double")
    assert {(r.time, r.nins) for r in fill_template(template, preds).collect()} == {("t1", 7.0), (None, 0.0)}
    assert KEYS == ["time", "pv_id", "type"]


def test_repeated_keys_are_errors(frame):
    long = frame([("a", 1, 1.0), ("a", 1, 2.0), ("b", 1, 3.0)], "model string, k int, p double")
    with pytest.raises(Exception, match="more than one prediction"):
        ensemble_aligned(long, ["k"], ["a", "b"], "p").collect()
    good = long.filter("p <> 2.0")
    assert [tuple(r) for r in ensemble_aligned(good, ["k"], ["a", "b"], "p").collect()] == [(1, 2.0)]
    left = frame([(1,)], "k int")
    with pytest.raises(Exception, match="more than one row"):
        attach_by_key(left, long, ["k"], F.col("p").alias("q")).collect()


def test_null_is_no_missing_group(frame):
    got = missing_groups(frame([("a",), (None,), ("c",)], "g string"), frame([("a",)], "g string"), "g")
    assert [r.g for r in got.collect()] == ["c"]


def test_missing_probability_is_skipped(frame):
    df = frame([(0.0, None), (1.0, 0.5), (None, 0.1)], "l double, p double")
    assert df.agg(E.log_loss(F.col("l"), F.col("p"))).first()[0] == pytest.approx(math.log(2))


def test_missing_scores_have_no_place(frame):
    df = frame([("a", 2.0), ("b", None), ("c", float("nan")), ("d", 1.0)], "m string, mae double")
    assert {r.m: r.place for r in leaderboard(df).collect()} == {"a": 2, "b": None, "c": None, "d": 1}


def test_times_in_other_spellings(frame):
    texts = ["2024-01-01 00:05:00", "2024-01-01T00:10:00", "2024-01-01 00:00:00.5+09:00", "2024-01-01 00:00:00+0900", "2024-01-01 00:00:00+09:00", "junk"]
    df = frame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(F.unix_millis(parse_time(F.col("t"), strict=False))).collect()]
    assert got == [1704067500000, 1704067800000, 1704034800500, 1704034800000, 1704034800000, None]
    with pytest.raises(Exception, match="not a timestamp"):
        df.select(parse_time(F.col("t"))).collect()


def test_histogram_without_infinite_values(frame):
    df = frame([(0.0,), (1.0,), (float("inf"),), (float("-inf"),), (None,)], "v double")
    rows = histogram(df, ["v"], 2).orderBy("bin").collect()
    assert [(r.lower, r.upper, r.n) for r in rows] == [(0.0, 0.5, 1), (0.5, 1.0, 1)]


def test_broadcast_is_bounded_by_bytes(frame, monkeypatch):
    import helioframe.session as session

    df = frame([("x" * 100,)] * 50, "s string")
    plan = lambda d: d._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan(broadcast_if_small(df))
    monkeypatch.setattr(session, "BROADCAST_BYTES", 1000)
    assert "broadcast" not in plan(broadcast_if_small(df))


def test_scratch_is_deleted(spark, frame):
    import os

    with scratch_run(spark):
        path = scratch_path(spark, "x")
        assert stage(frame([(1,)], "a int")).count() == 1
        folder = os.path.dirname(path.removeprefix("file:"))
        assert os.listdir(folder)
    assert not os.path.exists(folder)


@pytest.mark.parametrize("groups", [50, 1500])
def test_group_codes_have_one_width_at_every_size(frame, groups):
    df = frame([(1.0, i) for i in range(groups)] + [(1.0, None)], "a double, pv_idx int")
    model = FittedModel("m", ["a", "pv_idx"], {}, nominal="pv_idx", codes=254)
    encoded = model.encode(df)
    assert encoded.schema["_x"].metadata["ml_attr"]["attrs"]["nominal"][0]["num_vals"] == 255
    codes = [r["_x"][1] for r in encoded.collect()]
    assert codes == [float(i % 254) for i in range(groups)] + [254.0]
