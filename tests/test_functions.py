from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from helioframe.functions import errors as E
from helioframe.functions import scalars as S
from helioframe.functions.calendar import add_time_features, ensure_timestamp
from helioframe.operators.groups import align_levels
from helioframe.operators.metrics import error_sums, finish_error_sums, regression_metrics, two_head_loss
from helioframe.operators.scale import apply_scaler, fit_scaler


def test_difference_needs_both_columns_and_both_values(frame):
    df = S.add_differences(frame([(1.0, None), (None, 2.0), (5.0, 2.0)], "temp_a double, temp_b double"))
    assert df.columns == ["temp_a", "temp_b", "temp_diff_ab"]
    assert [r["temp_diff_ab"] for r in df.collect()] == [None, None, 3.0]


def test_clamp_keeps_null_and_nan(frame):
    got = [r[0] for r in frame([(-1.0,), (None,), (math.nan,), (2.0,)], "v double").select(S.clamp_negative(F.col("v"))).collect()]
    assert got[:2] == [0.0, None] and math.isnan(got[2]) and got[3] == 2.0


def test_bad_time_is_null_or_an_error(frame):
    rows = [("2024-01-01 00:00:00+09:00",), ("2024-01-01 00:00:00+0900",), ("junk",)]
    df = frame(rows, "t string")
    expected = [1704034800, 1704034800, None]
    assert [r[0] for r in ensure_timestamp(df, "t").select(F.unix_seconds("t")).collect()] == expected
    with pytest.raises(Exception, match="not a timestamp"):
        ensure_timestamp(df, "t", strict=True).collect()


def test_weekday_runs_from_monday_to_sunday(frame):
    df = frame([("2024-01-01 10:05:00+00:00",), ("2024-01-07 10:05:00+00:00",)], "t string")
    assert [r["weekday"] for r in add_time_features(df, "t").collect()] == [1, 7]


def test_local_hour(frame):
    df = frame([("2024-01-01 00:00:00+00:00",)], "t string")
    assert add_time_features(df, "t", tz="Asia/Seoul").first()["hour"] == 9
    assert add_time_features(df, "t").first()["hour"] == 0


def test_constant_feature_scales_to_zero(frame):
    df = frame([(7.0, 1.0), (7.0, 3.0), (7.0, 8.0)], "a double, b double")
    out = apply_scaler(df, fit_scaler(df, ["a", "b"]), ["a", "b"]).collect()
    assert [r["a"] for r in out] == [0.0, 0.0, 0.0]
    b = [r["b"] for r in out]
    assert sum(b) == pytest.approx(0.0) and sum(x * x for x in b) / 3 == pytest.approx(1.0)


def test_nmape_of_zero_targets_is_zero(frame):
    df = frame([(0.0, 1.0), (0.0, 2.0)], "y double, p double")
    assert regression_metrics(df, "y", "p").first()["nmape"] == 0.0


def test_incremental_nmae(frame):
    df = frame([("a", 1.0, 2.0), ("b", 3.0, 5.0), ("b", 2.0, 2.0)], "g string, y double, p double")
    whole = finish_error_sums(error_sums(df, "y", "p")).first()["nmae"]
    assert finish_error_sums(error_sums(df, "y", "p", ("g",))).first()["nmae"] == pytest.approx(whole)
    assert whole == pytest.approx(1.0 / (2.0 + 1e-6) * 100)
    with pytest.raises(Exception, match="at least one example"):
        finish_error_sums(error_sums(df.filter("false"), "y", "p")).collect()


def test_two_head_loss_by_hand(frame):
    rows = [(0.0, 0.5, 3.0), (4.0, -1.0, 3.5), (9.0, 2.0, 4.0)]
    got = two_head_loss(frame(rows, "y double, z double, s double"), "y", "z", "s", smoothing=0.7).first()
    s = 0.499
    bce = sum(
        math.log(1 + math.exp(z)) - z * ((1 - s if y > 0 else 0) + 0.5 * s) for y, z, _ in rows
    ) / 3
    assert got["classification_loss"] == pytest.approx(bce)
    assert got["regression_loss"] == pytest.approx((0.125 + 4.5) / 2)
    assert got["loss"] == pytest.approx(bce + 2.3125)


def test_two_head_loss_without_positives(frame):
    df = frame([(0.0, 0.5, 3.0)], "y double, z double, s double")
    assert two_head_loss(df, "y", "z", "s").first()["regression_loss"] == 0.0


def test_log_loss_is_finite_at_certainty(frame):
    df = frame([(1.0, 0.0), (0.0, 0.0)], "l double, p double")
    assert math.isfinite(df.agg(E.log_loss(F.col("l"), F.col("p"))).first()[0])


def test_unseen_level_becomes_null(frame):
    got = align_levels(frame([("a",), ("z",)], "c string"), "c", frame([("a",), ("b",)], "c string")).collect()
    assert {r["c"] for r in got} == {"a", None}
