from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from helioframe.operators import ranges
from helioframe.operators.fill import bfill, ffill, fill_missing

SCHEMA = "g string, t int, tb int, v double, w double"


def _values(df, col="v"):
    return {(r["g"], r["t"], r["tb"]): r[col] for r in df.collect()}


def panel(seed: int = 3, rows: int = 900):
    """Unsorted panel: one group has most rows, times repeat, one group is null."""
    rnd = random.Random(seed)
    out = []
    for i in range(rows):
        g = rnd.choices(["hot", "a", "b", "empty", None], [60, 15, 15, 5, 5])[0]
        v = rnd.choice([None, None, None, float(rnd.randrange(50))])
        w = None if rnd.random() < 0.97 else float(rnd.randrange(50))
        out.append((g, rnd.randrange(40), i, None if g == "empty" else v, w))
    return out


def brute(rows, col, forward):
    """Reference fill on plain Python rows."""
    out = {}
    for g in {r[0] for r in rows}:
        series = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2]))
        carried = None
        for r in series if forward else reversed(series):
            carried = r[col] if r[col] is not None else carried
            out[(g, r[1], r[2])] = carried
    return out


@pytest.mark.parametrize("limit", [None, 10_000, 50])
@pytest.mark.parametrize("forward", [True, False])
def test_directional(frame, forward, limit):
    rows = panel()
    fill = ffill if forward else bfill
    got = fill(frame(rows, SCHEMA), ["g"], ["t", "tb"], ["v", "w"], limit, 20)
    assert got.columns == ["g", "t", "tb", "v", "w"]
    assert _values(got) == brute(rows, 3, forward)
    assert _values(got, "w") == brute(rows, 4, forward)


@pytest.mark.parametrize("limit", [None, 50])
@pytest.mark.parametrize("staged", [False, True])
def test_fill_missing(frame, limit, staged):
    rows = panel(seed=8)
    forward = brute(rows, 3, True)
    both = brute([(*r[:3], forward[r[:3]]) for r in rows], 3, False)
    known = [v for v in both.values() if v is not None]
    mean = sum(known) / len(known)
    got = _values(
        fill_missing(
            frame(rows, SCHEMA), ["g"], ["t", "tb"], ["v"],
            staged=staged, max_group_rows=limit, piece_rows=20,
        )
    )
    assert got.keys() == both.keys()
    for key, value in both.items():
        assert got[key] == pytest.approx(mean if value is None else value)
    for r in rows:
        if r[3] is not None:
            assert got[r[:3]] == r[3]


def test_split_rows_reach_many_pieces(frame):
    series = ranges.as_series(frame(panel(), SCHEMA), ["g"], ["t", "tb"], 50, 20)
    sizes = series.split.groupBy(ranges.CHUNK).count().collect()
    assert len(sizes) >= 10
    assert max(r["count"] for r in sizes) < 200
    assert series.df.count() == 900


def test_one_moment_with_many_rows_is_split(frame):
    rows = [("hot", 1, i, float(i) if i == 0 else None, None) for i in range(400)]
    series = ranges.as_series(frame(rows, SCHEMA), ["g"], ["t", "tb"], 50, 20)
    assert series.split.select(ranges.CHUNK).distinct().count() >= 10
    got = ffill(frame(rows, SCHEMA), ["g"], ["t", "tb"], ["v"], 50, 20)
    assert {r["v"] for r in got.collect()} == {0.0}


def _filled(frame, rows):
    df = frame([(g, t, 0, v, None) for g, t, v in rows], SCHEMA)
    return {(g, t): v for (g, t, _), v in _values(fill_missing(df, ["g"], ["t", "tb"], ["v"])).items()}


def test_nan_is_a_value(frame):
    got = _filled(frame, [("p1", 1, None), ("p1", 2, math.nan), ("p1", 3, 3.0)])
    assert math.isnan(got["p1", 1]) and math.isnan(got["p1", 2]) and got["p1", 3] == 3.0


def test_whole_group_missing_gets_the_mean(frame):
    assert _filled(frame, [("p1", 1, 2.0), ("p1", 2, 4.0), ("p2", 1, None)])["p2", 1] == 3.0


def test_whole_column_missing_gets_zero(frame):
    assert _filled(frame, [("p1", 1, None)]) == {("p1", 1): 0.0}


def test_forward_comes_before_backward(frame):
    got = _filled(frame, [("p1", 1, None), ("p1", 2, 5.0), ("p1", 3, None), ("p1", 4, 7.0)])
    assert [got["p1", t] for t in (1, 2, 3, 4)] == [5.0, 5.0, 5.0, 7.0]


def test_means_of_a_subset(frame):
    df = frame([("a", 1, 0, 2.0, None), ("b", 1, 0, 10.0, None), ("c", 1, 0, None, None)], SCHEMA)
    got = _values(fill_missing(df, ["g"], ["t"], ["v"], means_of=F.col("g") == "a"))
    assert got["c", 1, 0] == 2.0


def test_plan_has_one_shuffle_and_one_window(frame, capsys):
    df = frame(panel(), SCHEMA).select("g", "t", "tb", "v", "w")
    ranges.fill_both_ways(ranges.as_series(df, ["g"], ["t", "tb"]), ["v", "w"]).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange") == 1 and plan.count("Window [") == 1 and plan.count("Sort [") == 1


def test_columns_with_a_gap_are_known_from_the_group_counts(frame):
    """Preparation fills only columns that have a null somewhere; NaN is a value."""
    df = frame([("a", 1.0, None, math.nan), ("b", 2.0, 1.0, 1.0), (None, 3.0, 1.0, 1.0)], "g string, u double, v double, w double")
    sizes = ranges.group_sizes(df, ["g"], ["u", "v", "w"])
    assert ranges.with_gaps(sizes, ["u", "v", "w"]) == ["v"]
    assert {r["g"]: r["_rows"] for r in sizes.collect()} == {"a": 1, "b": 1, None: 1}
    assert ranges.with_gaps(ranges.group_sizes(df.limit(0), ["g"], ["u"]), ["u"]) == []
