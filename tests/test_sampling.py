from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from helioframe.operators.filters import non_members, require_groups
from helioframe.operators.sampling import label_groups, label_rows, nth_hash, split_by_group, subsample


def _groups(spark, n, copies=3):
    return spark.range(n * copies).select(F.concat(F.lit("pv"), F.col("id") % n).alias("g"), "id")


@pytest.mark.parametrize("n, held", [(2, 1), (5, 1), (10, 2), (14, 4)])
def test_group_split_size_rounds_half_to_even(spark, n, held):
    train, val = split_by_group(_groups(spark, n), "g", 0.25, 7)
    ours = {r["g"] for r in val.select("g").distinct().collect()}
    theirs = {r["g"] for r in train.select("g").distinct().collect()}
    assert len(ours) == held and len(theirs) == n - held and not ours & theirs
    assert train.count() + val.count() == 3 * n
    by_hash = sorted((f"pv{i}" for i in range(n)), key=lambda g: hashlib.md5(f"7|{g}".encode()).hexdigest())
    assert ours == set(by_hash[:held])


def test_one_group_is_an_error(spark):
    with pytest.raises(ValueError):
        require_groups(_groups(spark, 1), "g")
    with pytest.raises(Exception, match="two groups"):
        label_groups(_groups(spark, 1), "g", 0.25, 7).collect()


def test_null_group_is_in_neither_split(frame):
    df = frame([("a",), ("b",), (None,)], "g string")
    train, val = split_by_group(df, "g", 0.5, 1)
    assert train.count() == 1 and val.count() == 1
    assert non_members(df, "g", frame([("a",)], "g string")).count() == 1


def test_row_split_is_exact_and_repeatable(spark):
    df = spark.range(997)
    marked = label_rows(df, ["id"], 0.8, 3)
    counts = {r["split"]: r["count"] for r in marked.groupBy("split").count().collect()}
    assert counts == {"train": 797, "valid": 200}
    again = label_rows(df.repartition(5), ["id"], 0.8, 3)
    assert marked.exceptAll(again).count() == 0


@pytest.mark.parametrize("n, fraction, size", [(100, 0.4, 40), (7, 0.4, 2), (3, 0.1, 1), (9, 1.0, 9), (9, 0.0, 9)])
def test_subsample_size(spark, n, fraction, size):
    assert subsample(spark.range(n), ["id"], fraction, 1).count() == size


def test_split_is_a_filter_without_a_join(spark, capsys):
    label_groups(_groups(spark, 10), "g", 0.2, 1).explain()
    assert "Join" not in capsys.readouterr().out


def test_no_values_have_no_nth_hash(frame):
    """The size of a sample comes from the first count, so there is no pass that only counts."""
    assert nth_hash(frame([], "_h string"), lambda n: 1) is None
    assert nth_hash(frame([("00",), ("ff",)], "_h string"), lambda n: 0) is None
    assert nth_hash(frame([("00",), ("ff",)], "_h string"), lambda n: n) == "ff"
