"""Distinct ids, vocabularies and category levels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.operators.ranges import range_positions
from helioframe.session import broadcast_if_small


def distinct_ids(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()


def union_ids(frames: list[DataFrame], key: str) -> DataFrame:
    """Distinct ids over several frames; each frame is reduced before the union."""
    return reduce(DataFrame.union, [distinct_ids(f, key) for f in frames]).distinct()


def index_groups(frames: list[DataFrame], key: str, name: str = "pv_idx") -> DataFrame:
    """Sorted ids numbered 0..n-1."""
    ids = union_ids(frames, key).filter(F.col(key).isNotNull())
    return range_positions(ids, [key], name).withColumn(name, F.col(name).cast("int"))


def lookup_index(df: DataFrame, vocabulary: DataFrame, key: str) -> DataFrame:
    """Attach the index of ``key``; unknown ids get null."""
    return df.join(broadcast_if_small(vocabulary), key, "left")


def align_levels(df: DataFrame, column: str, levels: DataFrame, name: str | None = None) -> DataFrame:
    """Keep values that are among ``levels`` (same column name), others become null."""
    known = broadcast_if_small(levels.select(F.col(column).alias("_level")).distinct())
    out = df.join(known, F.col(column) == F.col("_level"), "left")
    return out.withColumn(name or column, F.col("_level")).drop("_level")


def missing_groups(wanted: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Ids of ``wanted`` that do not occur in ``present``; a null is no id."""
    return distinct_ids(wanted.filter(F.col(key).isNotNull()), key).join(distinct_ids(present, key), key, "left_anti")
