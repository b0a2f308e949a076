"""Projections and schema operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helioframe.operators.ranges import range_positions
from helioframe.operators.submit import one_per_key


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Integer and floating columns in schema order."""
    skip = set(exclude)
    kinds = (T.IntegralType, T.FractionalType)
    return [f.name for f in df.schema if isinstance(f.dataType, kinds) and f.name not in skip]


def feature_columns(df: DataFrame, exclude: Iterable[str]) -> list[str]:
    """Sorted numeric columns outside ``exclude``."""
    return sorted(numeric_columns(df, exclude))


def columns_except(df: DataFrame, exclude: Iterable[str]) -> DataFrame:
    skip = set(exclude)
    return df.select(*[c for c in df.columns if c not in skip])


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def canonical_names(df: DataFrame, time: str, group: str) -> DataFrame:
    wanted = {time: "time", group: "pv_id"}
    return df.withColumnsRenamed({a: b for a, b in wanted.items() if a != b})


def with_default_type(df: DataFrame, value: str = "test") -> DataFrame:
    return df if "type" in df.columns else df.withColumn("type", F.lit(value))


def meta_columns(df: DataFrame, time: str, group: str) -> DataFrame:
    """Key columns of a frame to be scored, under their canonical names."""
    keep = [c for c in (time, group, "type") if c in df.columns]
    return with_default_type(canonical_names(df.select(*keep), time, group))


def assemble(
    df: DataFrame, cols: list[str], name: str = "features", invalid: str = "error"
) -> DataFrame:
    """Dense feature vector beside the keys; ``invalid`` is error, keep or skip."""
    return VectorAssembler(inputCols=cols, outputCol=name, handleInvalid=invalid).transform(df)


def attach_by_key(df: DataFrame, values: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """Attach a computed column from another frame by key, never by position.

    A repeated key in ``values`` would multiply rows and is an error.
    """
    added = values.select(*keys, value)
    return df.join(one_per_key(added, keys, added.columns[-1]), keys, "left")


def row_index(df: DataFrame, order: list[str], name: str = "row_idx") -> DataFrame:
    """0-based global row number in ``order``."""
    return range_positions(df, order, name)
