"""Row filters and guards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helioframe.session import broadcast_if_small, stage


def with_target(df: DataFrame, target: str) -> DataFrame:
    return df.filter(F.col(target).isNotNull())


def _listed(ids: DataFrame, key: str) -> DataFrame:
    return broadcast_if_small(stage(ids.select(key).distinct(), "ids"))


def members(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    return df.join(_listed(ids, key), key, "left_semi")


def non_members(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows outside ``ids``; a null key is neither in nor out."""
    return df.filter(F.col(key).isNotNull()).join(_listed(ids, key), key, "left_anti")


def positives(df: DataFrame, target: str, threshold: float = 0.0) -> DataFrame:
    return df.filter(F.col(target) > F.lit(float(threshold)))


def complete_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows without null or NaN in ``cols``."""
    return df.na.drop(subset=cols)


def any_match(condition: Column) -> Column:
    """True if the condition holds in any row; false for no rows."""
    return F.coalesce(F.bool_or(condition), F.lit(False))


def require_groups(df: DataFrame, group: str, minimum: int = 2) -> None:
    """Fail unless at least ``minimum`` distinct non-null groups exist."""
    found = df.filter(F.col(group).isNotNull()).select(group).distinct().limit(minimum).count()
    if found < minimum:
        raise ValueError(f"need at least {minimum} groups in {group!r}, found {found}")
