"""Standardisation with statistics fitted on one split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.functions.scalars import standardise
from helioframe.operators.fill import one_row


def fit_scaler(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row: mean and population standard deviation per column, NaN ignored."""
    stats = []
    for c in cols:
        value = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        stats += [F.avg(value).alias(f"{c}__mean"), F.stddev_pop(value).alias(f"{c}__std")]
    return df.agg(*stats)


def apply_scaler(df: DataFrame, stats: DataFrame, cols: list[str]) -> DataFrame:
    s = F.col("_scaler")
    return (
        df.withColumn("_scaler", one_row(stats))
        .withColumns({c: standardise(F.col(c), s[f"{c}__mean"], s[f"{c}__std"]) for c in cols})
        .drop("_scaler")
    )
