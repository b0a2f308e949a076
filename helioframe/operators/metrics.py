"""Evaluation tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helioframe.functions import errors as E
from helioframe.operators.ranges import global_rank


def error_columns(y: Column, p: Column, nmape_constant: float | None = None) -> dict[str, Column]:
    """MAE, MSE, RMSE and normalised MAE, all from one aggregate."""
    scaled = E.nmape(y, p) if nmape_constant is None else E.nmape_by_constant(y, p, nmape_constant)
    return {"mae": E.mae(y, p), "mse": E.mse(y, p), "rmse": E.rmse(y, p), "nmape": scaled}


def log_error_columns(y: Column, p: Column) -> dict[str, Column]:
    """MSLE and its root; inputs must be above -1."""
    return {"msle": E.msle(y, p), "rmsle": E.rmsle(y, p)}


def regression_metrics(
    df: DataFrame,
    y: str,
    p: str,
    by: tuple[str, ...] = (),
    *,
    nmape_constant: float | None = None,
    log_errors: bool = False,
) -> DataFrame:
    """One row of metrics, or one per ``by`` group."""
    yc, pc = F.col(y), F.col(p)
    cols = {"n": F.count(yc - pc)} | error_columns(yc, pc, nmape_constant)
    if log_errors:
        cols |= log_error_columns(yc, pc)
    return df.groupBy(*by).agg(*[c.alias(n) for n, c in cols.items()])


def error_sums(df: DataFrame, y: str, p: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Mergeable state of the normalised MAE: add the sums of any two states."""
    both = F.col(y).isNotNull() & F.col(p).isNotNull()
    return df.filter(both).groupBy(*by).agg(
        F.sum(F.abs(F.col(y) - F.col(p))).alias("abs_error"),
        F.sum(F.abs(F.col(y))).alias("abs_target"),
        F.count(F.lit(1)).alias("n"),
    )


def finish_error_sums(states: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Normalised MAE from any number of states; no examples at all is an error."""
    merged = states.groupBy(*by).agg(
        F.sum("abs_error").alias("abs_error"),
        F.sum("abs_target").alias("abs_target"),
        F.sum("n").alias("n"),
    )
    value = E.nmae_from_sums(F.col("abs_error"), F.col("abs_target"), F.col("n"))
    return merged.select(*by, F.col("n"), value.alias("nmae"))


def two_head_loss(
    df: DataFrame,
    y: str,
    logit: str,
    magnitude: str,
    *,
    bce_weight: float = 1.0,
    regression_weight: float = 1.0,
    threshold: float = 0.0,
    smoothing: float = 0.0,
    by: tuple[str, ...] = (),
) -> DataFrame:
    bce, size = E.two_head_terms(
        F.col(y), F.col(logit), F.col(magnitude), threshold, smoothing
    )
    total = F.lit(float(bce_weight)) * bce + F.lit(float(regression_weight)) * size
    return df.groupBy(*by).agg(
        bce.alias("classification_loss"), size.alias("regression_loss"), total.alias("loss")
    )


def leaderboard(scores: DataFrame, metric: str = "mae", name: str = "place") -> DataFrame:
    """Rank entries by ascending error; equal errors share a place.

    Entries without an error, or with NaN, have no place.
    """
    valid = F.col(metric).isNotNull() & ~F.isnan(F.col(metric).cast("double"))
    ranked = global_rank(scores.filter(valid), metric, name)
    return ranked.unionByName(scores.filter(~valid).withColumn(name, F.lit(None).cast(ranked.schema[name].dataType)))
