"""Combining the predictions of several models."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helioframe.operators.metrics import regression_metrics


def stack_models(frames: dict[str, DataFrame], model: str = "model") -> DataFrame:
    """Long form: the frames of all models under a model label."""
    labelled = [f.withColumn(model, F.lit(name)) for name, f in frames.items()]
    return reduce(DataFrame.unionByName, labelled)


def unstack_columns(df: DataFrame, keep: list[str], models: list[str], p: str = "pred") -> DataFrame:
    """Long form from one prediction column per model, in one pass without a shuffle."""
    entries = F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias(p)) for m in models])
    return df.select(*keep, F.explode(entries).alias("_e")).select(*keep, "_e.model", f"_e.{p}")


def ensemble_mean(long: DataFrame, keys: list[str], p: str, name: str = "pred") -> DataFrame:
    """Mean over the models that predict a key; missing predictions are skipped."""
    return long.groupBy(*keys).agg(F.avg(p).alias(name))


def ensemble_aligned(
    long: DataFrame, keys: list[str], models: list[str], p: str, name: str = "pred",
    model: str = "model",
) -> DataFrame:
    """Sum over all models divided by their number, for keys that every model has.

    Null as soon as one model is null. One grouping aligns any number of models,
    where joining them one by one would shuffle once per model. A key that one model
    predicts twice is an error when the result is computed.
    """
    is_model = [F.col(model) == m for m in models]
    counts = [F.count_if(m) for m in is_model]
    value = reduce(Column.__add__, [F.max(F.when(m, F.col(p))) for m in is_model])
    problem = F.raise_error(F.lit(f"more than one prediction of a model for some key {keys}"))
    return (
        long.groupBy(*keys)
        .agg(
            (value / F.lit(len(models))).alias("_mean"),
            F.least(*counts, F.lit(1)).alias("_fewest"), F.greatest(*counts, F.lit(1)).alias("_most"),
        )
        .withColumn(name, F.when(F.col("_most") > 1, problem).otherwise(F.col("_mean")))
        .filter("_fewest > 0")
        .select(*keys, name)
    )


def row_mean(models: list[str]) -> Column:
    """Ensemble mean of prediction columns on the same row; null if any is null."""
    return reduce(Column.__add__, [F.col(m) for m in models]) / F.lit(len(models))


def ensemble_report(
    long: DataFrame, keys: list[str], y: str, p: str, model: str = "model"
) -> DataFrame:
    """Metrics of every model and of their mean, labelled ``ensemble``."""
    each = regression_metrics(long, y, p, (model,))
    joint = long.groupBy(*keys).agg(F.avg(p).alias(p), F.first(y).alias(y))
    whole = regression_metrics(joint, y, p).withColumn(model, F.lit("ensemble"))
    return each.unionByName(whole)
