"""Delivery of predictions against a template."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.functions.scalars import default_prediction

KEYS = ["time", "pv_id", "type"]


def one_per_key(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``keys`` and ``value``; a repeated key is an error when the result is computed.

    Rows with a null key can match nothing and are left out. The check is part of the
    grouping, which shares its shuffle with a later join on the keys.
    """
    known = df.select(*keys, value).dropna(subset=keys)
    grouped = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first(value).alias("_v"))
    problem = F.raise_error(F.lit(f"more than one row for some key {keys}"))
    return grouped.select(*keys, F.when(F.col("_n") > 1, problem).otherwise(F.col("_v")).alias(value))


def fill_template(
    template: DataFrame,
    preds: DataFrame,
    keys: list[str] = KEYS,
    p: str = "nins",
    default: float = 0.0,
    check_unique: bool = True,
) -> DataFrame:
    """Template rows with their prediction, or ``default`` where there is none.

    Repeated prediction keys would multiply template rows and are an error. The
    join is a plain shuffle join, which adaptive execution splits on skewed keys.
    """
    known = one_per_key(preds, keys, p) if check_unique else preds.select(*keys, p)
    joined = template.select(*keys).join(known, keys, "left")
    return joined.withColumn(p, default_prediction(F.col(p), default))
