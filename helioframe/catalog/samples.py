"""Splits and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helioframe.catalog import register
from helioframe.catalog.common import SEED
from helioframe.fixtures import duck, view
from helioframe.operators.sampling import label_groups, label_rows, subsample

_ID = "CAST(row_id AS BIGINT) AS row_id"

HELD_OUT = (
    "held AS (SELECT pv_id FROM (SELECT pv_id, row_number() OVER (ORDER BY md5('42|' || pv_id)) AS pos, "
    "count(*) OVER () AS n FROM (SELECT DISTINCT pv_id FROM {source})) "
    "WHERE pos <= greatest(1, least(CAST(round_even(n * 0.2e0, 0) AS BIGINT), n - 1)))"
)
_ROW_HASH = "md5('42|' || CAST(row_id AS VARCHAR))"


@register(
    "x1_group_split",
    duck(
        "SELECT pv_id, CASE WHEN pv_id IN (SELECT pv_id FROM held) THEN 'val' ELSE 'train' END AS split, "
        "count(*) AS n_rows FROM obs GROUP BY pv_id",
        HELD_OUT.format(source="obs"),
    ),
)
def x1_group_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = label_groups(view(spark, sf_dir, "obs").select("pv_id"), "pv_id", 0.2, SEED)
    return marked.groupBy("pv_id", "split").agg(F.count(F.lit(1)).alias("n_rows"))


_ROWS = f"""SELECT {_ID}, CASE WHEN row_number() OVER (ORDER BY {_ROW_HASH}) <= floor(count(*) OVER () * 0.8e0)
  THEN 'train' ELSE 'valid' END AS split FROM obs"""


@register("x2_row_split", duck(_ROWS))
def x2_row_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_rows(view(spark, sf_dir, "obs").select("row_id"), ["row_id"], 0.8, SEED)


@register(
    "x2_row_split_threshold",
    duck(
        f"""SELECT {_ID}, CASE WHEN substr({_ROW_HASH}, 1, 8) < 'cccccccc' THEN 'train' ELSE 'valid' END AS split
        FROM obs"""
    ),
)
def x2_row_split_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_rows(view(spark, sf_dir, "obs").select("row_id"), ["row_id"], 0.8, SEED, exact=False)


@register(
    "x3_subsample",
    duck(
        f"""SELECT row_id, pv_id FROM (SELECT {_ID}, pv_id, row_number() OVER (ORDER BY {_ROW_HASH}) AS pos,
        count(*) OVER () AS n FROM obs) WHERE pos <= greatest(1, floor(n * 0.4e0))"""
    ),
)
def x3_subsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subsample(view(spark, sf_dir, "obs").select("row_id", "pv_id"), ["row_id"], 0.4, SEED)


@register(
    "o4_row_slices",
    duck(f"SELECT split, count(*) AS n_rows, CAST(sum(row_id) AS BIGINT) AS id_sum FROM ({_ROWS}) GROUP BY split"),
)
def o4_row_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = label_rows(view(spark, sf_dir, "obs").select("row_id"), ["row_id"], 0.8, SEED)
    return marked.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("row_id").alias("id_sum"))
