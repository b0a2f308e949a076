"""Joins, set operations and ensembles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helioframe.catalog import register
from helioframe.catalog.common import BY, KEYS, MODELS, ORDER, SEED, bfill_sql, r6, r6_sql
from helioframe.catalog.sources import _DELIVERY, delivery
from helioframe.fixtures import duck, view
from helioframe.operators import groups
from helioframe.operators.ensemble import (
    ensemble_aligned,
    ensemble_mean,
    ensemble_report,
    row_mean,
    stack_models,
    unstack_columns,
)
from helioframe.operators.fill import bfill
from helioframe.operators.sampling import split_by_group, subsample
from helioframe.plans.boosted import category_levels
from helioframe.session import stage

_VOCABULARY = "(SELECT pv_id, row_number() OVER (ORDER BY pv_id) - 1 AS pv_idx FROM (SELECT DISTINCT pv_id FROM obs))"


def _typed(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return view(spark, sf_dir, "obs").filter(F.col("type") == kind)


@register(
    "j1_fill_template",
    duck(f"SELECT time, pv_id, type, {r6_sql('nins')} AS nins FROM delivered", f"delivered AS ({_DELIVERY})"),
)
def j1_fill_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery(spark, sf_dir).withColumn("nins", r6("nins"))


@register(
    "j2_sampled_rows",
    duck(
        """SELECT CAST(row_id AS BIGINT) AS row_id, pv_id, temp_a FROM obs WHERE row_id IN (
        SELECT row_id FROM (SELECT row_id, row_number() OVER (ORDER BY md5('42|' || CAST(row_id AS VARCHAR))) AS pos,
          count(*) OVER () AS n FROM obs) WHERE pos <= greatest(1, CAST(floor(n * 0.4e0) AS BIGINT)))"""
    ),
)
def j2_sampled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = view(spark, sf_dir, "obs")
    picked = subsample(obs.select("row_id"), ["row_id"], 0.4, SEED)
    return obs.join(picked, "row_id", "left_semi").select("row_id", "pv_id", "temp_a")


@register(
    "j3_lookup_index",
    duck(
        f"""SELECT CAST(o.row_id AS BIGINT) AS row_id, o.pv_id, CAST(v.pv_idx AS INTEGER) AS pv_idx
        FROM obs o LEFT JOIN {_VOCABULARY} v ON o.pv_id = v.pv_id"""
    ),
)
def j3_lookup_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = view(spark, sf_dir, "obs").select("row_id", "pv_id")
    return groups.lookup_index(obs, groups.index_groups([obs], "pv_id"), "pv_id")


@register(
    "j4_missing_groups",
    duck(
        """SELECT DISTINCT pv_id FROM obs WHERE type = 'test'
        AND pv_id NOT IN (SELECT pv_id FROM obs WHERE type = 'train')"""
    ),
)
def j4_missing_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.missing_groups(_typed(spark, sf_dir, "test"), _typed(spark, sf_dir, "train"), "pv_id")


def uneven_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three models in long form; one lacks the rows without a target."""
    preds = view(spark, sf_dir, "preds")
    frames = {m: preds.select(*KEYS, F.col(m).alias("pred")) for m in MODELS}
    frames["model_b"] = preds.filter("y IS NOT NULL").select(*KEYS, F.col("model_b").alias("pred"))
    return stack_models(frames)


@register(
    "j5_ensemble_aligned",
    duck(
        f"""SELECT a.time, a.pv_id, a.type, {r6_sql('(a.model_a + b.model_b + c.model_c) / 3')} AS pred
        FROM preds a JOIN (SELECT * FROM preds WHERE y IS NOT NULL) b USING (time, pv_id, type)
        JOIN preds c USING (time, pv_id, type)"""
    ),
)
def j5_ensemble_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = uneven_models(spark, sf_dir)
    return ensemble_aligned(long, KEYS, MODELS, "pred").withColumn("pred", r6("pred"))


@register(
    "a12_ensemble_mean",
    duck(
        f"""SELECT time, pv_id, type,
        {r6_sql('CASE WHEN y IS NULL THEN (model_a + model_c) / 2 ELSE (model_a + model_b + model_c) / 3 END')} AS pred
        FROM preds"""
    ),
)
def a12_ensemble_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ensemble_mean(uneven_models(spark, sf_dir), KEYS, "pred").withColumn("pred", r6("pred"))


@register(
    "a13_ensemble_sum",
    duck(
        f"""SELECT CAST(row_id AS BIGINT) AS row_id,
        {r6_sql('(model_a + CASE WHEN y > 0 THEN model_b END + model_c) / 3')} AS pred FROM preds"""
    ),
)
def a13_ensemble_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    preds = view(spark, sf_dir, "preds").withColumn("model_b", F.expr("CASE WHEN y > 0 THEN model_b END"))
    return preds.select("row_id", r6(row_mean(MODELS)).alias("pred"))


_METRIC_COLS = f"""count(y - p) AS n, {r6_sql('avg(abs(y - p))')} AS mae, {r6_sql('avg((y - p) * (y - p))')} AS mse,
  {r6_sql('sqrt(avg((y - p) * (y - p)))')} AS rmse,
  {r6_sql('avg(abs(y - p)) / (avg(CASE WHEN p IS NOT NULL THEN abs(y) END) + 1e-6) * 100')} AS nmape"""


def long_sql() -> str:
    parts = [f"SELECT '{m}' AS model, row_id, pv_id, type, y, {m} AS p FROM preds" for m in MODELS]
    return " UNION ALL ".join(parts)


@register(
    "a14_model_report",
    duck(
        f"""SELECT model, {_METRIC_COLS} FROM (
        SELECT model, y, p FROM scored UNION ALL
        SELECT 'ensemble', max(y), avg(p) FROM scored GROUP BY row_id) GROUP BY model""",
        f"scored AS ({long_sql()})",
    ),
)
def a14_model_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = unstack_columns(view(spark, sf_dir, "preds"), ["row_id", "y"], MODELS, "p")
    report = ensemble_report(long, ["row_id"], "y", "p")
    return report.select("model", "n", *[r6(c).alias(c) for c in ("mae", "mse", "rmse", "nmape")])


# --- sets ---------------------------------------------------------------------


@register("u1_distinct_ids", duck("SELECT DISTINCT pv_id FROM obs WHERE type = 'train'"))
def u1_distinct_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.distinct_ids(_typed(spark, sf_dir, "train"), "pv_id")


@register(
    "u2_union_ids",
    duck("SELECT pv_id FROM obs WHERE nins IS NULL UNION SELECT pv_id FROM obs WHERE type = 'test'"),
)
def u2_union_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = view(spark, sf_dir, "obs")
    return groups.union_ids([obs.filter("nins IS NULL"), obs.filter("type = 'test'")], "pv_id")


@register(
    "u3_category_levels",
    duck("SELECT pv_id, row_number() OVER (ORDER BY pv_id) - 1 AS code FROM (SELECT DISTINCT pv_id FROM obs)"),
)
def u3_category_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, val = split_by_group(_typed(spark, sf_dir, "train"), "pv_id", 0.2, SEED)
    levels = category_levels([train, val, _typed(spark, sf_dir, "test")], "pv_id")
    return levels.withColumn("code", F.col("code").cast("bigint"))


_U4 = ["temp_a", "rel_hum"]


@register(
    "u4_concat_groups",
    duck(f"SELECT CAST(row_id AS BIGINT) AS row_id, {', '.join(f'{bfill_sql(c)} AS {c}' for c in _U4)} FROM obs"),
)
def u4_concat_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        bfill(_typed(spark, sf_dir, kind).select(*BY, *ORDER, *_U4), BY, ORDER, _U4)
        for kind in ("train", "test")
    ]
    return parts[0].unionByName(parts[1]).select("row_id", *_U4)


@register(
    "x4_vocabulary",
    duck("SELECT pv_id, CAST(row_number() OVER (ORDER BY pv_id) - 1 AS INTEGER) AS pv_idx FROM (SELECT DISTINCT pv_id FROM obs)"),
)
def x4_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = [_typed(spark, sf_dir, "train"), _typed(spark, sf_dir, "test")]
    return groups.index_groups(frames, "pv_id")


@register(
    "t15_align_levels",
    duck(
        """SELECT CAST(row_id AS BIGINT) AS row_id, CASE WHEN pv_id IN
        (SELECT pv_id FROM obs WHERE type = 'train') THEN pv_id END AS level FROM obs"""
    ),
)
def t15_align_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = view(spark, sf_dir, "obs").select("row_id", "pv_id")
    levels = stage(groups.distinct_ids(_typed(spark, sf_dir, "train"), "pv_id"))
    return groups.align_levels(obs, "pv_id", levels, "level").select("row_id", "level")
