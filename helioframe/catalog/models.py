"""Preparation, model fitting, scoring and whole runs."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helioframe.catalog import register
from helioframe.catalog.common import (
    DERIVED, DIFF_SQL, PARAMS, RAW, SEED, TIME_SQL, directional_cte, r6, r6_sql,
)
from helioframe.catalog.samples import HELD_OUT
from helioframe.catalog.sources import FILE_COLUMNS, write_trio
from helioframe.fixtures import duck, view
from helioframe.functions.calendar import add_time_features
from helioframe.functions.scalars import add_differences, clamp_negative
from helioframe.operators.fill import bfill, fill_missing
from helioframe.operators.filters import positives
from helioframe.operators.metrics import regression_metrics, two_head_loss
from helioframe.operators.sampling import label_groups
from helioframe.params import RunParams
from helioframe.plans.boosted import (
    LABEL, fit_hurdle, fit_plain_boosted, fit_positive_classifier, fit_size_regressor, informative,
    patience_cut, size_scale,
)
from helioframe.plans.jobs import evaluate, run, score_saved_models, train_and_deliver
from helioframe.plans.linear import fit_feedforward, fit_row_split_baseline, fit_two_head
from helioframe.plans.models import FittedModel, load_model
from helioframe.plans.prepare import Prepared, prepare
from helioframe.session import scratch_path, stage

# A short training budget: these queries check the jobs, not the accuracy.
SHORT = replace(
    PARAMS, model="lightgbm", boost_rounds=4, boost_step_size=0.3, boost_leaves=8,
    boost_min_leaf_rows=20, boost_sample_fraction=0.8, boost_patience=2, max_epochs=15,
)


def prepared(spark: SparkSession, sf_dir: str, params: RunParams) -> Prepared:
    obs = view(spark, sf_dir, "obs")
    train, test = obs.filter("type = 'train'"), obs.filter("type = 'test'")
    return prepare(train, test, view(spark, sf_dir, "template"), params)


def _metrics_row(spark: SparkSession, name: str, metrics: dict, rows: int) -> DataFrame:
    values = [(name, rows, *[float(metrics[m]) for m in ("mae", "rmse", "nmape")])]
    return spark.createDataFrame(values, "model string, n_rows bigint, mae double, rmse double, nmape double")


def _scores(model: FittedModel, rows: DataFrame) -> DataFrame:
    return model.score(rows).select("pv_id", "time", "row_id", r6("prediction").alias("prediction"))


# --- flagship: features, fill, split, constant predictor -----------------------

_LABELLED = "CASE WHEN pv_id IN (SELECT pv_id FROM held) THEN 'val' ELSE 'train' END AS split"
_DERIVE = ", ".join(f"{t} AS {c}" for c, t in (TIME_SQL | DIFF_SQL).items())
_RAW = ", ".join(RAW)
_DERIVED_CTE = f"derived AS (SELECT row_id, time, pv_id, type, nins, {_RAW}, {_DERIVE} FROM obs)"


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per split: rows, mean target, mean filled features, error of the train mean."""
    obs = label_groups(view(spark, sf_dir, "obs"), "pv_id", 0.2, SEED)
    wide = add_differences(add_time_features(obs, "time"))
    cols = ["row_id", "time", "pv_id", "split", "nins", *DERIVED]
    marked = fill_missing(wide.select(*cols), ["pv_id"], ["time", "row_id"], DERIVED)
    known = obs.filter("split = 'train'")
    constant = known.agg(F.avg("nins").alias("m")).scalar()
    scored = marked.withColumn("p", constant)
    return scored.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        r6(F.avg("nins")).alias("mean_target"),
        r6(F.avg("temp_a")).alias("mean_temp_a"),
        r6(F.avg("humidity_gap")).alias("mean_humidity_gap"),
        r6(F.avg(F.abs(F.col("nins") - F.col("p")))).alias("mae"),
    )


register(
    "flagship_constant_predictor",
    duck(
        f"""SELECT split, count(*) AS n_rows, {r6_sql('avg(nins)')} AS mean_target,
        {r6_sql('avg(temp_a)')} AS mean_temp_a, {r6_sql('avg(humidity_gap)')} AS mean_humidity_gap,
        {r6_sql('avg(abs(nins - p))')} AS mae FROM (
          SELECT split, nins, coalesce(temp_a, (SELECT avg(temp_a) FROM filled), 0e0) AS temp_a,
            coalesce(humidity_gap, (SELECT avg(humidity_gap) FROM filled), 0e0) AS humidity_gap,
            (SELECT avg(nins) FROM obs WHERE pv_id NOT IN (SELECT pv_id FROM held)) AS p
          FROM (SELECT *, {_LABELLED} FROM filled)) GROUP BY split""",
        HELD_OUT.format(source="obs"),
        _DERIVED_CTE,
        directional_cte("derived", ["temp_a", "humidity_gap"], "row_id, time, pv_id, nins"),
    ),
)(flagship)


# --- M13: prepared features -----------------------------------------------------


def _prepared_value(c: str) -> str:
    mean = f"(SELECT avg({c}) FROM filled m WHERE m.type = f.type)"
    return f"{r6_sql(f'coalesce(CAST({c} AS DOUBLE), {mean}, 0e0)')} AS {c}"


@register(
    "m13_prepared_features",
    duck(
        f"""SELECT CAST(row_id AS BIGINT) AS row_id, pv_id,
        CASE WHEN type = 'test' THEN 'test' WHEN pv_id IN (SELECT pv_id FROM held) THEN 'val' ELSE 'train' END AS split,
        CAST(pv_idx AS INTEGER) AS pv_idx, {', '.join(_prepared_value(c) for c in DERIVED)}
        FROM filled f JOIN (SELECT pv_id, row_number() OVER (ORDER BY pv_id) - 1 AS pv_idx
          FROM (SELECT DISTINCT pv_id FROM kept)) v USING (pv_id)""",
        _DERIVED_CTE,
        "kept AS (SELECT * FROM derived WHERE type = 'test' OR nins IS NOT NULL)",
        HELD_OUT.format(source="kept WHERE type = 'train'"),
        directional_cte("kept", DERIVED, "row_id, time, pv_id, type, nins"),
    ),
)
def m13_prepared_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = prepared(spark, sf_dir, SHORT)
    parts = [(p.train, "train"), (p.val, "val"), (p.test, "test")]
    frames = [
        df.select(
            "row_id", "pv_id", F.lit(name).alias("split"), F.col("pv_idx").cast("int").alias("pv_idx"),
            *[r6(c).alias(c) for c in DERIVED],
        )
        for df, name in parts
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


# --- fitting and scoring ----------------------------------------------------------


def _stage_inputs(spark: SparkSession, sf_dir: str) -> tuple[Prepared, FittedModel, DataFrame, DataFrame]:
    p = prepared(spark, sf_dir, SHORT)
    model = FittedModel("lightgbm", [c for c in p.features if c != "pv_idx"], {})
    train = stage(model.encode(p.train).select("_x", "nins"), "fit-train")
    val = stage(model.encode(p.val).select("_x", "nins"), "fit-val")
    return p, model, train, val


@register("m1_positive_classifier")
def m1_positive_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, model, train, val = _stage_inputs(spark, sf_dir)
    label = (F.col("nins") > 0).cast("double").alias(LABEL)
    fitted, _, _ = fit_positive_classifier(
        train.select("_x", label), val.select("_x", label), SHORT.boosting(), SEED, 64
    )
    model.parts["classifier"] = fitted
    return model.heads(p.test).select("row_id", r6("probability").alias("probability"))


@register("m2_size_regressor")
def m2_size_regressor(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, model, train, val = _stage_inputs(spark, sf_dir)
    boost = SHORT.boosting()
    large, large_val = positives(train, "nins"), positives(val, "nins")
    scale = size_scale(large, "nins", boost.loss)
    size = (F.col("nins") / scale).alias(LABEL)
    fitted, _, _ = fit_size_regressor(
        large.select("_x", size), large_val.select("_x", size), boost, SEED, 64
    )
    model.info["size_scale"] = scale
    model.parts["regressor"] = fitted
    return model.heads(p.test).select("row_id", r6("magnitude").alias("magnitude"))


@register("m3_hurdle_job")
def m3_hurdle_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = train_and_deliver(prepared(spark, sf_dir, SHORT), SHORT, scratch_path(spark, "model"))
    return result.submission.select("time", "pv_id", "type", r6("nins").alias("nins"))


@register("m4_patience")
def m4_patience(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out loss per boosting round and the rounds that patience keeps."""
    p, model, train, val = _stage_inputs(spark, sf_dir)
    label = (F.col("nins") > 0).cast("double").alias(LABEL)
    held = val.select("_x", label)
    boost = replace(SHORT.boosting(), patience=0)
    fitted, _, _ = fit_positive_classifier(train.select("_x", label), None, boost, SEED, 64)
    losses = fitted.stages[0].evaluateEachIteration(held)
    keep, _ = patience_cut(losses, SHORT.boost_patience)
    rows = [(i + 1, round(loss, 6), i + 1 == keep) for i, loss in enumerate(losses)]
    return spark.createDataFrame(rows, "boosting_round int, loss double, kept boolean")


def _saved_models(p: Prepared, spark: SparkSession, params: RunParams, n: int) -> list[str]:
    """Fit, evaluate and save ``n`` models that differ in their seed."""
    paths = []
    for i in range(n):
        job = replace(params, seed=params.seed + i)
        model = fit_hurdle(p, job)
        model.metrics = evaluate(model, p.val, job)
        paths.append(model.save(scratch_path(spark, f"model{i}"), spark))
    return paths


@register("m5_saved_ensemble")
def m5_saved_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = prepared(spark, sf_dir, SHORT)
    paths = _saved_models(p, spark, SHORT, 2)
    result = score_saved_models(p, replace(SHORT, inference_only=True, model_paths=tuple(paths)))
    label = F.col("model")
    for i, path in enumerate(paths):
        label = F.when(F.col("model") == path, F.lit(f"model{i}")).otherwise(label)
    return result.per_model.select(
        label.alias("model"), "n", *[r6(m).alias(m) for m in ("mae", "rmse", "nmape")]
    )


@register("m6_plain_tree_hurdle")
def m6_plain_tree_hurdle(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = replace(SHORT, model="hist_gbdt", tree_rounds=4, tree_step_size=0.3, tree_max_depth=3, tree_max_bins=64)
    p = prepared(spark, sf_dir, params)
    return _scores(fit_hurdle(p, params, use_group=False), p.test)


@register("m7_robust_linear")
def m7_robust_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = replace(SHORT, model="feedforward")
    p = prepared(spark, sf_dir, params)
    return _scores(fit_feedforward(p, params), p.test)


@register("m8_two_head_linear")
def m8_two_head_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-head losses on the validation rows."""
    params = replace(SHORT, model="two_head")
    p = prepared(spark, sf_dir, params)
    heads = fit_two_head(p, params).heads(p.val)
    heads = heads.withColumn("magnitude", clamp_negative(F.col("magnitude")))
    loss = two_head_loss(heads, "nins", "logit", "magnitude")
    return loss.select(*[r6(c).alias(c) for c in loss.columns])


def _baseline_features(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, list[str]]:
    obs = view(spark, sf_dir, "obs")
    train, test = obs.filter("type = 'train'"), obs.filter("type = 'test'")
    return train, test, informative(train, RAW)


@register("m9_plain_boosted")
def m9_plain_boosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test, features = _baseline_features(spark, sf_dir)
    model = fit_plain_boosted(train, features, SHORT, rounds=4)
    numbers = test.withColumns({c: F.col(c).cast("double") for c in features})
    return _scores(model, bfill(numbers, ["pv_id"], ["time", "row_id"], features))


@register("m10_row_split_linear")
def m10_row_split_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _, features = _baseline_features(spark, sf_dir)
    _, scored = fit_row_split_baseline(train, features, SHORT)
    out = regression_metrics(scored, "nins", "prediction")
    return out.select("n", *[r6(c).alias(c) for c in ("mae", "rmse", "nmape")])


@register("m11_batch_prediction")
def m11_batch_prediction(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = prepared(spark, sf_dir, SHORT)
    return _scores(fit_hurdle(p, SHORT, use_group=False), p.test)


@register("m12_validation_metrics")
def m12_validation_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = prepared(spark, sf_dir, SHORT)
    scored = fit_hurdle(p, SHORT).score(p.val)
    out = regression_metrics(scored, "nins", "prediction")
    return out.select("n", *[r6(c).alias(c) for c in ("mae", "rmse", "nmape")])


@register("m14_full_run")
def m14_full_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in, model and delivery file out; returns the delivered rows."""
    folder, out = write_trio(spark, sf_dir), scratch_path(spark, "run")
    result = run(spark, folder, out, SHORT, FILE_COLUMNS)
    return result.submission.select("pv_id", "type", F.unix_seconds("time").alias("at_second"), r6("nins").alias("nins"))


@register("s6_save_model")
def s6_save_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a saved model's description says."""
    p = prepared(spark, sf_dir, SHORT)
    path = _saved_models(p, spark, SHORT, 1)[0]
    loaded = load_model(spark, path)
    return _metrics_row(spark, loaded.kind, loaded.metrics, len(loaded.features))


@register("s7_load_model")
def s7_load_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of a reloaded model."""
    p = prepared(spark, sf_dir, SHORT)
    path = _saved_models(p, spark, SHORT, 1)[0]
    return _scores(load_model(spark, path, need_classifier=True), p.test)
