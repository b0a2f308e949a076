"""Whole runs: train, evaluate, save, score saved models, deliver."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helioframe.operators.columns import canonical_names, with_default_type
from helioframe.operators.ensemble import row_mean, unstack_columns
from helioframe.operators.metrics import regression_metrics
from helioframe.operators.ranges import MAX_GROUP_ROWS
from helioframe.operators.submit import KEYS, fill_template
from helioframe.params import RunParams
from helioframe.plans.boosted import fit_hurdle
from helioframe.plans.linear import fit_feedforward, fit_two_head
from helioframe.plans.models import FittedModel, load_model
from helioframe.plans.prepare import Prepared, prepare
from helioframe.session import scratch_run, stage
from helioframe.sources.tables import SUBMISSION_SCHEMA, WEATHER_COLUMNS, read_panel, read_trio, write_delivery

METRICS = ("mae", "rmse", "nmape")


@dataclass
class RunResult:
    metrics: dict[str, float]
    submission: DataFrame
    model: FittedModel | None = None
    model_path: str | None = None
    per_model: DataFrame | None = None
    feature_count: int = 0
    loaded: list[str] = field(default_factory=list)


def evaluate(model: FittedModel, val: DataFrame, params: RunParams) -> dict[str, float]:
    """MAE, RMSE and normalised MAE of a model on a held-out frame."""
    row = regression_metrics(model.score(val), params.target, "prediction").first()
    return {m: row[m] for m in METRICS}


def deliver(scored: DataFrame, template: DataFrame, params: RunParams, p: str) -> DataFrame:
    """Template filled with predictions, keys under their canonical names."""
    keep = [c for c in (params.time, params.group, "type") if c in scored.columns]
    keyed = canonical_names(scored.select(*keep, F.col(p).alias("nins")), params.time, params.group)
    return fill_template(template, stage(with_default_type(keyed), "predictions"), KEYS, "nins")


FITTERS = {
    "lightgbm": fit_hurdle,
    "hist_gbdt": fit_hurdle,
    "feedforward": fit_feedforward,
    "two_head": fit_two_head,
}


def train_and_deliver(
    prepared: Prepared, params: RunParams, model_path: str | None = None
) -> RunResult:
    """Fit the selected model, evaluate it, save it if asked, fill the template."""
    params = params.checked()
    model = FITTERS[params.model](prepared, params)
    model.metrics = evaluate(model, prepared.val, params)
    saved = model.save(model_path, prepared.train.sparkSession) if model_path else None
    submission = deliver(model.score(prepared.test), prepared.template, params, "prediction")
    return RunResult(
        model.metrics, submission, model, saved, None, len(model.features)
    )


def score_saved_models(prepared: Prepared, params: RunParams) -> RunResult:
    """Score saved hurdle models, average them, evaluate each and the average.

    Every model adds one column to the same scan, so the average needs no join and
    no shuffle however many models there are.
    """
    params = params.checked()
    if not params.model_paths:
        raise ValueError("at least one saved model is needed")
    spark = prepared.test.sparkSession
    test, val = prepared.test, prepared.val
    names = [f"_m{i}" for i in range(len(params.model_paths))]
    for name, path in zip(names, params.model_paths):
        model = load_model(spark, path, need_classifier=True)
        test, val = model.score(test, name), model.score(val, name)
    val = stage(val.select(params.target, *names, row_mean(names).alias("ensemble")), "scored")
    long = unstack_columns(val, [params.target], [*names, "ensemble"], "prediction")
    label = F.col("model")
    for name, path in zip(names, params.model_paths):
        label = F.when(F.col("model") == name, F.lit(path)).otherwise(label)
    table = stage(
        regression_metrics(long, params.target, "prediction", ("model",)).withColumn("model", label),
        "metrics",
    )
    joint = table.filter(F.col("model") == "ensemble").first()
    scored = test.withColumn("prediction", row_mean(names))
    submission = deliver(scored, prepared.template, params, "prediction")
    return RunResult(
        {m: joint[m] for m in METRICS} if joint else {},
        submission,
        per_model=table,
        feature_count=len(prepared.features),
        loaded=list(params.model_paths),
    )


def run(
    spark: SparkSession,
    folder: str,
    out: str,
    params: RunParams,
    columns: tuple[str, ...] = WEATHER_COLUMNS,
    template_name: str = "submission_sample.csv",
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> RunResult:
    """Read the three files, prepare, train or score, and write the delivery.

    Staged tables are deleted at the end; the result reads the written delivery.
    """
    params = params.checked()
    with scratch_run(spark):
        raw = read_trio(spark, folder, columns, template_name)
        prepared = prepare(raw.train, raw.test, raw.template, params, max_group_rows)
        if params.inference_only:
            result = score_saved_models(prepared, params)
        else:
            result = train_and_deliver(prepared, params, f"{out}/model")
        write_delivery(result.submission, f"{out}/submission.csv")
        if result.per_model is not None:  # one row per model
            result.per_model = spark.createDataFrame(result.per_model.collect(), result.per_model.schema)
    result.submission = read_panel(spark, f"{out}/submission.csv", SUBMISSION_SCHEMA)
    return result


def fit_history(model: FittedModel, spark: SparkSession) -> DataFrame:
    """(run_id, epoch, mae) of a boosted model: held-out loss of every round that was tried.

    ``run_id`` is the stage; the rows feed ``early_stop`` and ``best_runs``.
    """
    stages = [(name, model.info.get(f"{name}_losses") or []) for name in ("classifier", "regressor")]
    rows = [(name, i, float(loss)) for name, losses in stages for i, loss in enumerate(losses)]
    return spark.createDataFrame(rows, "run_id string, epoch int, mae double")
