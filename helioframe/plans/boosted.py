"""Boosted trees: the two stages of the hurdle model and the plain baseline."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.functions.scalars import positive_label
from helioframe.operators.fill import bfill
from helioframe.operators.filters import complete_rows, positives
from helioframe.operators.groups import union_ids
from helioframe.operators.ranges import range_positions
from helioframe.operators.sampling import subsample
from helioframe.params import BoostParams, RunParams
from helioframe.plans.boosting import LABEL, boost, patience_cut
from helioframe.plans.models import CLASS, PROB, RAW, SIZE, FittedModel, X, group_levels
from helioframe.plans.prepare import GROUP_INDEX, Prepared
from helioframe.session import stage

__all__ = [
    "LABEL", "category_levels", "fit_hurdle", "fit_plain_boosted", "fit_positive_classifier", "fit_size_regressor",
    "informative", "patience_cut", "size_scale",
]


def fit_positive_classifier(
    train: DataFrame, val: DataFrame | None, params: BoostParams, seed: int, bins: int
) -> tuple[PipelineModel, int, list[float]]:
    """Stage 1: probability that the target is positive. Frames hold ``_x`` and ``_label``."""

    forest = boost(train, val, params, "logistic", seed, bins)
    model = forest.first(forest.kept).model(train.sparkSession).setFeaturesCol(X)
    model.setPredictionCol(CLASS).setRawPredictionCol(RAW).setProbabilityCol(PROB)
    return PipelineModel([model]), forest.kept, forest.losses


def size_scale(rows: DataFrame, y: str, loss: str) -> float | None:
    """Divisor of the stage-2 target; None without rows.

    A round of absolute loss moves predictions by a fixed step whatever the unit
    of the target, so the target is brought to a mean size of 1.
    """
    mean = rows.agg(F.avg(F.abs(F.col(y))).alias("m")).first()["m"]
    if mean is None:
        return None
    return mean if loss == "absolute" and mean > 0 else 1.0


def fit_size_regressor(
    train: DataFrame, val: DataFrame | None, params: BoostParams, seed: int, bins: int
) -> tuple[PipelineModel, int, list[float]]:
    """Stage 2: size of a positive target. Early stopping watches the absolute error."""

    forest = boost(train, val, params, params.loss, seed, bins)
    model = forest.first(forest.kept).model(train.sparkSession)
    return PipelineModel([model.setFeaturesCol(X).setPredictionCol(SIZE)]), forest.kept, forest.losses


def category_levels(frames: list[DataFrame], column: str) -> DataFrame:
    """Sorted distinct values over all splits with codes 0..n-1."""
    ids = union_ids(frames, column).filter(F.col(column).isNotNull())
    coded = range_positions(ids, [column], "code")
    return stage(coded.withColumn("code", F.col("code").cast("double")), "levels")


def _codes(rows: DataFrame, params: RunParams) -> int:
    """Width of the group code: as asked, but no category without a row in either stage.

    Spark ML refuses a category with more values than rows, so a handful of rows share codes.
    """
    enough = params.group_codes + 1  # no row beyond that changes the width
    large = positives(rows, params.target, params.positive_threshold).limit(enough).count()
    return max(1, min(params.group_codes, (large or rows.limit(enough).count()) - 1))


def fit_hurdle(prepared: Prepared, params: RunParams, use_group: bool = True) -> FittedModel:
    """Two-stage model: is the target positive, and how large is it then.

    Without positives there is no second stage and every prediction is 0.
    """
    boost = params.boosting()
    features = [c for c in prepared.features if use_group or c != GROUP_INDEX]
    rows = prepared.train
    if params.model == "lightgbm":
        rows = subsample(rows, prepared.keys, params.boost_sample_fraction, params.seed)
    nominal = GROUP_INDEX if GROUP_INDEX in features else None
    codes = _codes(rows, params) if nominal else 0
    bins = max(boost.max_bins, codes + 1)
    model = FittedModel(params.model, features, {}, params.positive_threshold, nominal, codes)
    if nominal:
        model.levels = group_levels(prepared.vocabulary, params.group)

    # Features and target once: both stages and every round start here, and a round reads its
    # rows several times. They are kept on local disks; in memory they fill the heap of large fits.
    y, t = params.target, params.positive_threshold
    train = stage(model.encode(rows).select("_x", y), "fit-train").persist(StorageLevel.DISK_ONLY)
    val = stage(model.encode(prepared.val).select("_x", y), "fit-val").persist(StorageLevel.DISK_ONLY)
    label = positive_label(F.col(y), t)
    held = None if val.isEmpty() else val
    model.parts["classifier"], kept, history = fit_positive_classifier(
        train.select("_x", label.alias(LABEL)),
        None if held is None else held.select("_x", label.alias(LABEL)),
        boost, params.seed, bins,
    )
    model.info |= {"classifier_rounds": kept, "classifier_losses": history}
    scale = size_scale(positives(train, y, t), y, boost.loss)
    if scale is not None:
        model.info["size_scale"] = scale
        size = (F.col(y) / F.lit(scale)).alias(LABEL)
        large = positives(train, y, t).select("_x", size)
        held_large = None
        if held is not None:
            held_large = positives(held, y, t).select("_x", size)
            held_large = None if held_large.isEmpty() else held_large
        model.parts["regressor"], kept, history = fit_size_regressor(
            large, held_large, boost, params.seed, bins
        )
        model.info |= {"regressor_rounds": kept, "regressor_losses": history}
    train.unpersist()
    val.unpersist()
    return model


def informative(df: DataFrame, cols: list[str]) -> list[str]:
    """Columns with at least one value; others would make every row incomplete."""
    counts = df.agg(*[F.count(c).alias(c) for c in cols]).first()
    return [c for c in cols if counts[c] > 0]


def fit_plain_boosted(
    train: DataFrame, features: list[str], params: RunParams, rounds: int = 100
) -> FittedModel:
    """Baseline: back-fill, drop incomplete rows, one boosted regressor on the rest."""
    order = [params.time, *params.tie_break]
    numbers = train.withColumns({c: F.col(c).cast("double") for c in features})
    filled = bfill(numbers, [params.group], order, features)
    rows = complete_rows(filled, [*features, params.target])
    model = FittedModel("plain_boosted", features, {})
    boost = BoostParams(
        rounds=rounds, step_size=0.1, max_depth=5, min_leaf_rows=20, row_fraction=1.0,
        feature_fraction=1.0, max_bins=255, patience=0, loss="squared",
    )
    fit_rows = stage(model.encode(rows).select("_x", F.col(params.target).alias(LABEL)), "fit-train")
    model.parts["regressor"], _, _ = fit_size_regressor(
        fit_rows, None, boost, params.seed, boost.max_bins
    )
    return model
