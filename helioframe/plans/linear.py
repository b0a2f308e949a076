"""Linear models on standardised features."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.functions.scalars import positive_label, smooth_label
from helioframe.operators.fill import bfill, column_means, fill_with
from helioframe.operators.filters import positives
from helioframe.operators.sampling import label_rows
from helioframe.operators.scale import apply_scaler, fit_scaler
from helioframe.params import RunParams
from helioframe.plans.models import CLASS, PROB, RAW, SIZE, WITH_GROUP, FittedModel, TwoHeadModel, X, group_levels
from helioframe.plans.prepare import Prepared
from helioframe.session import stage

def _huber(params: RunParams, features: str, target: str) -> LinearRegression:
    return LinearRegression(
        featuresCol=features, labelCol=target, predictionCol=SIZE, loss="huber",
        maxIter=params.max_epochs, regParam=params.weight_decay, standardization=False,
    )


def fit_feedforward(prepared: Prepared, params: RunParams) -> FittedModel:
    """Robust linear regression of the target; predictions are clamped at 0."""
    model = FittedModel("feedforward", list(prepared.features), {})
    train = stage(model.encode(prepared.train).select(X, params.target), "fit-train")
    model.parts["regressor"] = Pipeline(stages=[_huber(params, X, params.target)]).fit(train)
    return model


def _with_group(features: str) -> list:
    # The group code carries its number of values, so the width never depends on the data.
    return [
        OneHotEncoder(inputCols=["_group"], outputCols=["_onehot"], handleInvalid="keep"),
        VectorAssembler(inputCols=[features, "_onehot"], outputCol=WITH_GROUP),
    ]


def fit_two_head(prepared: Prepared, params: RunParams) -> FittedModel:
    """Logistic head for the sign and robust linear head for the size of positives."""
    model = TwoHeadModel(
        "two_head", list(prepared.features), {}, params.positive_threshold, codes=params.group_codes,
        levels=group_levels(prepared.vocabulary, params.group),
    )
    y = params.target
    label = positive_label(F.col(y), params.positive_threshold)
    rows = model.encode(prepared.train).select(X, "_group", y, label.alias("_label"))
    train = stage(rows, "fit-train")
    classified, weight = train, {}
    if params.label_smoothing > 0:
        # The loss of a smoothed label is the mean of the losses of 1 and 0, weighted by it.
        soft = smooth_label(F.col("_label"), params.label_smoothing)
        sides = F.array(*[F.struct(F.lit(v).alias("l"), w.alias("w")) for v, w in ((1.0, soft), (0.0, 1.0 - soft))])
        classified = train.select(X, "_group", F.explode(sides).alias("_side")).select(
            X, "_group", F.col("_side.l").alias("_label"), F.col("_side.w").alias("_weight")
        )
        weight = {"weightCol": "_weight"}
    logistic = LogisticRegression(
        featuresCol=WITH_GROUP, labelCol="_label", rawPredictionCol=RAW, probabilityCol=PROB,
        predictionCol=CLASS, maxIter=params.max_epochs, regParam=params.weight_decay,
        standardization=False, **weight,
    )
    model.parts["classifier"] = Pipeline(stages=[*_with_group(X), logistic]).fit(classified)
    large = positives(train, y, params.positive_threshold)
    if not large.isEmpty():
        huber = _huber(params, WITH_GROUP, y)
        model.parts["regressor"] = Pipeline(stages=[*_with_group(X), huber]).fit(large)
    return model


def fit_row_split_baseline(
    train: DataFrame, features: list[str], params: RunParams, ratio: float = 0.8
) -> tuple[FittedModel, DataFrame]:
    """Baseline with a row-level split: (model, scored held-out rows).

    Back-fill in time order, exact hash split of rows, standardise on the training
    part, robust linear regression. Gaps that the back-fill leaves become the
    training mean. One group may sit on both sides here by design.
    """
    order = [params.time, *params.tie_break]
    keys = [params.group, params.time, *params.tie_break]
    numbers = train.filter(F.col(params.target).isNotNull()).select(
        *keys, F.col(params.target).cast("double").alias(params.target),
        *[F.col(c).cast("double").alias(c) for c in features],
    )
    filled = stage(bfill(numbers, [params.group], order, features), "filled")
    marked = stage(label_rows(filled, keys, ratio, params.seed), "rows")
    fit_rows = marked.filter(F.col("split") == "train")
    means = stage(column_means(fit_rows, features), "means")
    stats = stage(fit_scaler(fill_with(fit_rows, features, means), features), "scaler")
    scaled = apply_scaler(fill_with(marked, features, means), stats, features)
    model = FittedModel("row_split_linear", features, {})
    encoded = model.encode(scaled.filter(F.col("split") == "train")).select(X, params.target)
    model.parts["regressor"] = Pipeline(stages=[_huber(params, X, params.target)]).fit(
        stage(encoded, "fit-train")
    )
    return model, model.score(scaled.filter(F.col("split") == "valid"))
