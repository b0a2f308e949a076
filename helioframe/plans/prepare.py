"""From raw tables to model-ready splits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.functions.calendar import add_time_features
from helioframe.functions.scalars import add_differences
from helioframe.operators.columns import feature_columns
from helioframe.operators.fill import column_means, fill_with
from helioframe.operators.filters import require_groups, with_target
from helioframe.operators.groups import index_groups, lookup_index
from helioframe.operators.ranges import MAX_GROUP_ROWS, as_series, fill_both_ways, group_sizes, with_gaps
from helioframe.operators.sampling import label_groups
from helioframe.operators.scale import apply_scaler, fit_scaler
from helioframe.params import RunParams
from helioframe.session import stage

GROUP_INDEX = "pv_idx"


@dataclass(frozen=True)
class Prepared:
    """One frame per split; keys stay beside the features, so nothing is positional."""

    train: DataFrame
    val: DataFrame
    test: DataFrame
    template: DataFrame
    features: list[str]
    keys: list[str]
    vocabulary: DataFrame
    scaler: DataFrame | None = None


def derive_features(df: DataFrame, params: RunParams) -> DataFrame:
    """Calendar, cyclic and difference columns."""
    return add_differences(add_time_features(df, params.time, params.time_zone))


def select_features(df: DataFrame, params: RunParams) -> list[str]:
    """Sorted numeric columns outside target, keys, type and group index."""
    skip = {params.target, params.group, params.time, params.type_col, *params.tie_break}
    return feature_columns(df, {*skip, GROUP_INDEX})


def prepare(
    train: DataFrame,
    test: DataFrame,
    template: DataFrame,
    params: RunParams,
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> Prepared:
    """Derive, filter, index, fill, split and scale.

    By default rows without a target leave before the fill and the fallback means
    cover training and validation rows; ``fill_before_filter`` and
    ``means_from_train`` change that. Training and test fill from their own means
    unless ``means_from_train`` is set. Each table crosses the network once, for
    the fill, and is written once; every later step reads the written table. Only
    columns that have a null are filled.
    """
    params = params.checked()
    train = derive_features(train, params).drop("energy")
    test = derive_features(test, params)
    if not params.fill_before_filter:
        train = with_target(train, params.target)
    features = select_features(train, params)
    fillable = list(features)
    # One count per table answers the guard, the vocabulary, the split, the search for
    # oversized groups and which columns have anything to fill.
    group = params.group
    train_sizes = stage(group_sizes(train, [group], fillable), "train-groups")
    test_sizes = stage(group_sizes(test, [group], fillable), "test-groups")
    require_groups(train_sizes, group)
    vocabulary = stage(index_groups([train_sizes, test_sizes], group, GROUP_INDEX), "vocabulary")
    train_gaps, test_gaps = with_gaps(train_sizes, fillable), with_gaps(test_sizes, fillable)
    if params.is_tree:
        features = sorted([*features, GROUP_INDEX])
    keys = [group, params.time, *params.tie_break]
    order = [params.time, *params.tie_break]
    extra = [params.type_col] if params.type_col in test.columns else []

    def filled(df: DataFrame, cols: list[str], sizes: DataFrame, gaps: list[str], label: str) -> DataFrame:
        doubles = df.select(*cols).withColumns({c: F.col(c).cast("double") for c in fillable})
        if gaps:
            series = as_series(doubles, [group], order, max_group_rows, sizes=sizes)
            doubles = fill_both_ways(series, gaps)
        return stage(lookup_index(doubles, vocabulary, group), label)

    # The split label depends on the group alone and is written with the rows.
    labelled = label_groups(train, group, params.val_ratio, params.seed, ids=train_sizes)
    train_rows = filled(labelled, [*keys, "split", params.target, *fillable], train_sizes, train_gaps, "train")
    test_rows = filled(test, [*keys, *extra, *fillable], test_sizes, test_gaps, "test")
    basis = train_rows.filter(F.col("split") == "train") if params.means_from_train else train_rows

    def means(df: DataFrame, cols: list[str]) -> DataFrame | None:
        return stage(column_means(df, cols), "means") if cols else None

    train_means = means(basis, train_gaps)
    test_means = means(basis if params.means_from_train else test_rows, test_gaps)
    train_rows = fill_with(train_rows, train_gaps, train_means)
    train_rows = train_rows.withColumn(params.target, F.col(params.target).cast("double"))
    test_rows = fill_with(test_rows, test_gaps, test_means)
    if params.fill_before_filter:
        train_rows = with_target(train_rows, params.target)

    train_split = train_rows.filter(F.col("split") == "train").drop("split")
    val_split = train_rows.filter(F.col("split") == "val").drop("split")
    scaler = None
    if params.scale_features:
        scaler = stage(fit_scaler(train_split, features), "scaler")
        train_split, val_split, test_rows = (
            apply_scaler(d, scaler, features) for d in (train_split, val_split, test_rows)
        )
    return Prepared(
        train_split, val_split, test_rows, template, features, keys, vocabulary, scaler
    )
