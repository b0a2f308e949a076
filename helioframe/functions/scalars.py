"""Row-level expressions used by features, targets and predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Difference features: result column -> (minuend, subtrahend).
DIFFERENCE_PAIRS = {
    "temp_diff_ab": ("temp_a", "temp_b"),
    "wind_spd_diff": ("wind_spd_a", "wind_spd_b"),
    "pressure_gradient": ("pressure", "ground_press"),
    "humidity_gap": ("humidity", "rel_hum"),
}


def add_differences(df: DataFrame, pairs: dict[str, tuple[str, str]] = DIFFERENCE_PAIRS) -> DataFrame:
    """One column per pair whose inputs both exist; null if either value is null."""
    present = set(df.columns)
    made = {name: F.col(a) - F.col(b) for name, (a, b) in pairs.items() if {a, b} <= present}
    return df.withColumns(made) if made else df


def clamp_negative(value: Column) -> Column:
    """Negatives become 0; null and NaN stay."""
    return F.when(value < 0, F.lit(0.0)).otherwise(value)


def positive_label(y: Column, threshold: float = 0.0) -> Column:
    return (y > F.lit(float(threshold))).cast("double")


def smooth_label(label: Column, smoothing: float) -> Column:
    s = max(0.0, min(0.499, smoothing))
    return label if s == 0.0 else label * F.lit(1.0 - s) + F.lit(0.5 * s)


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def hurdle_value(probability: Column, magnitude: Column | None) -> Column:
    """Probability of a positive times its size; 0 without a size model."""
    if magnitude is None:
        return probability * F.lit(0.0)
    return clamp_negative(probability * clamp_negative(magnitude))


def two_head_value(logit: Column, magnitude: Column) -> Column:
    return hurdle_value(sigmoid(logit), magnitude)


def standardise(value: Column, mean: Column, std: Column) -> Column:
    """(value - mean) / std with a zero spread treated as 1."""
    return (value - mean) / F.when(std == 0, F.lit(1.0)).otherwise(std)


def default_prediction(value: Column, default: float = 0.0) -> Column:
    """Replace a missing prediction; NaN stays."""
    return F.coalesce(value, F.lit(default))
