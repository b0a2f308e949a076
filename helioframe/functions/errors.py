"""Error measures as aggregate expressions.

Every expression is a combination of sums and counts, so Spark merges partial
results before any shuffle. Rows with a null on either side are skipped.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from helioframe.functions.scalars import positive_label, smooth_label

EPS = 1e-6
LOG_LOSS_EPS = 1e-15


def _paired(y: Column, p: Column, value: Column) -> Column:
    return F.when(y.isNotNull() & p.isNotNull(), value)


def mae(y: Column, p: Column) -> Column:
    return F.avg(F.abs(y - p))


def mse(y: Column, p: Column) -> Column:
    return F.avg((y - p) * (y - p))


def rmse(y: Column, p: Column) -> Column:
    return F.sqrt(mse(y, p))


def mean_abs_target(y: Column, p: Column) -> Column:
    return F.avg(_paired(y, p, F.abs(y)))


def nmape(y: Column, p: Column, eps: float = EPS) -> Column:
    """MAE in percent of the mean absolute target; 0 for an all-zero target."""
    base = mean_abs_target(y, p) + F.lit(eps)
    return F.when(base <= eps, F.lit(0.0)).otherwise(mae(y, p) / base * 100.0)


def nmape_by_constant(y: Column, p: Column, constant: float) -> Column:
    return mae(y, p) / F.lit(float(constant)) * 100.0


def nmae_from_sums(abs_error: Column, abs_target: Column, n: Column, eps: float = EPS) -> Column:
    """Normalised MAE in percent from merged sums; no examples is an error."""
    value = (abs_error / n) / (abs_target / n + F.lit(eps)) * 100.0
    return F.when(
        F.coalesce(n, F.lit(0)) == 0, F.raise_error(F.lit("normalised MAE needs at least one example"))
    ).otherwise(value)


def msle(y: Column, p: Column) -> Column:
    gap = F.log1p(p) - F.log1p(y)
    return F.avg(gap * gap)


def rmsle(y: Column, p: Column) -> Column:
    return F.sqrt(msle(y, p))


def smooth_l1(y: Column, p: Column, beta: float = 1.0) -> Column:
    """Row-level smooth L1: quadratic below ``beta``, linear above."""
    gap = F.abs(y - p)
    return F.when(gap < beta, gap * gap * F.lit(0.5 / beta)).otherwise(gap - F.lit(0.5 * beta))


def bce_with_logits(target: Column, logit: Column) -> Column:
    """Row-level binary cross-entropy, stable for large logits."""
    return (
        F.greatest(logit, F.lit(0.0)) - logit * target + F.log1p(F.exp(-F.abs(logit)))
    )


def log_loss(label: Column, probability: Column, eps: float = LOG_LOSS_EPS) -> Column:
    p = F.greatest(F.lit(eps), F.least(F.lit(1.0 - eps), probability))
    loss = label * F.ln(p) + (F.lit(1.0) - label) * F.ln(F.lit(1.0) - p)
    return -F.avg(_paired(label, probability, loss))


def two_head_terms(
    y: Column,
    logit: Column,
    magnitude: Column,
    threshold: float = 0.0,
    smoothing: float = 0.0,
    eps: float = EPS,
) -> tuple[Column, Column]:
    """Mean classification loss and mean smooth-L1 loss over the positives."""
    positive = positive_label(y, threshold)
    bce = F.avg(bce_with_logits(smooth_label(positive, smoothing), logit))
    size = F.sum(smooth_l1(y, magnitude) * positive) / F.greatest(F.sum(positive), F.lit(eps))
    return bce, size


