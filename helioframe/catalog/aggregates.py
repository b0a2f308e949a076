"""Aggregations: metrics, losses, profiles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helioframe.catalog import register
from helioframe.catalog.common import (
    BY, GAPPY, MODELS, ORDER, RAW, directional_cte, positive_part_sql, r6, r6_sql,
)
from helioframe.catalog.joins import long_sql
from helioframe.fixtures import duck, view
from helioframe.functions import errors as E
from helioframe.functions.scalars import clamp_negative, positive_label, sigmoid
from helioframe.operators import profile
from helioframe.operators.ensemble import unstack_columns
from helioframe.operators.fill import column_means
from helioframe.operators.metrics import (
    error_sums, finish_error_sums, leaderboard, regression_metrics, two_head_loss,
)
from helioframe.operators.ranges import as_series, fill_both_ways
from helioframe.operators.scale import fit_scaler

_LONG = f"scored AS ({long_sql()})"
_COUNTED = ["temp_a", "temp_b", "wind_spd_a", "pressure", "humidity", "uv_idx", "nins"]


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, row_id, pv_id, type, y, p) for the three models."""
    preds = view(spark, sf_dir, "preds")
    return unstack_columns(preds, ["row_id", "pv_id", "type", "y"], MODELS, "p")


def _by_model(
    spark: SparkSession, sf_dir: str, **measures: Callable[[Column, Column], Column]
) -> DataFrame:
    y, p = F.col("y"), F.col("p")
    df = scored(spark, sf_dir).groupBy("model", "type")
    return df.agg(*[r6(measure(y, p)).alias(n) for n, measure in measures.items()])


def _by_model_sql(cols: str) -> str:
    return duck(f"SELECT model, type, {cols} FROM scored GROUP BY model, type", _LONG)


_GAP2 = "(y - p) * (y - p)"


@register(
    "a1_fill_means",
    duck(
        "SELECT " + ", ".join(f"{r6_sql(f'coalesce(avg({c}), 0e0)')} AS {c}" for c in GAPPY) + " FROM filled",
        directional_cte("obs", GAPPY, "row_id, pv_id, time"),
    ),
)
def a1_fill_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = view(spark, sf_dir, "obs").select(*BY, *ORDER, *GAPPY)
    means = column_means(fill_both_ways(as_series(obs, BY, ORDER), GAPPY), GAPPY)
    return means.select(*[r6(c).alias(c) for c in GAPPY])


_SCALED = ["pressure", "humidity", "uv_idx", "coord1", "nins"]


@register(
    "a2_scaler_fit",
    duck(
        "SELECT "
        + ", ".join(
            f"{r6_sql(f'avg({c})')} AS {c}__mean, {r6_sql(f'stddev_pop({c})')} AS {c}__std" for c in _SCALED
        )
        + " FROM obs WHERE type = 'train'"
    ),
)
def a2_scaler_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = fit_scaler(view(spark, sf_dir, "obs").filter("type = 'train'"), _SCALED)
    return stats.select(*[r6(c).alias(c) for c in stats.columns])


@register("a3_mae", _by_model_sql(f"{r6_sql('avg(abs(y - p))')} AS mae"))
def a3_mae(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_model(spark, sf_dir, mae=E.mae)


@register("a4_mse", _by_model_sql(f"{r6_sql(f'avg({_GAP2})')} AS mse"))
def a4_mse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_model(spark, sf_dir, mse=E.mse)


@register("a5_rmse", _by_model_sql(f"{r6_sql(f'sqrt(avg({_GAP2}))')} AS rmse"))
def a5_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_model(spark, sf_dir, rmse=E.rmse)


@register(
    "a6a_nmape",
    _by_model_sql(
        f"""{r6_sql('avg(abs(y - p)) / (avg(abs(y)) + 1e-6) * 100')} AS nmape,
        {r6_sql('avg(abs(y - p)) / 1300e0 * 100')} AS nmape_of_constant"""
    ),
)
def a6a_nmape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_model(
        spark, sf_dir, nmape=E.nmape,
        nmape_of_constant=lambda y, p: E.nmape_by_constant(y, p, 1300.0),
    )


@register(
    "a6b_incremental_nmae",
    duck(
        f"""SELECT model, count(*) AS n, {r6_sql('avg(abs(y - p)) / (avg(abs(y)) + 1e-6) * 100')} AS nmae
        FROM scored WHERE y IS NOT NULL AND p IS NOT NULL GROUP BY model""",
        _LONG,
    ),
)
def a6b_incremental_nmae(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = error_sums(scored(spark, sf_dir), "y", "p", ("model", "pv_id"))
    return finish_error_sums(states, ("model",)).withColumn("nmae", r6("nmae"))


_LOGGAP = f"(ln(1 + {positive_part_sql('p')}) - ln(1 + y)) * (ln(1 + {positive_part_sql('p')}) - ln(1 + y))"


@register(
    "a7_msle",
    _by_model_sql(f"{r6_sql(f'avg({_LOGGAP})')} AS msle, {r6_sql(f'sqrt(avg({_LOGGAP}))')} AS rmsle"),
)
def a7_msle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_model(
        spark, sf_dir,
        msle=lambda y, p: E.msle(y, clamp_negative(p)),
        rmsle=lambda y, p: E.rmsle(y, clamp_negative(p)),
    )


_OBS_COLS = ["row_id", "time", "pv_id", "type", *RAW, "energy", "nins"]


@register(
    "a8_null_counts",
    duck(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM obs" for c in _OBS_COLS
        )
    ),
)
def a8_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_counts(view(spark, sf_dir, "obs").select(*_OBS_COLS))


_DESCRIBED = [*RAW, "energy", "nins"]


def _describe_sql(c: str) -> str:
    stats = (
        f"SELECT count({c}) AS n, count(*) - count({c}) AS nulls, avg({c}) AS mean, stddev_samp({c}) AS std, "
        f"min({c}) AS lo, max({c}) AS hi FROM obs"
    )
    ranked = f"SELECT {c} AS v, row_number() OVER (ORDER BY {c}) - 1 AS pos FROM obs WHERE {c} IS NOT NULL"
    quarts = ", ".join(
        f"(SELECT CAST(v AS DOUBLE) FROM ({ranked}) WHERE pos = CAST(floor((n - 1) * {p}e0 + 0.5e0) AS BIGINT)) AS {q}"
        for q, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))
    )
    return (
        f"SELECT '{c}' AS column_name, n AS count, nulls AS null_count, {r6_sql('mean')} AS mean, "
        f"{r6_sql('std')} AS std, CAST(lo AS DOUBLE) AS min, CAST(hi AS DOUBLE) AS max, {quarts} FROM ({stats})"
    )


@register("a9_describe", duck(" UNION ALL ".join(_describe_sql(c) for c in _DESCRIBED)))
def a9_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = profile.describe(view(spark, sf_dir, "obs"), _DESCRIBED)
    return table.withColumns({"mean": r6("mean"), "std": r6("std")})


@register(
    "a9_quantiles_linear",
    duck(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, {p}e0 AS prob, {r6_sql(f'quantile_cont(CAST({c} AS DOUBLE), {p})')} AS value FROM obs"
            for c in _COUNTED
            for p in (0.1, 0.5, 0.9)
        )
    ),
)
def a9_quantiles_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = profile.quantiles(view(spark, sf_dir, "obs"), _COUNTED, [0.1, 0.5, 0.9], "linear")
    return table.withColumn("value", r6("value"))


@register("a10_row_counts", duck("SELECT type, count(*) AS n_rows FROM obs GROUP BY type"))
def a10_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.row_counts(view(spark, sf_dir, "obs"), "type")


@register("a11_group_counts", duck("SELECT type, count(DISTINCT pv_id) AS n_groups FROM obs GROUP BY type"))
def a11_group_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.group_counts(view(spark, sf_dir, "obs"), "type", "pv_id")


_BCE = "greatest(logit, 0e0) - logit * m_s + ln(1 + exp(-abs(logit)))"
_SL1 = "CASE WHEN abs(y - model_c) < 1 THEN 0.5e0 * (y - model_c) * (y - model_c) ELSE abs(y - model_c) - 0.5e0 END"


@register(
    "a15_two_head_loss",
    duck(
        f"""SELECT type, {r6_sql('bce')} AS classification_loss, {r6_sql('reg')} AS regression_loss,
        {r6_sql('0.7e0 * bce + 1.3e0 * reg')} AS loss FROM (
          SELECT type, avg({_BCE}) AS bce, sum(({_SL1}) * m) / greatest(sum(m), 1e-6) AS reg FROM (
            SELECT *, CASE WHEN y > 5 THEN 1e0 WHEN y <= 5 THEN 0e0 END AS m,
              CASE WHEN y > 5 THEN 0.95e0 WHEN y <= 5 THEN 0.05e0 END AS m_s FROM preds) GROUP BY type)"""
    ),
)
def a15_two_head_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = two_head_loss(
        view(spark, sf_dir, "preds"), "y", "logit", "model_c",
        bce_weight=0.7, regression_weight=1.3, threshold=5.0, smoothing=0.1, by=("type",),
    )
    return out.select("type", *[r6(c).alias(c) for c in out.columns if c != "type"])


@register(
    "a16_smooth_l1",
    _by_model_sql(
        f"""{r6_sql('avg(CASE WHEN abs(y - p) < 1 THEN 0.5e0 * (y - p) * (y - p) ELSE abs(y - p) - 0.5e0 END)')}
        AS smooth_l1"""
    ),
)
def a16_smooth_l1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_model(spark, sf_dir, smooth_l1=lambda y, p: F.avg(E.smooth_l1(y, p)))


_PROB = "least(1 - 1e-15, greatest(1e-15, 1 / (1 + exp(-logit))))"


@register(
    "a17_log_loss",
    duck(
        f"""SELECT type, {r6_sql(f'-avg(CASE WHEN y > 0 THEN ln({_PROB}) WHEN y <= 0 THEN ln(1 - {_PROB}) END)')}
        AS log_loss FROM preds GROUP BY type"""
    ),
)
def a17_log_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    loss = E.log_loss(positive_label(F.col("y")), sigmoid(F.col("logit")))
    return view(spark, sf_dir, "preds").groupBy("type").agg(r6(loss).alias("log_loss"))


def _histogram_sql(c: str) -> str:
    ends = f"(SELECT min({c}) AS lo, (max({c}) - min({c})) / 20e0 AS w FROM obs)"
    binned = (
        f"SELECT CAST(least(floor(({c} - lo) / w), 19) AS BIGINT) AS bin, count(*) AS n "
        f"FROM obs, {ends} WHERE {c} IS NOT NULL GROUP BY 1"
    )
    return (
        f"SELECT '{c}' AS column_name, CAST(g.bin AS BIGINT) AS bin, {r6_sql('lo + g.bin * w')} AS lower, "
        f"{r6_sql('lo + (g.bin + 1) * w')} AS upper, coalesce(b.n, 0) AS n "
        f"FROM range(20) g(bin), {ends} LEFT JOIN ({binned}) b ON b.bin = g.bin"
    )


@register("a18_histogram", duck(" UNION ALL ".join(f"SELECT * FROM ({_histogram_sql(c)})" for c in _COUNTED)))
def a18_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = profile.histogram(view(spark, sf_dir, "obs"), _COUNTED)
    return table.select(
        "column_name", F.col("bin").cast("bigint").alias("bin"), r6("lower").alias("lower"),
        r6("upper").alias("upper"), "n",
    )


@register(
    "a19_corr_matrix",
    duck(
        " UNION ALL ".join(
            f"SELECT '{a}' AS column_x, '{b}' AS column_y, {r6_sql(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))')} AS corr FROM obs"
            for a in _COUNTED
            for b in _COUNTED
        )
    ),
)
def a19_corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.corr_matrix(view(spark, sf_dir, "obs"), _COUNTED).withColumn("corr", r6("corr"))


@register(
    "w6_leaderboard",
    duck(
        f"""SELECT pv_id, mae, rmsle, rank() OVER (ORDER BY mae) AS place FROM (
        SELECT pv_id, {r6_sql('avg(abs(y - p))')} AS mae, {r6_sql(f'sqrt(avg({_LOGGAP}))')} AS rmsle
        FROM (SELECT pv_id, y, {positive_part_sql('model_a')} AS p FROM preds) GROUP BY pv_id)"""
    ),
)
def w6_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    preds = view(spark, sf_dir, "preds").withColumn("p", clamp_negative(F.col("model_a")))
    scores = regression_metrics(preds, "y", "p", ("pv_id",), log_errors=True)
    return leaderboard(scores.select("pv_id", r6("mae").alias("mae"), r6("rmsle").alias("rmsle")))
