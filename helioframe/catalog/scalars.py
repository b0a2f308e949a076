"""Row-level functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helioframe.catalog import register
from helioframe.catalog.common import DIFF_SQL, DIFFERENCES, TIME_SQL, r6, r6_sql
from helioframe.catalog.sources import offset_text
from helioframe.fixtures import duck, view
from helioframe.functions import scalars as S
from helioframe.functions.calendar import (
    CALENDAR_PARTS, CYCLIC_PARTS, add_time_features, ensure_timestamp, parse_time,
)
from helioframe.operators.scale import apply_scaler, fit_scaler

_ID = "CAST(row_id AS BIGINT) AS row_id"


def _obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "obs")


@register("t1_parse_time", duck(f"SELECT {_ID}, CAST(floor(epoch(time)) AS BIGINT) AS at_second FROM obs"))
def t1_parse_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = offset_text(_obs(spark, sf_dir))
    return text.select("row_id", F.unix_seconds(parse_time(F.col("time"))).alias("at_second"))


@register(
    "t2_ensure_timestamp",
    duck(f"SELECT {_ID}, CASE WHEN nins IS NOT NULL THEN CAST(floor(epoch(time)) AS BIGINT) END AS at_second FROM obs"),
)
def t2_ensure_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = offset_text(_obs(spark, sf_dir))
    damaged = F.when(F.col("nins").isNull(), F.lit("unreadable")).otherwise(F.col("time"))
    parsed = ensure_timestamp(text.withColumn("time", damaged), "time")
    return parsed.select("row_id", F.unix_seconds("time").alias("at_second"))


def _time_query(cols: tuple[str, ...] | list[str], rounded: bool) -> str:
    made = [f"{r6_sql(TIME_SQL[c]) if rounded else TIME_SQL[c]} AS {c}" for c in cols]
    return duck(f"SELECT {_ID}, {', '.join(made)} FROM obs")


def _time_frame(spark: SparkSession, sf_dir: str, cols: tuple[str, ...] | list[str]) -> DataFrame:
    df = add_time_features(_obs(spark, sf_dir).select("row_id", "time"), "time")
    return df.select(
        "row_id", *[(r6(c) if c in CYCLIC_PARTS else F.col(c).cast("bigint")).alias(c) for c in cols]
    )


@register("t3_clock_parts", _time_query(CALENDAR_PARTS[:4], False))
def t3_clock_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _time_frame(spark, sf_dir, CALENDAR_PARTS[:4])


@register("t4_weekday", _time_query(["weekday"], False))
def t4_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _time_frame(spark, sf_dir, ["weekday"])


@register("t5_day_of_year", _time_query(["day_of_year"], False))
def t5_day_of_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _time_frame(spark, sf_dir, ["day_of_year"])


@register("t6_cyclic", _time_query(CYCLIC_PARTS, True))
def t6_cyclic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _time_frame(spark, sf_dir, CYCLIC_PARTS)


@register(
    "t7_time_features",
    duck(
        f"SELECT {_ID}, "
        + ", ".join(
            f"{r6_sql(TIME_SQL[c]) if c in CYCLIC_PARTS else TIME_SQL[c]} AS {c}"
            for c in (*CALENDAR_PARTS, *CYCLIC_PARTS)
        )
        + " FROM obs"
    ),
)
def t7_time_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _time_frame(spark, sf_dir, [*CALENDAR_PARTS, *CYCLIC_PARTS])


@register("t8_differences", duck(f"SELECT {_ID}, {', '.join(f'{DIFF_SQL[c]} AS {c}' for c in DIFFERENCES)} FROM obs"))
def t8_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.add_differences(_obs(spark, sf_dir)).select("row_id", *DIFFERENCES)


@register(
    "t9_clamp",
    duck(f"SELECT {_ID}, {r6_sql('CASE WHEN model_b < 0 THEN 0e0 ELSE model_b END')} AS pred, CASE WHEN y < 0 THEN 0e0 ELSE y END AS y FROM preds"),
)
def t9_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    preds = view(spark, sf_dir, "preds")
    return preds.select("row_id", r6(S.clamp_negative(F.col("model_b"))).alias("pred"), S.clamp_negative(F.col("y")).alias("y"))


_SIG = "1 / (1 + exp(-logit))"


@register(
    "t10_hurdle",
    duck(
        f"""SELECT {_ID}, {r6_sql(f'({_SIG}) * greatest(model_b, 0e0)')} AS pred,
        0e0 AS without_size FROM preds"""
    ),
)
def t10_hurdle(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = S.sigmoid(F.col("logit"))
    return view(spark, sf_dir, "preds").select(
        "row_id", r6(S.hurdle_value(p, F.col("model_b"))).alias("pred"), S.hurdle_value(p, None).alias("without_size")
    )


@register(
    "t11_two_head",
    duck(f"SELECT {_ID}, {r6_sql(_SIG)} AS probability, {r6_sql(f'({_SIG}) * greatest(model_a, 0e0)')} AS pred FROM preds"),
)
def t11_two_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    logit = F.col("logit")
    return view(spark, sf_dir, "preds").select(
        "row_id", r6(S.sigmoid(logit)).alias("probability"), r6(S.two_head_value(logit, F.col("model_a"))).alias("pred")
    )


@register(
    "t12_positive_label",
    duck(f"SELECT {_ID}, CASE WHEN nins > 20 THEN 1e0 WHEN nins <= 20 THEN 0e0 END AS label FROM obs"),
)
def t12_positive_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _obs(spark, sf_dir).select("row_id", S.positive_label(F.col("nins"), 20.0).alias("label"))


@register(
    "t13_label_smoothing",
    duck(
        f"""SELECT {_ID}, {r6_sql('CASE WHEN nins > 0 THEN 0.9e0 WHEN nins <= 0 THEN 0.1e0 END')} AS mild,
        {r6_sql('CASE WHEN nins > 0 THEN 0.7505e0 WHEN nins <= 0 THEN 0.2495e0 END')} AS capped FROM obs"""
    ),
)
def t13_label_smoothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = S.positive_label(F.col("nins"))
    return _obs(spark, sf_dir).select(
        "row_id", r6(S.smooth_label(label, 0.2)).alias("mild"), r6(S.smooth_label(label, 0.9)).alias("capped")
    )


_T14 = ["pressure", "humidity", "temp_a", "uv_idx"]


@register(
    "t14_standardise",
    duck(
        f"SELECT {_ID}, type, "
        + ", ".join(
            r6_sql(
                f"({c} - (SELECT avg({c}) FROM obs WHERE type = 'train')) / "
                f"(SELECT stddev_pop({c}) FROM obs WHERE type = 'train')"
            )
            + f" AS {c}"
            for c in _T14
        )
        + " FROM obs"
    ),
)
def t14_standardise(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = _obs(spark, sf_dir).select("row_id", "type", *_T14)
    stats = fit_scaler(obs.filter("type = 'train'"), _T14)
    return apply_scaler(obs, stats, _T14).select("row_id", "type", *[r6(c).alias(c) for c in _T14])


@register("t16_default_prediction", duck(f"SELECT {_ID}, coalesce(nins, 0e0) AS nins FROM obs"))
def t16_default_prediction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _obs(spark, sf_dir).select("row_id", S.default_prediction(F.col("nins")).alias("nins"))
