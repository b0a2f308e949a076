"""Columns and SQL fragments shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from helioframe.functions.calendar import CALENDAR_PARTS, CYCLIC_PARTS
from helioframe.params import RunParams

SEED = 42
BY = ["pv_id"]
ORDER = ["time", "row_id"]
KEYS = ["time", "pv_id", "type"]
MODELS = ["model_a", "model_b", "model_c"]
RAW = [
    "temp_a", "temp_b", "wind_spd_a", "wind_spd_b", "pressure", "ground_press", "humidity",
    "rel_hum", "snow", "uv_idx", "coord1",
]
GAPPY = ["temp_a", "temp_b", "wind_spd_a", "wind_spd_b", "rel_hum", "snow"]
DIFFERENCES = ["temp_diff_ab", "wind_spd_diff", "pressure_gradient", "humidity_gap"]
DERIVED = [*RAW, *CALENDAR_PARTS, *CYCLIC_PARTS, *DIFFERENCES]
PARAMS = RunParams(tie_break=("row_id",))


def r6(c: str | Column) -> Column:
    return F.round(c, 6) + F.lit(0.0)


def r6_sql(text: str) -> str:
    return f"(round({text}, 6) + 0e0)"


TIME_SQL = {
    "hour": "CAST(hour(time) AS BIGINT)",
    "minute": "CAST(minute(time) AS BIGINT)",
    "day": "CAST(day(time) AS BIGINT)",
    "month": "CAST(month(time) AS BIGINT)",
    "weekday": "CAST(isodow(time) AS BIGINT)",
    "day_of_year": "CAST(dayofyear(time) AS BIGINT)",
    "hour_sin": "sin(hour(time) * 2 * pi() / 24)",
    "hour_cos": "cos(hour(time) * 2 * pi() / 24)",
    "day_of_year_sin": "sin(dayofyear(time) * 2 * pi() / 365)",
    "day_of_year_cos": "cos(dayofyear(time) * 2 * pi() / 365)",
    "month_sin": "sin((month(time) - 1) * 2 * pi() / 12)",
    "month_cos": "cos((month(time) - 1) * 2 * pi() / 12)",
}
DIFF_SQL = {
    "temp_diff_ab": "temp_a - temp_b",
    "wind_spd_diff": "wind_spd_a - wind_spd_b",
    "pressure_gradient": "pressure - ground_press",
    "humidity_gap": "humidity - rel_hum",
}
_SERIES = "PARTITION BY pv_id ORDER BY time, row_id ROWS BETWEEN"


def ffill_sql(c: str) -> str:
    return f"last_value({c} IGNORE NULLS) OVER ({_SERIES} UNBOUNDED PRECEDING AND CURRENT ROW)"


def bfill_sql(c: str) -> str:
    return f"first_value({c} IGNORE NULLS) OVER ({_SERIES} CURRENT ROW AND UNBOUNDED FOLLOWING)"


def directional_cte(source: str, cols: list[str], keep: str, name: str = "filled") -> str:
    """CTE with every column filled forward, then backward."""
    forward = ", ".join(f"{ffill_sql(c)} AS {c}" for c in cols)
    backward = ", ".join(f"{bfill_sql(c)} AS {c}" for c in cols)
    return (
        f"{name}_fwd AS (SELECT {keep}, {forward} FROM {source}), "
        f"{name} AS (SELECT {keep}, {backward} FROM {name}_fwd)"
    )


def positive_part_sql(c: str) -> str:
    return f"CASE WHEN {c} < 0 THEN 0e0 ELSE {c} END"
