"""Series windows: gap filling, early stopping, best checkpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helioframe.catalog import register
from helioframe.catalog.common import (
    BY, GAPPY, ORDER, bfill_sql, directional_cte, ffill_sql, r6, r6_sql,
)
from helioframe.fixtures import duck, view
from helioframe.operators.fill import bfill, ffill, fill_missing
from helioframe.operators.runs import best_runs, early_stop, training_progress

_ID = "CAST(row_id AS BIGINT) AS row_id"

# Small enough that every series of the test tables takes the split path.
SPLIT = {"max_group_rows": 10, "piece_rows": 500}


def _panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "obs").select(*BY, *ORDER, *GAPPY)


@register("w1_forward_fill", duck(f"SELECT {_ID}, {', '.join(f'{ffill_sql(c)} AS {c}' for c in GAPPY)} FROM obs"))
def w1_forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ffill(_panel(spark, sf_dir), BY, ORDER, GAPPY).select("row_id", *GAPPY)


@register("w2_backward_fill", duck(f"SELECT {_ID}, {', '.join(f'{bfill_sql(c)} AS {c}' for c in GAPPY)} FROM obs"))
def w2_backward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bfill(_panel(spark, sf_dir), BY, ORDER, GAPPY).select("row_id", *GAPPY)


_FILLED = duck(
    f"SELECT {_ID}, "
    + ", ".join(f"{r6_sql(f'coalesce({c}, (SELECT avg({c}) FROM filled), 0e0)')} AS {c}" for c in GAPPY)
    + " FROM filled",
    directional_cte("obs", GAPPY, "row_id, pv_id, time"),
)


@register("w3_fill_missing", _FILLED)
def w3_fill_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = fill_missing(_panel(spark, sf_dir), BY, ORDER, GAPPY)
    return filled.select("row_id", *[r6(c).alias(c) for c in GAPPY])


@register("w3_fill_missing_split", _FILLED)
def w3_fill_missing_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = fill_missing(
        _panel(spark, sf_dir), BY, ORDER, GAPPY, staged=True, **SPLIT
    )
    return filled.select("row_id", *[r6(c).alias(c) for c in GAPPY])


@register("w1_forward_fill_split", duck(f"SELECT {_ID}, {', '.join(f'{ffill_sql(c)} AS {c}' for c in GAPPY)} FROM obs"))
def w1_forward_fill_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ffill(_panel(spark, sf_dir), BY, ORDER, GAPPY, **SPLIT)
    return out.select("row_id", *GAPPY)


@register("w2_backward_fill_split", duck(f"SELECT {_ID}, {', '.join(f'{bfill_sql(c)} AS {c}' for c in GAPPY)} FROM obs"))
def w2_backward_fill_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bfill(_panel(spark, sf_dir), BY, ORDER, GAPPY, **SPLIT)
    return out.select("row_id", *GAPPY)


_RUN = "PARTITION BY run_id ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND"
_PROGRESS = [
    f"""steps AS (SELECT run_id, epoch, mae, min(mae) OVER ({_RUN} 1 PRECEDING) AS before,
      row_number() OVER (PARTITION BY run_id ORDER BY epoch) AS step FROM runs)""",
    """gains AS (SELECT *, coalesce(mae < before, before IS NULL AND mae IS NOT NULL) AS improved FROM steps)""",
    f"""progress AS (SELECT run_id, epoch, mae, min(mae) OVER ({_RUN} CURRENT ROW) AS best_so_far,
      last_value(CASE WHEN improved THEN epoch END IGNORE NULLS) OVER ({_RUN} CURRENT ROW) AS best_epoch, improved,
      step - coalesce(max(CASE WHEN improved THEN step END) OVER ({_RUN} CURRENT ROW), 0) AS epochs_without_gain
      FROM gains)""",
]
_PROGRESS_QUERY = duck("SELECT * FROM progress", *_PROGRESS)


@register("w4_training_progress", _PROGRESS_QUERY)
def w4_training_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_progress(view(spark, sf_dir, "runs"), "run_id", "epoch", "mae")


@register("w4_training_progress_split", _PROGRESS_QUERY)
def w4_training_progress_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_progress(view(spark, sf_dir, "runs"), "run_id", "epoch", "mae", **SPLIT)


@register(
    "w4_early_stop",
    duck(
        """SELECT p.run_id, s.stop_epoch, max(p.epoch) AS best_epoch, min(p.mae) AS best_mae
        FROM progress p JOIN (SELECT run_id, min(CASE WHEN epochs_without_gain >= 4 THEN epoch END) AS stop_epoch
          FROM progress GROUP BY run_id) s ON p.run_id = s.run_id
        WHERE improved AND (stop_epoch IS NULL OR p.epoch <= stop_epoch) GROUP BY p.run_id, s.stop_epoch""",
        *_PROGRESS,
    ),
)
def w4_early_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return early_stop(view(spark, sf_dir, "runs"), "run_id", "epoch", "mae", patience=4)


@register(
    "w5_best_checkpoints",
    duck(
        """SELECT run_id, epoch, mae, CAST(place AS INTEGER) AS place FROM (
        SELECT run_id, epoch, mae, row_number() OVER (PARTITION BY run_id ORDER BY mae, epoch) AS place
        FROM runs WHERE mae IS NOT NULL) WHERE place <= 3"""
    ),
)
def w5_best_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_runs(view(spark, sf_dir, "runs"), "run_id", "epoch", "mae", 3)
