"""Views over the driver tables, written once for Spark SQL and for DuckDB.

``{events}`` is the events table: a parquet path for Spark, a table name for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

OBS = """
SELECT event_id AS row_id, ts AS time,
  concat('pv', lpad(CAST(user_id AS STRING), 8, '0')) AS pv_id,
  CASE WHEN user_id % 5 = 0 THEN 'test' ELSE 'train' END AS type,
  CASE WHEN event_id % 4 = 0 THEN CAST(event_id % 37 AS DOUBLE) - 5e0 END AS temp_a,
  CASE WHEN event_id % 3 = 0 THEN CAST(event_id % 31 AS DOUBLE) END AS temp_b,
  CASE WHEN user_id % 10 NOT IN (0, 3) AND event_id % 5 = 0 THEN CAST(event_id % 11 AS DOUBLE) END AS wind_spd_a,
  CASE WHEN event_id % 2 = 0 THEN CAST(event_id % 13 AS DOUBLE) END AS wind_spd_b,
  1000e0 + CAST(event_id % 23 AS DOUBLE) AS pressure,
  990e0 + CAST(event_id % 19 AS DOUBLE) AS ground_press,
  CAST(event_id % 101 AS DOUBLE) AS humidity,
  CASE WHEN event_id % 6 <> 0 THEN CAST(event_id % 97 AS DOUBLE) END AS rel_hum,
  CAST(NULL AS DOUBLE) AS snow,
  CAST(event_id % 12 AS INT) AS uv_idx,
  CAST(user_id % 13 AS DOUBLE) AS coord1,
  CASE WHEN user_id % 5 <> 0 THEN value / 4e0 END AS energy,
  CASE WHEN event_id % 29 = 0 THEN NULL
       WHEN hour(ts) < 6 OR hour(ts) >= 19 THEN 0e0 ELSE value END AS nins
FROM {events}
"""

PREDS = """
SELECT row_id, time, pv_id, type, nins AS y,
  CASE WHEN row_id % 17 = 0 THEN -1.5e0 ELSE coalesce(nins, 0e0) * 0.9e0 + 2e0 END AS model_a,
  coalesce(nins, 0e0) * 1.1e0 - 3e0 AS model_b,
  coalesce(nins, 0e0) + CAST(row_id % 7 AS DOUBLE) - 3e0 AS model_c,
  CAST(row_id % 9 AS DOUBLE) / 2e0 - 2e0 AS logit
FROM obs
"""

TEMPLATE = """
SELECT time, pv_id, type FROM obs WHERE type = 'test'
UNION ALL
SELECT time + INTERVAL '1' YEAR AS time, pv_id, type FROM obs WHERE type = 'test' AND nins IS NULL
"""

RUNS = """
SELECT concat('run', CAST(CAST(floor(event_id / 40) AS BIGINT) AS STRING)) AS run_id,
  CAST(event_id % 40 AS INT) AS epoch,
  CASE WHEN event_id % 37 = 36 THEN NULL
       ELSE abs(20e0 - CAST(event_id % 40 AS DOUBLE)) + CAST(event_id % 3 AS DOUBLE) END AS mae
FROM {events}
"""

VIEWS = {"obs": OBS, "preds": PREDS, "template": TEMPLATE, "runs": RUNS}


def _with_clause(names: list[str], events: str) -> str:
    parts = [f"{n} AS ({VIEWS[n].format(events=events)})" for n in names]
    return "WITH " + ", ".join(parts)


def _needed(name: str) -> list[str]:
    return ["obs", name] if name in ("preds", "template") else [name]


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture view as a DataFrame over ``<sf_dir>/events.parquet``."""
    clause = _with_clause(_needed(name), f"parquet.`{sf_dir}/events.parquet`")
    return spark.sql(f"{clause} SELECT * FROM {name}")


def duck(query: str, *more: str) -> str:
    """DuckDB text: the views that ``query`` names, then extra CTEs, then the query.

    ``more`` holds "name AS (...)" texts; ``query`` is the final SELECT.
    """
    text = " ".join([query, *more])
    names = [n for n in VIEWS if n in text.replace("(", " ").replace(")", " ").replace(",", " ").split()]
    if "obs" not in names and ({"preds", "template"} & set(names)):
        names.insert(0, "obs")
    clause = _with_clause(names, "events")
    return ", ".join([clause, *more]) + " " + query
