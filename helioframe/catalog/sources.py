"""Readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helioframe.catalog import register
from helioframe.catalog.common import KEYS, MODELS, RAW, r6, r6_sql
from helioframe.fixtures import duck, view
from helioframe.functions.calendar import parse_time
from helioframe.functions.scalars import clamp_negative
from helioframe.operators.submit import fill_template
from helioframe.session import scratch_path
from helioframe.sources.tables import (
    read_panel,
    read_plain,
    read_predictions,
    read_trio,
    read_with_rejects,
    write_delivery,
)

FILE_COLUMNS = ("row_id", "temp_a", "temp_b", "wind_spd_a", "pressure", "uv_idx")


def offset_text(df: DataFrame, time: str = "time", whole_seconds: bool = False) -> DataFrame:
    """Observation times as text with an offset, whatever the session zone is.

    Fractions of a second stay: a plant can have two observations in one second, and
    their keys must differ. ``whole_seconds`` cuts them off.
    """
    text = F.col(time).cast("string")
    if whole_seconds:
        text = F.substring(text, 1, 19)
    return df.withColumn(time, F.concat(text, F.lit("+00:00")))


def write_trio(spark: SparkSession, sf_dir: str) -> str:
    """The three input files, derived from the observation view."""
    folder = scratch_path(spark, "trio")
    obs = offset_text(view(spark, sf_dir, "obs"))
    cols = ["time", "pv_id", *FILE_COLUMNS, "type"]
    write_delivery(obs.filter("type = 'train'").select(*cols, "energy", "nins"), f"{folder}/train.csv")
    write_delivery(obs.filter("type = 'test'").select(*cols, "nins"), f"{folder}/test.csv")
    template = offset_text(view(spark, sf_dir, "template"))
    write_delivery(
        template.withColumn("nins", F.lit(None).cast("double")), f"{folder}/submission_sample.csv"
    )
    return folder


_SECONDS_SQL = "CAST(floor(epoch(time)) AS BIGINT)"


@register(
    "s1_read_trio",
    duck(
        f"""SELECT 'observations' AS source, CAST(row_id AS BIGINT) AS row_id, pv_id, type,
        {_SECONDS_SQL} AS at_second, temp_a, wind_spd_a, CAST(uv_idx AS DOUBLE) AS uv_idx, nins FROM obs
        UNION ALL SELECT 'template', NULL, pv_id, type, {_SECONDS_SQL}, NULL, NULL, NULL, NULL FROM template"""
    ),
)
def s1_read_trio(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = read_trio(spark, write_trio(spark, sf_dir), FILE_COLUMNS)
    seconds = F.unix_seconds("time").alias("at_second")
    cols = ["temp_a", "wind_spd_a", "uv_idx", "nins"]
    seen = raw.train.drop("energy").unionByName(raw.test).select(
        F.lit("observations").alias("source"), F.col("row_id").cast("bigint").alias("row_id"),
        "pv_id", "type", seconds, *cols,
    )
    empty = [F.lit(None).cast("double").alias(c) for c in cols]
    wanted = raw.template.select(
        F.lit("template").alias("source"), F.lit(None).cast("bigint").alias("row_id"),
        "pv_id", "type", seconds, *empty,
    )
    return seen.unionByName(wanted)


_TRIO_SCHEMA = ", ".join(["time string", "pv_id string", *[f"{c} double" for c in RAW], "type string", "nins double"])


def _shuffled_file(spark: SparkSession, sf_dir: str, bad: bool) -> str:
    """All observations with every weather column, columns in falling order of name.

    With ``bad``, humidity reads "n/a" in every 50th row, and every 70th has a cell too many.
    """
    path = scratch_path(spark, "shuffled")
    obs = offset_text(view(spark, sf_dir, "obs")).drop("energy")
    if bad:
        obs = obs.withColumn("humidity", F.when(F.col("row_id") % 50 == 0, F.lit("n/a")).otherwise(F.col("humidity").cast("string")))
    cols = sorted(obs.columns, reverse=True)
    if not bad:
        write_delivery(obs.select(*cols), path)
        return path
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]
    line = F.concat_ws(",", *cells, F.when(F.col("row_id") % 70 == 0, F.lit("more")))
    # One header a file, as a delivery has it: the only file starts with it.
    head = spark.createDataFrame([(",".join(cols),)], "value string")
    head.union(obs.select(line.alias("value"))).coalesce(1).write.text(path)
    return path


@register(
    "s1_columns_by_name",
    duck(
        f"""SELECT CAST(row_id AS BIGINT) AS row_id, pv_id, type, {_SECONDS_SQL} AS at_second,
        {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in RAW)}, nins FROM obs"""
    ),
)
def s1_columns_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file whose columns stand in another order than the schema's."""
    back = read_panel(spark, _shuffled_file(spark, sf_dir, False), f"row_id bigint, {_TRIO_SCHEMA}")
    return back.select("row_id", "pv_id", "type", F.unix_seconds("time").alias("at_second"), *RAW, "nins")


@register(
    "s1_rejected_lines",
    duck(
        """SELECT CAST(row_id AS BIGINT) AS row_id, row_id % 50 = 0 OR row_id % 70 = 0 AS rejected,
        CASE WHEN row_id % 50 <> 0 AND row_id % 70 <> 0 THEN humidity END AS humidity FROM obs"""
    ),
)
def s1_rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good rows of a file, and the lines that were set aside from it."""
    path = _shuffled_file(spark, sf_dir, True)
    good, rejected = read_with_rejects(spark, path, f"row_id bigint, {_TRIO_SCHEMA}")
    place = sorted(["row_id", "time", "pv_id", "type", "nins", *RAW], reverse=True).index("row_id")
    row_id = F.split("line", ",")[place].cast("bigint").alias("row_id")
    lost = rejected.select(row_id, F.lit(True).alias("rejected"), F.lit(None).cast("double").alias("humidity"))
    return good.select("row_id", F.lit(False).alias("rejected"), "humidity").union(lost)


@register(
    "s2_plain_scan",
    duck(
        f"""SELECT CAST(row_id AS BIGINT) AS row_id, pv_id, temp_b,
        strftime(time, '%Y-%m-%d %H:%M:%S') || '+00:00' AS time_text,
        {_SECONDS_SQL} AS at_second FROM obs"""
    ),
)
def s2_plain_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "plain")
    obs = offset_text(view(spark, sf_dir, "obs"), whole_seconds=True).select("row_id", "time", "pv_id", "temp_b")
    write_delivery(obs, path)
    plain = read_plain(spark, path)
    return plain.select(
        F.col("row_id").cast("bigint").alias("row_id"), "pv_id", "temp_b",
        F.col("time").alias("time_text"),
        F.unix_seconds(parse_time(F.col("time"))).alias("at_second"),
    )


def prediction_files(spark: SparkSession, sf_dir: str) -> list[str]:
    """One delivered file per model over the test rows."""
    folder = scratch_path(spark, "predictions")
    preds = offset_text(view(spark, sf_dir, "preds").filter("type = 'test'"))
    paths = []
    for m in MODELS:
        paths.append(f"{folder}/{m}.csv")
        write_delivery(preds.select(*KEYS, clamp_negative(F.col(m)).alias("nins")), paths[-1])
    return paths


@register(
    "s3_prediction_files",
    duck(
        " UNION ALL ".join(
            f"SELECT '{m}' AS model, pv_id, type, {_SECONDS_SQL} AS at_second, "
            f"{r6_sql(f'CASE WHEN {m} < 0 THEN 0e0 ELSE {m} END')} AS nins FROM preds WHERE type = 'test'"
            for m in MODELS
        )
    ),
)
def s3_prediction_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read_predictions(spark, prediction_files(spark, sf_dir))
    return df.select(
        "model", "pv_id", "type", F.unix_seconds("time").alias("at_second"), r6("nins").alias("nins")
    )


_DELIVERY = f"""
    SELECT t.time, t.pv_id, t.type, coalesce(p.nins, 0e0) AS nins FROM template t
    LEFT JOIN (SELECT time, pv_id, type, CASE WHEN model_a < 0 THEN 0e0 ELSE model_a END AS nins
               FROM preds WHERE type = 'test') p
    ON t.time = p.time AND t.pv_id = p.pv_id AND t.type = p.type"""


def delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    preds = view(spark, sf_dir, "preds").filter("type = 'test'")
    preds = preds.select(*KEYS, clamp_negative(F.col("model_a")).alias("nins"))
    return fill_template(view(spark, sf_dir, "template"), preds)


@register(
    "s4_delivery_file",
    duck(
        f"SELECT pv_id, type, {_SECONDS_SQL} AS at_second, {r6_sql('nins')} AS nins FROM delivered",
        f"delivered AS ({_DELIVERY})",
    ),
)
def s4_delivery_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "delivery") + ".csv"
    write_delivery(offset_text(delivery(spark, sf_dir)), path)
    back = read_panel(spark, path, schema="time string, pv_id string, type string, nins double")
    return back.select("pv_id", "type", F.unix_seconds("time").alias("at_second"), r6("nins").alias("nins"))


@register(
    "s5_delivery_with_index",
    duck(
        f"""SELECT row_number() OVER (ORDER BY pv_id, time) - 1 AS row_idx, pv_id,
        {_SECONDS_SQL} AS at_second, {r6_sql('nins')} AS nins FROM delivered""",
        f"delivered AS ({_DELIVERY})",
    ),
)
def s5_delivery_with_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "delivery") + ".csv"
    write_delivery(offset_text(delivery(spark, sf_dir)), path, index=["pv_id", "time"])
    schema = "_c0 bigint, time string, pv_id string, type string, nins double"
    back = read_panel(spark, path, schema=schema)
    return back.select(F.col("_c0").alias("row_idx"), "pv_id", F.unix_seconds("time").alias("at_second"), r6("nins").alias("nins"))
