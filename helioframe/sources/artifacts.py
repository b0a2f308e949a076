"""Saved models: Spark ML folders beside one-row JSON descriptions."""

from __future__ import annotations

import json
import math
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SIDECAR = "description"
_ENTRY = "serial bigint, version string, epoch int, mae double, removed boolean"


def finite(value: float | None) -> bool:
    return value is not None and math.isfinite(value)


def new_version() -> str:
    return f"v-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _lines(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.text(path)
    except AnalysisException:
        return None


def save_description(spark: SparkSession, path: str, description: dict) -> None:
    """Publish what was written below ``path``: one more line, which appears whole or not at all.

    The line of greatest ``serial`` is the one that counts, so until it is there a reader
    sees the model that was saved before.
    """
    known = _lines(spark, f"{path}/{SIDECAR}")
    serial = 0 if known is None else known.count()
    row = [(json.dumps(description | {"serial": serial}, sort_keys=True),)]
    spark.createDataFrame(row, "value string").write.mode("append").text(f"{path}/{SIDECAR}")


def load_description(spark: SparkSession, path: str) -> dict:
    known = _lines(spark, f"{path}/{SIDECAR}")
    serial = F.get_json_object("value", "$.serial").cast("bigint")
    row = None if known is None else known.orderBy(F.desc(serial)).first()
    if row is None:
        raise FileNotFoundError(f"no saved model at {path}")
    return json.loads(row[0])


# --- the list of a model store: one line for each version that was published or removed


def add_entry(spark: SparkSession, root: str, version: str, epoch: int, mae: float, removed: bool = False) -> None:
    known = _lines(spark, f"{root}/manifest")
    entry = {"serial": 0 if known is None else known.count(), "version": version, "epoch": epoch, "mae": mae, "removed": removed}
    spark.createDataFrame([(json.dumps(entry),)], "value string").write.mode("append").text(f"{root}/manifest")


def entries(spark: SparkSession, root: str) -> DataFrame:
    """``serial``, ``version``, ``epoch`` and ``mae`` of the published versions that were not removed."""
    known = _lines(spark, f"{root}/manifest")
    if known is None:
        return spark.createDataFrame([], _ENTRY).drop("removed")
    rows = known.select(F.from_json("value", _ENTRY).alias("e")).select("e.*")
    gone = rows.where("removed").select("version")
    return rows.join(gone, "version", "left_anti").select("serial", "version", "epoch", "mae")
