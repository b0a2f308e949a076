"""Projections, schema operators, filters and sorts."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helioframe.catalog import register
from helioframe.catalog.common import DERIVED, KEYS, ORDER, PARAMS, RAW, r6, r6_sql
from helioframe.catalog.common import DIFF_SQL, TIME_SQL
from helioframe.fixtures import duck, view
from helioframe.operators import columns as C
from helioframe.operators import filters
from helioframe.plans.prepare import derive_features, select_features

_NUMBERS = ", ".join(RAW)
_SOME = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in RAW)


@register("p1_numeric_columns", duck(f"SELECT CAST(row_id AS BIGINT) AS row_id, {_NUMBERS}, energy FROM obs"))
def p1_numeric_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = view(spark, sf_dir, "obs")
    return obs.select(*C.numeric_columns(obs, exclude=["nins"]))


_ALL = TIME_SQL | DIFF_SQL


def _feature_sql(c: str) -> str:
    return r6_sql(f"CAST({_ALL.get(c, c)} AS DOUBLE)") + f" AS {c}"


@register(
    "p2_feature_list",
    duck(f"SELECT CAST(row_id AS BIGINT) AS row_id, {', '.join(_feature_sql(c) for c in sorted(DERIVED))} FROM obs"),
)
def p2_feature_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    derived = derive_features(view(spark, sf_dir, "obs"), PARAMS).drop("energy")
    return derived.select("row_id", *[r6(F.col(c).cast("double")).alias(c) for c in select_features(derived, PARAMS)])


@register("p3_columns_except", duck(f"SELECT CAST(row_id AS BIGINT) AS row_id, {_NUMBERS} FROM obs"))
def p3_columns_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.columns_except(view(spark, sf_dir, "obs"), ["time", "pv_id", "type", "energy", "nins"])


@register("p4_drop_energy", duck(f"SELECT CAST(row_id AS BIGINT) AS row_id, time, pv_id, type, {_NUMBERS}, nins FROM obs"))
def p4_drop_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "obs").drop("energy")


@register("p5_cast_columns", duck(f"SELECT CAST(row_id AS INTEGER) AS row_id, {_SOME}, CAST(nins AS FLOAT) AS nins FROM obs"))
def p5_cast_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = {"row_id": "int", "nins": "float"} | {c: "double" for c in RAW}
    return C.cast_columns(view(spark, sf_dir, "obs").select("row_id", *RAW, "nins"), types)


@register("p6_meta_columns", duck("SELECT time, pv_id, type FROM obs"))
def p6_meta_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.meta_columns(view(spark, sf_dir, "obs"), "time", "pv_id")


@register("p7_canonical_names", duck("SELECT time, pv_id, type FROM obs"))
def p7_canonical_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    site = view(spark, sf_dir, "obs").selectExpr("time AS observed_at", "pv_id AS site", "type")
    return C.canonical_names(site, "observed_at", "site")


@register("p8_default_type", duck("SELECT time, pv_id, 'test' AS type FROM obs"))
def p8_default_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.meta_columns(view(spark, sf_dir, "obs").drop("type"), "time", "pv_id")


@register(
    "p9_feature_vector",
    duck("SELECT CAST(row_id AS BIGINT) AS row_id, coord1 AS x0, humidity AS x1, CAST(uv_idx AS DOUBLE) AS x2 FROM obs"),
)
def p9_feature_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = C.assemble(view(spark, sf_dir, "obs"), ["coord1", "humidity", "uv_idx"])
    x = vector_to_array("features")
    return df.select("row_id", *[x[i].alias(f"x{i}") for i in range(3)])


@register(
    "p10_attach_prediction",
    duck(
        f"""SELECT CAST(o.row_id AS BIGINT) AS row_id, o.pv_id, {r6_sql('p.model_b')} AS prediction
        FROM obs o LEFT JOIN preds p ON o.row_id = p.row_id"""
    ),
)
def p10_attach_prediction(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = view(spark, sf_dir, "obs").select("row_id", "pv_id")
    return C.attach_by_key(obs, view(spark, sf_dir, "preds"), ["row_id"], r6("model_b").alias("prediction"))


@register(
    "p11_row_index",
    duck("SELECT row_number() OVER (ORDER BY time, row_id) - 1 AS row_idx, CAST(row_id AS BIGINT) AS row_id FROM obs"),
)
def p11_row_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = view(spark, sf_dir, "obs").select(*ORDER)
    return C.row_index(obs, ORDER).select("row_idx", "row_id")


# --- filters ---------------------------------------------------------------

_BUSY = "SELECT pv_id FROM obs GROUP BY pv_id HAVING count(*) > 70"


def _busy(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = view(spark, sf_dir, "obs").groupBy("pv_id").count()
    return counts.filter("count > 70").select("pv_id")


@register("f1_with_target", duck("SELECT CAST(row_id AS BIGINT) AS row_id, nins FROM obs WHERE nins IS NOT NULL"))
def f1_with_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.with_target(view(spark, sf_dir, "obs"), "nins").select("row_id", "nins")


@register("f2_members", duck(f"SELECT CAST(row_id AS BIGINT) AS row_id, pv_id FROM obs WHERE pv_id IN ({_BUSY})"))
def f2_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = view(spark, sf_dir, "obs").select("row_id", "pv_id")
    return filters.members(obs, "pv_id", _busy(spark, sf_dir))


@register("f3_non_members", duck(f"SELECT CAST(row_id AS BIGINT) AS row_id, pv_id FROM obs WHERE pv_id NOT IN ({_BUSY})"))
def f3_non_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = view(spark, sf_dir, "obs").select("row_id", "pv_id")
    return filters.non_members(obs, "pv_id", _busy(spark, sf_dir))


@register("f4_positives", duck("SELECT CAST(row_id AS BIGINT) AS row_id, nins FROM obs WHERE nins > 10"))
def f4_positives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.positives(view(spark, sf_dir, "obs"), "nins", 10.0).select("row_id", "nins")


@register(
    "f5_complete_rows",
    duck(
        """SELECT CAST(row_id AS BIGINT) AS row_id, temp_a, wind_spd_b, rel_hum FROM obs
        WHERE temp_a IS NOT NULL AND wind_spd_b IS NOT NULL AND rel_hum IS NOT NULL"""
    ),
)
def f5_complete_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["temp_a", "wind_spd_b", "rel_hum"]
    return filters.complete_rows(view(spark, sf_dir, "obs"), cols).select("row_id", *cols)


@register(
    "f6_any_match",
    duck(
        """SELECT type, coalesce(bool_or(nins > 400), FALSE) AS any_large, count(nins) = 0 AS no_targets,
        coalesce(bool_or(snow > 0), FALSE) AS any_snow FROM obs GROUP BY type"""
    ),
)
def f6_any_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "obs").groupBy("type").agg(
        filters.any_match(F.col("nins") > 400).alias("any_large"),
        (~filters.any_match(F.col("nins").isNotNull())).alias("no_targets"),
        filters.any_match(F.col("snow") > 0).alias("any_snow"),
    )


@register("f7_group_guard", duck("SELECT type, count(DISTINCT pv_id) AS n_groups FROM obs GROUP BY type"))
def f7_group_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = view(spark, sf_dir, "obs")
    filters.require_groups(obs, "pv_id")
    return obs.groupBy("type").agg(F.count_distinct("pv_id").alias("n_groups"))


# --- sorts, limits, sets -----------------------------------------------------


@register("o1_sort_series", duck("SELECT pv_id, time, CAST(row_id AS BIGINT) AS row_id, temp_a FROM obs"))
def o1_sort_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "obs").select("pv_id", *ORDER, "temp_a").orderBy("pv_id", *ORDER)


@register("o2_sorted_ids", duck("SELECT DISTINCT pv_id FROM obs ORDER BY pv_id"))
def o2_sorted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "obs").select("pv_id").distinct().orderBy("pv_id")


@register("o3_head", duck("SELECT time, CAST(row_id AS BIGINT) AS row_id, pv_id, nins FROM obs ORDER BY time, row_id LIMIT 5"))
def o3_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "obs").select(*ORDER, "pv_id", "nins").orderBy(*ORDER).limit(5)
