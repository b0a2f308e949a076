"""CSV sources and sinks."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helioframe.functions.calendar import parse_time
from helioframe.operators.ranges import range_positions
from helioframe.session import stage

# The columns of the observation files, in file order. Times are
# text with an offset; every column between the ids and ``type`` is a double.
WEATHER_COLUMNS = (
    "appr_temp", "ceiling", "cloud_b", "dew_point", "precip_1h", "pressure", "real_feel_temp",
    "real_feel_temp_shade", "rel_hum", "temp_b", "uv_idx", "vis", "wind_chill_temp", "wind_dir_b",
    "wind_gust_spd", "wind_spd_b", "cloud_a", "ground_press", "humidity", "rain", "snow", "temp_a",
    "temp_max", "temp_min", "wind_dir_a", "wind_spd_a", "coord1", "coord2",
)


def panel_schema(columns: tuple[str, ...] = WEATHER_COLUMNS, energy: bool = True) -> T.StructType:
    """Explicit schema of an observation file; types are never guessed from a prefix."""
    schema = T.StructType([T.StructField("time", T.StringType()), T.StructField("pv_id", T.StringType())])
    for c in columns:
        schema.add(c, T.DoubleType())
    schema.add("type", T.StringType())
    if energy:
        schema.add("energy", T.DoubleType())
    return schema.add("nins", T.DoubleType())


SUBMISSION_SCHEMA = T.StructType(
    [
        T.StructField("time", T.StringType()),
        T.StructField("pv_id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("nins", T.DoubleType()),
    ]
)


BAD_LINE = "_bad_line"


def _struct(schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def bind_header(spark: SparkSession, path: str, schema: T.StructType | str) -> T.StructType:
    """``schema`` in the order of the file's header.

    Columns are found by name, so their order in the file does not matter. A column that
    the header lacks is an error; columns that only the file has are read as text.
    """
    names = spark.read.option("header", True).csv(path).columns  # reads the first line only
    wanted = {f.name: f for f in _struct(schema).fields}
    missing = [c for c in wanted if c not in names]
    if missing:
        raise ValueError(f"columns {missing} are not in the header of {path}: {names}")
    return T.StructType([wanted.get(c, T.StructField(c, T.StringType())) for c in names])


def _bound(spark: SparkSession, path: str, schema: T.StructType | str, mode: str, extra: str | None = None) -> DataFrame:
    bound = bind_header(spark, path, schema)
    # Other files of a folder must have the header of the first one.
    reader = spark.read.option("header", True).option("enforceSchema", False).option("mode", mode)
    if extra:
        bound = T.StructType([*bound.fields, T.StructField(extra, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", extra).option("columnPruning", False)
    return reader.schema(bound).csv(path)


def read_plain(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None, strict: bool = True
) -> DataFrame:
    """CSV with a header and no date parsing; types are inferred only without a schema.

    With a schema, columns are bound by header name, file by file, and returned in the
    order of the schema. A text that is no value of its column is an error when it is
    read; ``strict=False`` makes it null (``read_with_rejects`` sets its line aside).
    """
    if schema is None:
        return spark.read.option("header", True).option("inferSchema", True).option("timestampFormat", "'none'").csv(path)
    mode = "FAILFAST" if strict else "PERMISSIVE"
    names = _struct(schema).fieldNames()
    frames = [_bound(spark, p, schema, mode).select(*names) for p in ([path] if isinstance(path, str) else path)]
    return reduce(DataFrame.unionByName, frames)


def read_with_rejects(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str
) -> tuple[DataFrame, DataFrame]:
    """(rows that fit the schema, lines that do not).

    A line is set aside when it has a text that is no value of its column, or more or
    fewer cells than the header. Its row has ``file`` and ``line``. The files are parsed once.
    """
    names = _struct(schema).fieldNames()
    frames = [
        _bound(spark, p, schema, "PERMISSIVE", BAD_LINE).select(*names, BAD_LINE, F.col("_metadata.file_path").alias("_file"))
        for p in ([path] if isinstance(path, str) else path)
    ]
    parsed = stage(reduce(DataFrame.unionByName, frames), "parsed")
    bad = F.col(BAD_LINE).isNotNull()
    return parsed.where(~bad).select(*names), parsed.where(bad).select(F.col("_file").alias("file"), F.col(BAD_LINE).alias("line"))


def read_panel(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    time: str = "time",
    strict: bool = True,
) -> DataFrame:
    """CSV whose ``time`` text is parsed to a timestamp.

    A text that is no time, or no value of its column, is an error when its row is read;
    ``strict=False`` makes it null.
    """
    df = read_plain(spark, path, schema, strict)
    if isinstance(df.schema[time].dataType, T.DatetimeType):
        return df
    return df.withColumn(time, parse_time(F.col(time), strict=strict))


@dataclass(frozen=True)
class RawTables:
    train: DataFrame
    test: DataFrame
    template: DataFrame


def read_trio(
    spark: SparkSession,
    folder: str,
    columns: tuple[str, ...] = WEATHER_COLUMNS,
    template_name: str = "submission_sample.csv",
) -> RawTables:
    """Training, test and template files of one folder."""
    return RawTables(
        read_panel(spark, f"{folder}/train.csv", panel_schema(columns)),
        read_panel(spark, f"{folder}/test.csv", panel_schema(columns, energy=False)),
        read_panel(spark, f"{folder}/{template_name}", SUBMISSION_SCHEMA),
    )


def read_predictions(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Prediction files, each bound by its own header; ``model`` is the name given in the path.

    A path may be one file or a folder written by Spark.
    """
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.csv(/[^/]*)?$", 1)
    names = SUBMISSION_SCHEMA.fieldNames()
    frames = [_bound(spark, p, SUBMISSION_SCHEMA, "FAILFAST").select(*names, name.alias("model")) for p in paths]
    return reduce(DataFrame.unionByName, frames).withColumn("time", parse_time(F.col("time")))


def time_text(df: DataFrame, time: str = "time", fmt: str | None = None) -> DataFrame:
    """Times as text; by default with an offset, and with the fraction of a second where there is one."""
    if fmt is not None:
        return df.withColumn(time, F.date_format(time, fmt))
    whole = F.date_format(time, "SSSSSS") == "000000"
    text = F.when(whole, F.date_format(time, "yyyy-MM-dd HH:mm:ssxxx"))
    return df.withColumn(time, text.otherwise(F.date_format(time, "yyyy-MM-dd HH:mm:ss.SSSSSSxxx")))


def write_delivery(
    df: DataFrame,
    path: str,
    time: str | None = "time",
    fmt: str | None = None,
    single_file: bool = False,
    index: list[str] | None = None,
) -> None:
    """CSV with a header.

    ``index`` adds a leading unnamed row number in that order. ``single_file`` has one
    task copy the finished rows into one file; the default writes one file per
    partition, which is the way for large results.
    """
    if index:
        df = range_positions(df, index, "_c0").select("_c0", *df.columns)
    if time is not None and isinstance(df.schema[time].dataType, T.DatetimeType):
        df = time_text(df, time, fmt)
    if single_file:
        df = stage(df, "delivery").coalesce(1)
    df.write.mode("overwrite").option("header", True).csv(path)
