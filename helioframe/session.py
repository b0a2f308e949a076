"""Session helpers: durable staging, scratch folders and size-checked broadcasts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest table, in rows and in bytes of values, that is ever broadcast. Above either,
# callers of broadcast_if_small fall back to a shuffle join with the same result.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32_000_000


def local_session(cores: str = "8", app: str = "helioframe") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Without that setting, a folder below the warehouse in local mode; on a cluster, whose
    executors need not share the warehouse's file system, an error.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


_runs: list[str] = []  # folders of the scratch_run blocks that are open, innermost last


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[None]:
    """Whatever is staged inside the block is deleted at its end."""
    folder = f"{checkpoint_root(spark)}/run-{uuid.uuid4().hex}"
    _runs.append(folder)
    try:
        yield
    finally:
        _runs.remove(folder)
        _delete(spark, folder)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared checkpoint folder."""
    return f"{_runs[-1] if _runs else checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"


# Removes the shuffle files of a query when it ends, instead of when the driver collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written table.

    Cuts the lineage, survives lost executors, and fixes values such as
    partition ids that would differ in a second evaluation. Parquet keeps later
    reads column-pruned. Shuffle files of the write go when it is done, since
    nothing but the written table is read after it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    staged = spark.read.schema(df.schema).parquet(path)
    staged.staged_at = path
    return staged


def discard(*staged: DataFrame) -> None:
    """Delete tables of ``stage`` that no later step reads, neither directly nor through a plan made from them."""
    for df in staged:
        _delete(df.sparkSession, df.staged_at)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint behind a count of rows and bytes; beyond it the join is left to shuffle.

    One pre-aggregated pass over the frame; pass a staged or cheap one.
    """
    size = F.lit(0)
    for f in df.schema.fields:
        wide = isinstance(f.dataType, (T.StringType, T.BinaryType))
        size = size + (F.coalesce(F.octet_length(f.name), F.lit(0)) + 8 if wide else F.lit(16))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    return F.broadcast(df) if row["n"] <= max_rows and row["bytes"] <= BROADCAST_BYTES else df
