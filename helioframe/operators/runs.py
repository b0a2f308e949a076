"""Training-run histories: progress, early stopping and best checkpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helioframe.operators.ranges import MAX_GROUP_ROWS, PIECE_ROWS, as_series, group_sizes, running
from helioframe.session import stage


def training_progress(
    history: DataFrame, run: str, epoch: str, metric: str,
    max_group_rows: int | None = MAX_GROUP_ROWS, piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Per epoch: best metric so far, whether it improved, and epochs without gain.

    Only a strictly lower value is an improvement; a missing or NaN value is not.
    """
    score = F.nanvl(F.col(metric), F.lit(None).cast("double"))
    rows = history.select(run, epoch, score.alias(metric))
    sizes = None if max_group_rows is None else stage(group_sizes(rows, [run]), "run-sizes")
    seen = running(
        as_series(rows, [run], [epoch], max_group_rows, piece_rows, sizes),
        {"_best_before": ("min", F.col(metric)), "_epochs_before": ("sum", F.lit(1))},
        before=True,
    )
    gain = F.coalesce(
        (F.col(metric) < F.col("_best_before"))
        | (F.col("_best_before").isNull() & F.col(metric).isNotNull()),
        F.lit(False),
    )
    marked = seen.withColumn("improved", gain).withColumn(
        "_step", F.coalesce(F.col("_epochs_before"), F.lit(0)) + 1
    )
    # The same keys and order as above, so without split groups no new shuffle.
    last = running(
        as_series(marked, [run], [epoch], max_group_rows, piece_rows, sizes),
        {
            "_gain_step": ("last", F.when(F.col("improved"), F.col("_step"))),
            "best_epoch": ("last", F.when(F.col("improved"), F.col(epoch))),
        },
    )
    return last.select(
        run,
        epoch,
        metric,
        F.least("_best_before", metric).alias("best_so_far"),
        "best_epoch",
        "improved",
        (F.col("_step") - F.coalesce(F.col("_gain_step"), F.lit(0))).alias("epochs_without_gain"),
    )


def early_stop(
    history: DataFrame, run: str, epoch: str, metric: str, patience: int,
    max_group_rows: int | None = MAX_GROUP_ROWS, piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Per run: the stopping epoch (null if never) and the best epoch up to it.

    The row of the stopping epoch already knows the best result before it, so one
    mergeable aggregate per run is enough.
    """
    progress = training_progress(history, run, epoch, metric, max_group_rows, piece_rows)
    state = F.struct("best_epoch", F.col("best_so_far").alias(f"best_{metric}"))
    stopped = F.when(F.col("epochs_without_gain") >= patience, F.col(epoch))
    return (
        progress.groupBy(run)
        .agg(
            F.min(stopped).alias("stop_epoch"),
            F.coalesce(F.min_by(state, stopped), F.max_by(state, epoch)).alias("_state"),
        )
        .select(run, "stop_epoch", "_state.*")
    )


def best_runs(
    history: DataFrame, run: str, epoch: str, metric: str, k: int
) -> DataFrame:
    """The max(1, k) lowest finite metrics per run, earliest epoch first on ties.

    Spark cuts every input partition down to k rows per run before the shuffle,
    so a run with most of the rows still sends few.
    """
    finite = history.filter(
        F.col(metric).isNotNull()
        & ~F.isnan(metric)
        & (F.abs(metric) < F.lit(float("inf")))
    )
    w = Window.partitionBy(run).orderBy(metric, epoch)
    return (
        finite.select(run, epoch, metric)
        .withColumn("place", F.row_number().over(w))
        .filter(F.col("place") <= max(1, k))
    )
