"""Gap filling of panel series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helioframe.operators.ranges import MAX_GROUP_ROWS, PIECE_ROWS, as_series, fill_both_ways, running
from helioframe.session import stage


def ffill(
    df: DataFrame, by: list[str], order: list[str], cols: list[str],
    max_group_rows: int | None = MAX_GROUP_ROWS, piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Carry the last value forward in time order; NaN counts as a value."""
    series = as_series(df, by, order, max_group_rows, piece_rows)
    return running(series, {c: ("last", F.col(c)) for c in cols})


def bfill(
    df: DataFrame, by: list[str], order: list[str], cols: list[str],
    max_group_rows: int | None = MAX_GROUP_ROWS, piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Carry the next value back.

    Runs as a forward pass over descending order: a frame that grows from the
    current row to the end of the group would be recomputed for every row.
    """
    series = as_series(df, by, order, max_group_rows, piece_rows)
    return running(series, {c: ("last", F.col(c)) for c in cols}, reverse=True)


def column_means(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row with the mean of every column; a missing or NaN mean is 0."""
    mean = [F.coalesce(F.nanvl(F.avg(c), F.lit(0.0)), F.lit(0.0)).alias(c) for c in cols]
    return df.agg(*mean)


def one_row(stats: DataFrame) -> Column:
    """A one-row frame as a struct that joins to nothing: a scalar subquery."""
    return stats.select(F.struct(*stats.columns)).scalar()


def fill_with(df: DataFrame, cols: list[str], stats: DataFrame) -> DataFrame:
    """Replace remaining nulls by the value of the same name in ``stats``."""
    if not cols:
        return df
    return (
        df.withColumn("_stats", one_row(stats))
        .withColumns({c: F.coalesce(F.col(c), F.col("_stats")[c]) for c in cols})
        .drop("_stats")
    )


def fill_missing(
    df: DataFrame,
    by: list[str],
    order: list[str],
    cols: list[str],
    *,
    staged: bool = True,
    means_of: Column | None = None,
    max_group_rows: int | None = MAX_GROUP_ROWS,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Forward fill, backward fill, column mean, and 0 for a column without values.

    Means are taken after the directional fills, over all rows or over those
    where ``means_of`` holds. The directional result is written once (``staged``), so
    the means and every later reader start from the written table instead of
    repeating the window.
    """
    if not cols:
        return df
    doubles = df.withColumns({c: F.col(c).cast("double") for c in cols})
    filled = fill_both_ways(as_series(doubles, by, order, max_group_rows, piece_rows), cols)
    if staged:
        filled = stage(filled, "filled")
    basis = filled if means_of is None else filled.filter(means_of)
    return fill_with(filled, cols, column_means(basis, cols))
