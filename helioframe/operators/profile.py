"""Table profiles: counts, summary statistics, histograms, correlations."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from helioframe.operators.ranges import running_totals
from helioframe.session import stage

# Sketch accuracy: a quantile sketch is off by at most rows / ACCURACY ranks.
ACCURACY = 10_000


def _long(row: DataFrame, cols: list[str], fields: dict[str, str]) -> DataFrame:
    """One row of ``<column><suffix>`` values to one row per column."""
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            *[F.col(f"{c}{suffix}").alias(name) for name, suffix in fields.items()],
        )
        for c in cols
    ]
    return row.select(F.explode(F.array(*entries)).alias("_e")).select("_e.*")


def null_counts(df: DataFrame) -> DataFrame:
    """Null count of every column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}__n") for c in df.columns])
    return _long(counts, df.columns, {"null_count": "__n"})


def row_counts(df: DataFrame, by: str) -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"))


def group_counts(df: DataFrame, by: str, group: str, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct(group) if approximate else F.count_distinct(group)
    return df.groupBy(by).agg(count.alias("n_groups"))


def _number(c: str) -> Column:
    """Column as double with NaN treated as missing."""
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def _long_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """(k, v): number of the column and its value, one row per cell.

    One grouped aggregate over cells compiles to a tight loop, where hundreds of
    aggregates over a wide row would be interpreted.
    """
    cells = F.array(*[F.struct(F.lit(i).alias("k"), _number(c).alias("v")) for i, c in enumerate(cols)])
    return df.select(F.explode(cells).alias("_e")).select("_e.*")


def _summaries(df: DataFrame, cols: list[str], sketch: list[float], accuracy: int) -> dict[int, Row]:
    """Per column: counts, moments, extremes and a quantile sketch; one row each."""
    v = F.col("v")
    rows = _long_values(df, cols).groupBy("k").agg(
        F.count(v).alias("n"),
        F.count_if(v.isNull()).alias("nulls"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"),
        F.min(v).alias("lo"),
        F.max(v).alias("hi"),
        F.percentile_approx(v, sketch, accuracy).alias("q"),
    )
    return {r["k"]: r for r in rows.collect()}


def _sides(probs: list[float], accuracy: int) -> list[float]:
    margin = 2.0 / accuracy
    return sorted({max(p - margin, 0.0) for p in probs} | {min(p + margin, 1.0) for p in probs})


def _bracketed(df: DataFrame, cols: list[str], brackets: list[tuple[int, float, float]]) -> DataFrame:
    """(bracket, value, _n): counted values inside each bracket; a null value counts those below."""
    spark = df.sparkSession
    table = spark.createDataFrame(
        [(b, k, lo, hi) for b, (k, lo, hi) in enumerate(brackets)],
        "bracket int, k int, lo double, hi double",
    )
    # The brackets are a few rows per column, whatever the data holds.
    cells = _long_values(df, cols).join(F.broadcast(table), "k").filter(F.col("v") <= F.col("hi"))
    value = F.when(F.col("v") >= F.col("lo"), F.col("v")).alias("value")
    return stage(cells.groupBy("bracket", value).agg(F.count(F.lit(1)).alias("_n")), "brackets")


def quantiles(
    df: DataFrame,
    cols: list[str],
    probs: list[float],
    rule: str = "nearest",
    *,
    accuracy: int = ACCURACY,
    small_rows: int = 4 * ACCURACY,
    summaries: dict[int, Row] | None = None,
) -> DataFrame:
    """Exact quantiles of many columns: (column_name, prob, value).

    One pass sketches a bracket around every wanted rank. A second pass counts the
    rows below each bracket and groups the values inside it; a rank that falls
    outside its bracket is looked up again in the full range. A distributed
    running total then picks the exact rank. Columns with at most ``small_rows``
    values use their full range at once. ``rule`` is ``nearest`` (half up) or
    ``linear``.
    """
    spark = df.sparkSession
    sides = _sides(probs, accuracy)
    stats = _summaries(df, cols, sides, accuracy) if summaries is None else summaries
    margin = 2.0 / accuracy
    full = {k: (r["lo"], r["hi"]) for k, r in stats.items() if r["n"]}

    def bracket(k: int, prob: float) -> tuple[int, float, float]:
        lo, hi = full[k]
        if stats[k]["n"] > small_rows:
            at = dict(zip(sides, stats[k]["q"]))
            lo = at[prob - margin] if prob - margin > 0.0 else lo
            hi = at[prob + margin] if prob + margin < 1.0 else hi
        return k, lo, hi

    def ranks(k: int, prob: float) -> list[tuple[int, float]]:
        where = (stats[k]["n"] - 1) * prob
        if rule == "nearest":
            return [(math.floor(where + 0.5), 1.0)]
        share = where - math.floor(where)
        return [(math.floor(where), 1.0 - share), (math.ceil(where), share)]

    found = []
    open_items = {(k, prob): bracket(k, prob) for k in full for prob in probs}
    while open_items:
        brackets = sorted(set(open_items.values()))
        sizes = _bracketed(df, cols, brackets)
        inside = F.col("value").isNotNull()
        held = {
            r["bracket"]: (r["below"] or 0, r["inside"] or 0)
            for r in sizes.groupBy("bracket")
            .agg(
                F.sum(F.when(~inside, F.col("_n"))).alias("below"),
                F.sum(F.when(inside, F.col("_n"))).alias("inside"),
            )
            .collect()
        }
        targets, missed = [], {}
        for (k, prob), key in open_items.items():
            b = brackets.index(key)
            below, count = held.get(b, (0, 0))
            if all(below <= rank < below + count for rank, _ in ranks(k, prob)):
                targets += [(cols[k], b, prob, rank - below, w) for rank, w in ranks(k, prob)]
            else:
                missed[k, prob] = (k, *full[k])
        if targets:
            schema = "column_name string, bracket int, prob double, at bigint, weight double"
            totals = running_totals(sizes.filter(inside), ["value"], "_n", "_upto", by=["bracket"])
            hit = (F.col("at") < F.col("_upto")) & (F.col("at") >= F.col("_upto") - F.col("_n"))
            picked = totals.join(F.broadcast(spark.createDataFrame(targets, schema)), "bracket")
            found.append(picked.filter(hit).select("column_name", "prob", "value", "weight"))
        open_items = missed
    if not found:
        return spark.createDataFrame([], "column_name string, prob double, value double")
    return reduce(DataFrame.unionByName, found).groupBy("column_name", "prob").agg(
        F.sum(F.col("value") * F.col("weight")).alias("value")
    )


def describe(
    df: DataFrame, cols: list[str], rule: str = "nearest", approximate: bool = False
) -> DataFrame:
    """Count, nulls, mean, sample deviation, min, quartiles and max per column.

    NaN counts as missing. Quartiles are exact order statistics unless
    ``approximate`` asks for the sketch.
    """
    probs = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    sketch = list(probs.values()) if approximate else _sides(list(probs.values()), ACCURACY)
    stats = _summaries(df, cols, sketch, ACCURACY)
    fields = ["n", "nulls", "mean", "std", "lo", "hi"]
    rows = []
    for k, c in enumerate(cols):
        r = stats.get(k)
        values = [r[f] for f in fields] if r else [0, 0, None, None, None, None]
        rough = list(r["q"]) if approximate and r and r["q"] else [None] * 3
        rows.append((c, *values, *(rough if approximate else [])))
    schema = (
        "column_name string, count bigint, null_count bigint, mean double, std double, "
        "min double, max double"
    )
    if approximate:
        schema += "".join(f", {q} double" for q in probs)
        return df.sparkSession.createDataFrame(rows, schema)
    basic = df.sparkSession.createDataFrame(rows, schema)
    at = quantiles(df, cols, list(probs.values()), rule, summaries=stats)
    wide = at.groupBy("column_name").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(q) for q, p in probs.items()]
    )
    return basic.join(wide, "column_name", "left")


def _finite(c: str) -> Column:
    value = _number(c)
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def histogram(df: DataFrame, cols: list[str], bins: int = 20) -> DataFrame:
    """Equal-width counts per column, including empty bins.

    (column_name, bin, lower, upper, n). The last bin includes the maximum; a
    constant column gets a unit-wide range around its value. Infinite values have no
    bin and do not stretch the range.
    """
    ends = df.agg(
        *[f(_finite(c)).alias(f"{c}{s}") for c in cols for f, s in ((F.min, "__lo"), (F.max, "__hi"))]
    )
    flat = F.col("raw_lo") == F.col("raw_hi")
    edges = stage(
        _long(ends, cols, {"raw_lo": "__lo", "raw_hi": "__hi"})
        .filter(F.col("raw_lo").isNotNull())
        .select(
            "column_name",
            F.when(flat, F.col("raw_lo") - 0.5).otherwise(F.col("raw_lo")).alias("lo"),
            F.when(flat, F.col("raw_hi") + 0.5).otherwise(F.col("raw_hi")).alias("hi"),
        ),
        "edges",  # one row per column, used by the count and by the grid
    )
    values = F.array(*[F.struct(F.lit(c).alias("column_name"), _finite(c).alias("v")) for c in cols])
    width = (F.col("hi") - F.col("lo")) / F.lit(bins)
    counted = (
        df.select(F.explode(values).alias("_e"))
        .select("_e.*")
        .filter(F.col("v").isNotNull())
        .join(F.broadcast(edges), "column_name")
        .withColumn("bin", F.least(F.floor((F.col("v") - F.col("lo")) / width), F.lit(bins - 1)))
        .groupBy("column_name", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    grid = edges.select(
        "column_name", "lo", width.alias("_w"), F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    )
    return grid.join(counted, ["column_name", "bin"], "left").select(
        "column_name",
        "bin",
        (F.col("lo") + F.col("bin") * F.col("_w")).alias("lower"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("_w")).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


_PAIR_SUMS = "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"

# A variance below this share of the raw second moment is rounding noise.
_FLAT = 1e-10


def _pair_sums(centers: list[float]):
    """Task function: sums of products of all column pairs of its rows.

    Matrix products over Arrow batches; each task returns one row per column pair,
    whatever the number of rows it read.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = len(centers)
        count, first, square, cross = (np.zeros((size, size)) for _ in range(4))
        for batch in batches:
            x = batch.to_numpy(dtype="float64") - np.asarray(centers)
            present = (~np.isnan(x)).astype("float64")
            x = np.nan_to_num(x, nan=0.0)
            count += present.T @ present
            first += x.T @ present
            square += (x * x).T @ present
            cross += x.T @ x
        i, j = np.triu_indices(size)
        yield pd.DataFrame(
            {
                "i": i.astype("int32"), "j": j.astype("int32"), "n": count[i, j],
                "sx": first[i, j], "sy": first[j, i], "sxx": square[i, j], "syy": square[j, i],
                "sxy": cross[i, j],
            }
        )

    return run


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every ordered column pair over complete pairs.

    Null where a column is constant. Values are centred on the column means first,
    so the sums stay accurate. One aggregate per pair would be interpreted: at 27
    columns that is 378 aggregates per row.
    """
    numbers = df.select(*[_number(c).alias(c) for c in cols])
    means = numbers.agg(*[F.avg(c) for c in cols]).first()
    centers = [0.0 if m is None else float(m) for m in means]
    sums = numbers.mapInPandas(_pair_sums(centers), _PAIR_SUMS).groupBy("i", "j").agg(
        *[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")]
    )

    def spread(raw: str, total: str) -> Column:
        value = F.col(raw) - F.try_divide(F.col(total) * F.col(total), F.col("n"))
        return F.when(value > F.col(raw) * F.lit(_FLAT), value)

    shared = F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), F.col("n"))
    corr = shared / F.sqrt(spread("sxx", "sx") * spread("syy", "sy"))
    names = F.array(*[F.lit(c) for c in cols])
    upper = sums.select(names[F.col("i")].alias("x"), names[F.col("j")].alias("y"), corr.alias("corr"))
    ordered = F.array_distinct(F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y"))))
    return upper.select(F.explode(ordered).alias("_e"), "corr").select(
        F.col("_e.x").alias("column_x"), F.col("_e.y").alias("column_y"), "corr"
    )
