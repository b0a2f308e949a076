"""Reproducible splits and samples.

Rows or groups are put in the order of an MD5 of seed and key. The wanted share
is a prefix of that order, so it is applied as a comparison with one hash value:
no wide row is sorted, shuffled or joined.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Hex digits per search level: a histogram has at most 16**3 = 4096 buckets.
_DIGITS = 3
_BUCKETS = 16**_DIGITS


def key_hash(seed: int, *keys: str, nulls: bool = False) -> Column:
    """MD5 of seed and keys; null when any key is null, unless ``nulls`` are values too."""
    parts = [F.lit(str(seed))]
    for key in keys:
        part = F.concat(F.lit("|"), F.col(key).cast("string"))
        parts.append(F.coalesce(part, F.lit("!")) if nulls else part)
    return F.md5(F.concat(*parts))


def _walk(counts: DataFrame, k: int | None, size: Callable[[int], int]) -> tuple[str, int, int] | None:
    """Bucket of the k-th value: (bucket, rank inside it, rows in it); None without a k-th value."""
    rows = sorted((r["b"], r["n"]) for r in counts.collect())  # at most _BUCKETS rows
    if k is None:
        k = size(sum(n for _, n in rows))
        if not rows or k < 1:
            return None
    for bucket, n in rows:
        if k <= n:
            return bucket, k, n
        k -= n
    raise ValueError("fewer values than the wanted rank")


def nth_hash(hashes: DataFrame, size: Callable[[int], int]) -> str | None:
    """The k-th smallest value of column ``_h``, where k = size(number of values).

    None without values or when k is less than 1.

    Exact. Each level is one narrow pass that counts values by the next three hex
    digits, which combines to at most 4096 rows per task before the shuffle, and
    descends into the bucket of the k-th value. MD5 spreads distinct keys evenly,
    so 10**11 keys need three levels. The last level lists the few values left.
    """
    hashes = hashes.filter(F.col("_h").isNotNull())
    prefix, k, left = "", None, None
    while len(prefix) < 30 and (left is None or left > _BUCKETS):
        inside = hashes.filter(F.col("_h").startswith(prefix)) if prefix else hashes
        digits = F.substring("_h", len(prefix) + 1, _DIGITS).alias("b")
        counts = inside.groupBy(digits).agg(F.count(F.lit(1)).alias("n"))
        found = _walk(counts, k, size)
        if found is None:
            return None
        digit, k, left = found
        prefix += digit
    rest = hashes.filter(F.col("_h").startswith(prefix)).groupBy(F.col("_h").alias("b"))
    return _walk(rest.agg(F.count(F.lit(1)).alias("n")), k, size)[0]


def _mark(df: DataFrame, label: str, inside: Column, yes: str, no: str) -> DataFrame:
    return df.withColumn(label, F.when(inside, F.lit(yes)).when(~inside, F.lit(no)))


def held_out_groups(n: int, ratio: float) -> int:
    """round-half-even(n * ratio), at least 1 and at most all but one."""
    if n < 2:
        raise ValueError("need at least two groups to split")
    return max(1, min(round(n * ratio), n - 1))


def label_groups(
    df: DataFrame,
    group: str,
    ratio: float,
    seed: int,
    label: str = "split",
    ids: DataFrame | None = None,
) -> DataFrame:
    """Mark rows ``val`` or ``train`` so that every group is on one side.

    Null groups get a null label. Fewer than two groups is an error. ``ids`` may
    hold the distinct groups if the caller already has them.
    """
    ids = df.select(group).distinct() if ids is None else ids
    hashes = ids.select(key_hash(seed, group).alias("_h"))
    cut = nth_hash(hashes, lambda n: held_out_groups(n, ratio))
    return _mark(df, label, key_hash(seed, group) <= F.lit(cut), "val", "train")


def split_by_group(
    df: DataFrame, group: str, ratio: float, seed: int
) -> tuple[DataFrame, DataFrame]:
    """(train, validation) with disjoint groups."""
    marked = label_groups(df, group, ratio, seed, "_split")
    train = marked.filter(F.col("_split") == "train").drop("_split")
    val = marked.filter(F.col("_split") == "val").drop("_split")
    return train, val


def _first(hashes: DataFrame, own: Column, size: Callable[[int], int]) -> Column:
    """Whether a row is among the first size(n) of ``hashes``."""
    cut = nth_hash(hashes, size)
    return F.lit(False) if cut is None else own <= F.lit(cut)


def label_rows(
    df: DataFrame, keys: list[str], ratio: float, seed: int, exact: bool = True,
    label: str = "split",
) -> DataFrame:
    """Mark int(n * ratio) rows ``train`` and the rest ``valid`` in hash order.

    ``keys`` should identify a row; rows with equal keys go to one side together. A
    null key is a value like any other. ``exact=False`` compares with a fixed threshold
    instead and reads the data once; the share is then only expected.
    """
    own = key_hash(seed, *keys, nulls=True)
    if exact:
        inside = _first(df.select(own.alias("_h")), own, lambda n: int(n * ratio))
    else:
        inside = F.substring(own, 1, 8) < F.lit(f"{min(int(ratio * 2**32), 2**32 - 1):08x}")
    return _mark(df, label, inside, "train", "valid")


def subsample(
    df: DataFrame, keys: list[str], fraction: float, seed: int, exact: bool = True
) -> DataFrame:
    """max(1, int(n * fraction)) rows without replacement; all rows unless 0 < fraction < 1.

    Keys as in ``label_rows``.
    """
    if not 0.0 < fraction < 1.0:
        return df
    own = key_hash(seed, *keys, nulls=True)
    if not exact:
        return df.filter(F.substring(own, 1, 8) < F.lit(f"{int(fraction * 2**32):08x}"))
    hashes = df.select(own.alias("_h"))
    return df.filter(_first(hashes, own, lambda n: max(1, int(n * fraction))))
