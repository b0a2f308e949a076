"""Exact similarity join of documents on word n-grams by grouped prefixes.

A document's set holds the hashes of its distinct word n-grams, ordered by one order
for all documents: rare ones first. Two sets of the wanted Jaccard similarity share an
element among the first ``n - ceil(t n) + 1`` of each, their prefixes. Documents with
equal prefixes and equal size form one group, which meets other groups as one; a pair
of groups must also pass the bound that its common prefix elements and what is left
behind the prefixes allow. Pairs that pass are expanded to their members and confirmed
on full sets. No step is a sample or an estimate: the order only decides how few
candidates there are.

Scale: equal sets collapse first. Frequencies are counted over all documents, in
``BUCKETS`` buckets of hashes, which is all that reaches the driver and the tasks. An
element that only one group has in its prefix is dropped by a pre-aggregated count,
which leaves a few per cent of all prefix elements. An element's groups are not expanded
into pairs: each meets the one that shares most, links of such stars merge into
components, and only groups that are still in different components meet each other, each
pair once, in its first common element. Sizes and places are compared before prefixes
are attached to a pair. That last step compares for the square of the groups that hold
one element and are not linked. Nothing goes through the driver.

Defined cases: null or empty texts, and texts without words, have an empty set and are
linked with nothing; fewer words than a shingle make one shingle of the whole text;
rows with the same id count as one document, linked when any of its texts is; a row
with a null id is linked with nothing and has a null component; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helioframe.llm.batches import Words, mix, signed, slices, texts_of, windows
from helioframe.llm.components import components
from helioframe.llm.tensor_minhash import shingle_sets
from helioframe.llm.vectors import as_lists, blocks, sum_blocks
from helioframe.session import broadcast_if_small, discard, stage

SHINGLE = 5
BUCKETS = 1 << 18
_U = np.uint64
_PREFIXES = "id bigint, n bigint, h1 bigint, h2 bigint, g1 bigint, g2 bigint, last bigint, prefix array<bigint>"


# --- the order of elements


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (hashes >> _U(64 - (buckets.bit_length() - 1))).astype(np.int64)


def _bucket_counts(k: int, buckets: int):
    """Arrow map to a task's number of shingles in every bucket, in blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in slices(batches, "text"):
            words = Words(*texts_of(batch.column("text")))
            found = windows(words.hashes(), k)
            inside = words.doc[: len(found)] == words.doc[k - 1 :] if len(found) else np.zeros(0, bool)
            total += np.bincount(_bucket(found[inside], buckets), minlength=buckets)
        parts = blocks(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(parts)), pa.int32()), as_lists(parts, pa.int64())], names=["block", "part"])

    return run


def levels(texts: DataFrame, k: int, buckets: int = BUCKETS) -> np.ndarray:
    """Frequency class (0 to 127, four to a doubling) of every bucket over all texts."""
    parts = sum_blocks(texts.select("text").mapInArrow(_bucket_counts(k, buckets), "block int, part array<bigint>"), ["block"])
    counts = np.zeros((-(-buckets // 64), 64), np.int64)
    for r in parts.collect():
        counts[r.block] = r.part
    return np.minimum(4 * np.log2(1.0 + counts.ravel()[:buckets]), 127).astype(np.uint8)


def prefix_size(n: np.ndarray | Column, percent: int) -> np.ndarray | Column:
    """Elements of a set of size n of which one at least is shared with every similar set."""
    if isinstance(n, Column):
        return n - F.floor((n * percent + 99) / 100) + 1
    return n - (n * percent + 99) // 100 + 1


def _prefixes(k: int, percent: int, level: np.ndarray):
    """Arrow map to size, digest, prefix digest, last prefix element and prefix of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets, at = shingle_sets(*texts_of(batch.column("text")), k)
            size = np.diff(at)
            full = np.flatnonzero(size)
            digest = np.zeros((4, len(size)), np.uint64)
            code = (level[_bucket(sets, len(level))].astype(np.uint64) << _U(56)) | (sets >> _U(8))
            doc = np.repeat(np.arange(len(size)), size)
            code = code[np.lexsort((code, doc))]
            first = np.where(size > 0, prefix_size(size, percent), 0)
            front = code[np.arange(len(code)) - at[doc] < first[doc]]
            ends = np.concatenate([[0], np.cumsum(first)])
            last = np.zeros(len(size), np.uint64)
            if len(full):
                digest[0, full] = np.add.reduceat(mix(sets), at[full])
                digest[1, full] = np.bitwise_xor.reduceat(mix(sets + _U(0x1234567)), at[full])
                digest[2, full] = np.add.reduceat(mix(front + _U(0x55)), ends[full])
                digest[3, full] = np.bitwise_xor.reduceat(mix(front + _U(0x7654321)), ends[full])
                last[full] = front[ends[full + 1] - 1]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), pa.array(size, pa.int64()), *[pa.array(signed(d)) for d in digest], pa.array(signed(last)),
                    pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(signed(front))),
                ],
                names=["id", "n", "h1", "h2", "g1", "g2", "last", "prefix"],
            )

    return run


# --- candidates


def _bound(x: str, y: str, percent: int) -> Column:
    """Whether two groups can hold similar members.

    Elements up to the smaller of the two last prefix elements are in both prefixes if
    they are common at all; behind it, the set with that last element has no more than
    ``size - prefix`` left. Either may be that set where a last element is not known.
    """
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    behind, past = n - prefix_size(n, percent), m - prefix_size(m, percent)
    before = F.col(f"{x}.last") <= F.col(f"{y}.last")
    left = F.when(before, behind).when(~before, past).otherwise(F.greatest(behind, past))
    common = F.size(F.array_intersect(f"{x}.list", f"{y}.list"))
    fits = F.least(n, m) * 100 >= F.greatest(n, m) * percent
    return fits & ((common + left) * (100 + percent) >= (n + m) * percent)


def _near(x: str, y: str, percent: int) -> Column:
    """Whether an element at places i and j of two sets, from 0, can be the first common one of similar sets.

    Then all common elements are among the last n - i and m - j. Every similar pair has a
    first common element, so looking at no others loses nothing.
    """
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    most = F.least(n - F.col(f"{x}.pos"), m - F.col(f"{y}.pos"))
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (most * (100 + percent) >= (n + m) * percent)


def _pair(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _with_centres(rows: DataFrame) -> DataFrame:
    """Every element's groups beside its centre, the group whose elements most groups share.

    In a family of edited copies that is the text they were made from, or the one
    nearest to it.
    """
    centre = rows.groupBy("token").agg(F.max(F.struct("shared", "id", "n", "pos")).alias("centre"))
    return rows.drop("shared").join(centre, "token")


def _stars(starred: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs of every group with the centre of each of its elements, as their first common one, that pass the bound."""
    meet = starred.select(F.struct("n", "pos").alias("x"), "centre", "id").where((F.col("id") != F.col("centre.id")) & _near("x", "centre", percent))
    pairs = meet.select(*_pair(F.col("id"), F.col("centre.id"))).distinct()
    lists = nodes.select("id", "n", "last", "list")
    near = pairs.join(lists.alias("x"), F.col("a") == F.col("x.id")).join(lists.alias("y"), F.col("b") == F.col("y.id"))
    return near.where(_bound("x", "y", percent)).select("a", "b").distinct()


def _across(starred: DataFrame, nodes: DataFrame, spread: DataFrame, percent: int) -> DataFrame:
    """Pairs of groups, not all of one component, that pass the bound; each in its first common element.

    ``spread`` holds the least and the greatest component among the members of a group
    and whether it has several. In their first common element, pairs with its centre were
    tested, unless one of them has several members. Rows without a possible partner leave before prefixes are attached.
    """
    held = starred.select("token", "id", "n", "pos", (F.col("id") == F.col("centre.id")).alias("central")).join(spread, "id")
    mixed = held.groupBy("token").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count("*").alias("k"), F.max("many").alias("many"))
    mixed = mixed.where("lo < hi AND (k > 2 OR many)").select("token")
    held = stage(held.join(mixed, "token"), "mixed")
    joined = (F.col("x.lo") == F.col("x.hi")) & (F.col("x.hi") == F.col("y.lo")) & (F.col("y.lo") == F.col("y.hi"))
    known = (F.col("x.central") | F.col("y.central")) & ~F.col("x.many") & ~F.col("y.many")
    meet = (F.col("x.token") == F.col("y.token")) & ~joined & ~known & _near("x", "y", percent)
    able = held.alias("x").join(held.alias("y"), meet & (F.col("x.id") != F.col("y.id")), "left_semi")
    lists = nodes.select("id", "n", "last", "list")
    wide = stage(able.join(lists, ["id", "n"]), "apart")
    first = F.array_min(F.array_intersect("x.list", "y.list")) == F.col("x.token")
    first = first | F.col("x.last").isNull() | F.col("y.last").isNull()
    pairs = wide.alias("x").join(wide.alias("y"), meet & (F.col("x.id") < F.col("y.id")) & _bound("x", "y", percent) & first)
    pairs = stage(pairs.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct(), "across")
    discard(held, wide)
    return pairs


# --- full sets


def _full_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets, at = shingle_sets(*texts_of(batch.column("text")), k)
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(signed(sets)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), lists], names=["id", "shingles"])

    return run


def _confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs whose full sets are as similar as asked, as a staged table."""
    ids = stage(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids")
    sets = stage(texts.join(broadcast_if_small(ids), "id", "left_semi").mapInArrow(_full_sets(k), "id bigint, shingles array<bigint>"), "sets")
    both = pairs.join(sets.toDF("b", "right"), "b").join(sets.toDF("a", "left"), "a")
    shared = F.size(F.array_intersect("left", "right"))
    near = both.where(shared * 100 >= (F.size("left") + F.size("right") - shared) * percent)
    links = stage(near.select("a", "b").distinct(), "links")
    discard(ids, sets)
    return links


# --- the operator


def similar_documents(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = 80, buckets: int = BUCKETS,
) -> DataFrame:
    """``id``, ``n_shingles`` and ``component_id`` (smallest id reachable), one row per row of ``docs``."""
    texts = docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))
    order = levels(texts, shingle, buckets)
    prefixes = stage(texts.mapInArrow(_prefixes(shingle, percent, order), _PREFIXES), "prefixes")
    rows = stage(prefixes.select("id", "n", "h1", "h2"), "rows")
    full = prefixes.where("n > 0 AND id IS NOT NULL")

    # Equal sets, then equal prefixes and sizes: the smallest id stands for them.
    classes = stage(full.groupBy("h1", "h2", "n", "g1", "g2").agg(F.min("id").alias("id")), "classes")
    groups = classes.groupBy("n", "g1", "g2").agg(F.min("id").alias("lead"), F.count("*").alias("k"))
    named = stage(classes.join(groups, ["n", "g1", "g2"]), "groups")
    members = named.where("k > 1").select("lead", "id").distinct()
    leads = named.where("id = lead").select("id", "h1", "h2")
    others = full.select("id", "h1", "h2").distinct().join(leads, ["id", "h1", "h2"], "left_anti")

    held = full.join(broadcast_if_small(stage(others, "others")), ["id", "h1", "h2"], "left_anti")
    tokens = held.select("id", "n", F.posexplode("prefix").alias("pos", "token"))
    # Written apart, so that the shuffle of the count is gone when that of the elements is made.
    several = stage(tokens.groupBy("token").agg(F.count("*").alias("k")).where("k > 1"), "several")
    nodes = tokens.join(several, "token").groupBy("id", "n").agg(
        F.collect_list(F.struct("token", "pos")).alias("at"), F.sum("k").alias("shared")
    )
    # Several texts of one id and one size are one node, whose last element is not known.
    lasts = held.groupBy("id", "n").agg(F.when(F.min("last") == F.max("last"), F.min("last")).alias("last"))
    nodes = nodes.join(lasts, ["id", "n"])
    nodes = stage(nodes.withColumn("list", F.col("at.token")), "nodes")
    starred = stage(_with_centres(nodes.select("id", "n", "shared", F.inline("at"))), "tokens")
    discard(prefixes, several)  # the rest reads ``rows``

    inside = members.where("id <> lead").select(*_pair(F.col("id"), F.col("lead")))
    tested = stage(_stars(starred, nodes, percent).union(inside).distinct(), "stars")
    links = _confirmed(tested, texts, shingle, percent)

    labels = components(links).toDF("id", "c")
    everyone = members.union(nodes.select("id", "id")).distinct().toDF("lead", "id")
    everyone = stage(everyone.join(labels, "id", "left").select("lead", "id", F.coalesce("c", "id").alias("c")), "members")
    spread = everyone.groupBy("lead").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), (F.count("*") > 1).alias("many"))
    across = _across(starred, nodes, spread.withColumnRenamed("lead", "id"), percent)
    discard(starred, nodes)
    one, two = everyone.toDF("a", "one", "c1"), everyone.toDF("b", "two", "c2")
    expanded = across.join(one, "a").join(two, "b").where("c1 <> c2").select(*_pair(F.col("one"), F.col("two")))
    alike = everyone.toDF("lead", "one", "c1").join(everyone.toDF("lead", "two", "c2"), "lead").where("c1 < c2")
    expanded = expanded.union(alike.select(*_pair(F.col("one"), F.col("two")))).distinct()
    rest = stage(expanded.join(tested, ["a", "b"], "left_anti"), "rest")
    links = links.union(_confirmed(rest, texts, shingle, percent)).union(_of_one_id(rows.where("n > 0 AND id IS NOT NULL"), classes))
    final = components(stage(links.distinct(), "links")).toDF("id", "c")

    known = classes.join(final, "id", "left").select("h1", "h2", "n", F.coalesce("c", "id").alias("c"))
    out = rows.join(known, ["h1", "h2", "n"], "left")
    return out.select(
        "id", F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("c", "id")).alias("component_id")
    )


def _of_one_id(full: DataFrame, classes: DataFrame) -> DataFrame:
    """Links of each id that has several texts to the ids that stand for all of them."""
    texts = full.select("id", "h1", "h2", "n").distinct()
    several = texts.groupBy("id").agg(F.count("*").alias("k")).where("k > 1").select("id")
    named = classes.select("h1", "h2", "n", F.col("id").alias("rep"))
    linked = texts.join(several, "id").join(named, ["h1", "h2", "n"]).where("id <> rep")
    return linked.select(*_pair(F.col("id"), F.col("rep"))).distinct()
