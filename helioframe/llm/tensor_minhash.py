"""Near-duplicate documents by MinHash with tensored banding.

A document's set holds the hashes of its distinct word shingles. Two collections of
``SIDE`` short keys, each of ``HALF`` minhashes, are computed; a table key joins one key
of the left collection with one of the right, so ``SIDE ** 2`` tables cost only
``2 * SIDE * HALF`` minhashes. Candidates of all tables are confirmed on full sets.

A pair of similarity J shares a table unless all left or all right keys differ:
``1 - (1 - (1 - J ** HALF) ** SIDE) ** 2``, about 1e-5 at J = 0.8 with the defaults.

Scale: documents with equal sets collapse to their smallest id first, so thousands of
copies are one row. A key that only one set has on its side cannot lie in a shared
table; those are dropped by a pre-aggregated count before tables are formed, which
leaves nothing of most unique documents. Tables are not expanded into pairs: each is
linked as a star around its most shared member, and components merge; only members of
one table that are still in different components are then compared with each other,
behind an exact bound from sketches of the sets, which completes the search. That last
step compares sketches for the square of a family's members that are not yet linked.
Nothing goes through the driver.

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
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.llm.batches import Words, mix, signed, slices, texts_of, windows
from helioframe.llm.components import components
from helioframe.session import stage

SHINGLE = 5
SIDE, HALF = 12, 2
SKETCH = 32  # longs of a parity sketch
_SETS = "id bigint, shingles array<bigint>, bits array<bigint>"
_U = np.uint64


def shingle_sets(data: np.ndarray, places: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and the n + 1 places between texts."""
    words = Words(data, places)
    hashes = words.hashes()
    found = windows(hashes, k)
    doc = words.doc[: len(found)]
    inside = doc == words.doc[k - 1 :] if len(found) else np.zeros(0, bool)
    found, doc = found[inside], doc[inside]
    short = np.flatnonzero((words.count > 0) & (words.count < k))
    if len(short):
        whole = []
        for i in short:
            part = hashes[words.first[i] : words.first[i + 1]]
            whole.append(windows(np.concatenate([part, np.full(k - len(part), 0x5BD1E995 + len(part), np.uint64)]), k)[0])
        found, doc = np.concatenate([found, np.array(whole, np.uint64)]), np.concatenate([doc, short])
    order = np.lexsort((found, doc))
    found, doc = found[order], doc[order]
    keep = np.ones(len(found), bool)
    keep[1:] = (found[1:] != found[:-1]) | (doc[1:] != doc[:-1])
    found, doc = found[keep], doc[keep]
    return found, np.searchsorted(doc, np.arange(len(places)))


def sketch(sets: np.ndarray, at: np.ndarray, side: int, half: int) -> np.ndarray:
    """Keys of both collections, one row of ``2 * side`` for each non-empty set."""
    full = np.flatnonzero(np.diff(at))
    out = np.empty((len(full), 2 * side), np.uint64)
    for key in range(2 * side):
        value = np.full(len(full), key + 1, np.uint64)
        for part in range(half):
            salt = mix(np.array([key * half + part + 1], np.uint64))[0]
            least = np.minimum.reduceat((sets ^ salt) * _U(0x9FB21C651E98DF25) ^ ((sets ^ salt) >> _U(29)) * salt, at[full])
            value = mix(value * _U(0xD6E8FEB86659FD93) + least)
        out[:, key] = value
    return out


def _sketches(k: int, side: int, half: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets, at = shingle_sets(*texts_of(batch.column("text")), k)
            size = np.diff(at)
            full = np.flatnonzero(size)
            digest = np.zeros((2, len(size)), np.uint64)
            if len(full):
                digest[0, full] = np.add.reduceat(mix(sets), at[full])
                digest[1, full] = np.bitwise_xor.reduceat(mix(sets + _U(0x1234567)), at[full])
            keys = sketch(sets, at, side, half) if len(full) else np.zeros((0, 2 * side), np.uint64)
            ends = np.concatenate([[0], np.cumsum(np.where(size > 0, 2 * side, 0))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), pa.array(size, pa.int64()), pa.array(signed(digest[0])), pa.array(signed(digest[1])),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(keys.ravel()))),
                ],
                names=["id", "n", "h1", "h2", "keys"],
            )

    return run


def _full_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets, at = shingle_sets(*texts_of(batch.column("text")), k)
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(signed(sets)))
            doc = np.repeat(np.arange(batch.num_rows), np.diff(at))
            odd = np.zeros((batch.num_rows, 64 * SKETCH), np.uint8)
            np.bitwise_xor.at(odd, (doc, (mix(sets) % _U(64 * SKETCH)).astype(np.int64)), 1)
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * SKETCH
            bits = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.packbits(odd, axis=1).view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), lists, bits], names=["id", "shingles", "bits"])

    return run


def _star(rows: DataFrame, percent: int) -> DataFrame:
    """Links of every table's members to its centre, where the sizes allow a match.

    The centre is the member whose keys most documents share: in a family of edited
    copies that is the text they were made from, or the one nearest to it.
    """
    centre = rows.groupBy("key").agg(F.max(F.struct("shared", "id", "n")).alias("m")).select("key", "m.id", "m.n")
    pairs = rows.join(centre.toDF("key", "id2", "n2"), "key")
    return _pairs(pairs.where(F.least("n", "n2") * 100 >= F.greatest("n", "n2") * percent))


def _pairs(pairs: DataFrame) -> DataFrame:
    return pairs.where("id <> id2").select(F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b")).distinct()


def _across(apart: DataFrame, classes: DataFrame, sets: DataFrame, percent: int, side: int) -> DataFrame:
    """Pairs of different components that can still reach the similarity.

    They meet in the left keys alone, 12 rows for each document instead of up to 144.
    Bits that differ in two parity sketches are never more than the elements in which
    the sets differ, so the bound below loses no pair; it drops most edited copies of a
    common text before any row is made of them.
    """
    bits = [f"b{i}" for i in range(SKETCH)]
    able = apart.select("id", "n", "c").distinct().join(sets.select("id", "bits"), "id")
    able = able.select("id", "n", "c", *[F.col("bits")[i].alias(b) for i, b in enumerate(bits)])
    keys = classes.select("id", F.explode(F.slice("keys", 1, side)).alias("key"))
    able = stage(able.join(keys, "id"), "able")
    left, right = able.alias("x"), able.alias("y")
    x, y = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    differ = sum((F.bit_count(x(b).bitwiseXOR(y(b))) for b in bits[1:]), F.bit_count(x("b0").bitwiseXOR(y("b0"))))
    fits = F.least(x("n"), y("n")) * 100 >= F.greatest(x("n"), y("n")) * percent
    near = differ * (100 + percent) <= (x("n") + y("n")) * (100 - percent)
    pairs = left.join(right, (x("key") == y("key")) & (x("c") < y("c")) & fits & near)
    return _pairs(pairs.select(x("id").alias("id"), y("id").alias("id2")))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    sets = sets.select("id", "shingles")
    both = pairs.join(sets.toDF("b", "right"), "b").join(sets.toDF("a", "left"), "a")
    shared = F.size(F.array_intersect("left", "right"))
    return both.where(shared * 100 >= (F.size("left") + F.size("right") - shared) * percent).select("a", "b")


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = 80,
    side: int = SIDE, half: int = HALF,
) -> DataFrame:
    """``id``, ``n_shingles`` and ``component_id`` (smallest id reachable), one row per row of ``docs``."""
    texts = docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))
    schema = "id bigint, n bigint, h1 bigint, h2 bigint, keys array<bigint>"
    signed_rows = stage(texts.mapInArrow(_sketches(shingle, side, half), schema), "sketches")
    full = signed_rows.where("n > 0 AND id IS NOT NULL")
    # All documents of one set: the smallest id stands for them.
    classes = full.groupBy("h1", "h2", "n").agg(F.min(F.struct("id", "keys")).alias("m"))
    classes = stage(classes.select("h1", "h2", "n", "m.id", "m.keys"), "classes")

    halves = classes.select("id", "n", F.posexplode("keys").alias("place", "half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("k")).where("k > 1")
    halves = halves.join(shared, "half").groupBy("id", "n").agg(
        F.collect_list(F.struct("place", "half")).alias("s"), F.sum("k").alias("shared")
    )
    tables = halves.select(
        "id", "n", "shared",
        F.explode(F.filter("s", lambda x: x.place < side)).alias("l"),
        F.filter("s", lambda x: x.place >= side).alias("right"),
    ).select("id", "n", "shared", "l", F.explode("right").alias("r"))
    rows = stage(tables.select(F.xxhash64("l.half", "r.half").alias("key"), "id", "n", "shared"), "tables")
    several = rows.groupBy("key").agg(F.count("*").alias("k")).where("k > 1").select("key")
    rows = stage(rows.join(several, "key"), "tables")
    nodes = rows.select("id").distinct()
    sets = stage(
        texts.join(nodes, "id", "left_semi").mapInArrow(_full_sets(shingle), _SETS), "sets"
    )
    links = stage(_confirmed(_star(rows, percent), sets, percent), "links")
    labels = components(links)
    across = _across(_apart(rows, labels), classes, sets, percent, side)
    links = links.union(_confirmed(across, sets, percent)).union(_of_one_id(full, classes))
    links = stage(links.distinct(), "links")
    labels = components(links)

    known = classes.select("h1", "h2", "n", F.col("id").alias("rep")).join(
        labels.select(F.col("v").alias("rep"), "c"), "rep", "left"
    ).select("h1", "h2", "n", F.coalesce("c", "rep").alias("c"))
    out = signed_rows.select("id", "n", "h1", "h2").join(known, ["h1", "h2", "n"], "left")
    return out.select(
        "id", F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("c", "id")).alias("component_id"),
    )


def _of_one_id(full: DataFrame, classes: DataFrame) -> DataFrame:
    """Links of each id that has several texts to the representatives of all of them."""
    texts = full.select("id", "h1", "h2", "n").distinct()
    several = texts.groupBy("id").agg(F.count("*").alias("k")).where("k > 1").select("id")
    named = classes.select("h1", "h2", "n", F.col("id").alias("rep"))
    linked = texts.join(several, "id").join(named, ["h1", "h2", "n"]).where("id <> rep")
    return linked.select(F.least("id", "rep").alias("a"), F.greatest("id", "rep").alias("b")).distinct()


def _apart(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Members, with components, of the tables that still hold several components."""
    labelled = rows.join(labels.toDF("id", "c"), "id", "left").withColumn("c", F.coalesce("c", "id"))
    mixed = labelled.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("key")
    return stage(labelled.join(mixed, "key").select("key", "id", "n", "c"), "apart")
