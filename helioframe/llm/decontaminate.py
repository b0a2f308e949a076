"""Benchmark decontamination: one Aho-Corasick automaton over normalised benchmark windows.

Texts are lower-cased (A-Z) and cut into words of letters, digits and non-ASCII
characters. Every run of ``window`` consecutive words of an item is a pattern (a
shorter item is one pattern). The automaton reads each text once; word numbers of a
hit map back to places in the original text.

Scale: documents are only mapped, never shuffled. Patterns are broadcast in blocks of
at most ``BLOCK_BYTES`` item text, chosen by a hash of the item id after a count of
bytes, so neither the driver nor a worker ever holds more than one block's automaton;
with several blocks the documents pass through one map for each block.

Defined cases: a null or empty text (or item) has no words and hits nothing; repeated
documents are judged each on its own; items with equal windows are all reported; an
empty benchmark hits nothing; an empty table gives an empty result; other columns are
carried in ``row`` untouched, so their names cannot clash. A null item id is reported
as the string ``null``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.llm.batches import byte_set

WINDOW = 13
MIN_SHARE = 20  # contaminated: MIN_SHARE * hit words >= words
BLOCK_BYTES = 400_000

# Words: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z.
_INSIDE = byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
_TABLE = bytes(
    (b + 32 if 65 <= b <= 90 else b) if _INSIDE[b + 32 if 65 <= b <= 90 else b] else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TABLE).split()


def word_places(text: str) -> list[tuple[int, int]]:
    """First and past-last character of every word in the original text."""
    raw = np.frombuffer(b" " + text.encode().translate(_TABLE) + b" ", np.uint8)
    inside = raw != 32
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    lead = np.frombuffer(text.encode(), np.uint8)
    chars = np.concatenate([[0], np.cumsum((lead & 0xC0) != 0x80)])
    return [(int(chars[a]), int(chars[b])) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def item_patterns(items: list[tuple[str, str]], window: int) -> dict[str, list[str]]:
    """Normalised windows, with a space at both ends, and the ids of their items."""
    found: dict[str, list[str]] = {}
    for item, text in items:
        words = words_of(text)
        if not words:
            continue
        width = min(window, len(words))
        for i in range(len(words) - width + 1):
            key = (b" " + b" ".join(words[i : i + width]) + b" ").decode()
            ids = found.setdefault(key, [])
            if not ids or ids[-1] != item:
                ids.append(item)
    return found


@lru_cache(maxsize=1)
def _automaton(token: int, items: tuple[tuple[str, str], ...], window: int) -> ahocorasick.Automaton | None:
    patterns = item_patterns(list(items), window)
    if not patterns:
        return None
    machine = ahocorasick.Automaton()
    for key, ids in patterns.items():
        machine.add_word(key, (key.count(" ") - 1, ids))
    machine.make_automaton()
    return machine


def find_hits(machine: ahocorasick.Automaton | None, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
    """Hit runs as word numbers [first, past), merged, and the items that occur."""
    if machine is None or not words:
        return [], set()
    text = (b" " + b" ".join(words) + b" ").decode()
    runs: list[tuple[int, int]] = []
    items: set[str] = set()
    spaces = None
    for end, (width, ids) in machine.iter(text):
        if spaces is None:
            spaces = {at: i for i, at in enumerate(i for i, c in enumerate(text) if c == " ")}
        past = spaces[end]
        runs.append((past - width, past))
        items.update(ids)
    return _merged(runs), items


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, past in sorted(runs):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(past, out[-1][1]))
        else:
            out.append((first, past))
    return out


_RUNS = pa.list_(pa.struct([("first", pa.int32()), ("past", pa.int32())]))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW,
) -> DataFrame:
    """``row`` (all columns of ``docs``), ``n_words``, ``n_hit``, ``items`` (sorted ids) and
    ``spans`` (hit runs as character places of the original text), one row per document.
    """
    spark = docs.sparkSession
    items = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"),
        F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("words"),
    )
    size = items.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    blocks = int(size // BLOCK_BYTES) + 1
    out = docs.select(
        F.struct("*").alias("row"),
        F.col(text).cast("string").alias("text"),
        F.expr("CAST(array() AS ARRAY<STRUCT<first: INT, past: INT>>)").alias("runs"),
        F.expr("CAST(array() AS ARRAY<STRING>)").alias("items"),
        F.lit(0).cast("bigint").alias("n_words"),
        F.expr("CAST(array() AS ARRAY<STRUCT<first: INT, past: INT>>)").alias("spans"),
    )
    for block in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        # At most about BLOCK_BYTES of item text: the benchmark, not the corpus.
        held = spark.sparkContext.broadcast(tuple(sorted((r.item, r.words) for r in part.collect())))
        out = out.mapInArrow(_scan(held, window), out.schema)
    return out.select(
        "row", "n_words",
        F.expr("CAST(aggregate(runs, 0, (n, r) -> n + r.past - r.first) AS BIGINT)").alias("n_hit"),
        F.array_sort(F.array_distinct("items")).alias("items"), "spans",
    )


def _scan(held, window: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _automaton(held.id if hasattr(held, "id") else id(held), held.value, window)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            old_runs, old_items = batch.column("runs").to_pylist(), batch.column("items").to_pylist()
            runs, items, counts, spans = [], [], [], []
            for text, had, had_items in zip(texts, old_runs, old_items, strict=True):
                words = words_of(text)
                found, names = find_hits(machine, words)
                both = _merged(found + [(r["first"], r["past"]) for r in had])
                at = word_places(text) if both else []
                counts.append(len(words))
                runs.append([{"first": a, "past": b} for a, b in both])
                spans.append([{"first": at[a][0], "past": at[b - 1][1]} for a, b in both])
                items.append(sorted(names.union(had_items)))
            columns = {
                "row": batch.column("row"), "text": batch.column("text"),
                "runs": pa.array(runs, _RUNS), "items": pa.array(items, pa.list_(pa.string())),
                "n_words": pa.array(counts, pa.int64()), "spans": pa.array(spans, _RUNS),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return scan


def contaminated(share: int = MIN_SHARE):
    """True for rows of ``decontaminate`` whose hit words reach one in ``share``."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))
