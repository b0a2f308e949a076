"""Packing of tokenised documents into sequences by vector bin packing.

A sequence has three limits: tokens, segments (pieces) and loss-bearing tokens. A
document is cut into full sequences while it is longer than one; what is left is a
piece with a demand in each limit. Pieces are placed, longest first, into the open
sequence with the largest dot product of demand and remaining room among those that
fit (the dot-product heuristic); a piece that fits nowhere is cut to fill the open
sequence with the most room, and the rest is placed again. A sequence closes when a
limit is reached.

Scale: a document is read, tokenised and placed in the task that reads it; nothing is
shuffled and nothing goes through the driver. Sequence ids are the task's number and a
count, so a lost task that runs again gives the same rows. Each task leaves at most a
few unfilled sequences, a cost per task, not per row. Pieces are placed in groups of
``GROUP`` tokens, so a task's memory does not grow with its input.

Defined cases: a null or empty text is its end id alone; a text longer than a sequence
is cut; equal documents are placed one by one; an empty table gives an empty result;
columns other than id, text and prompt are not read, so their names cannot clash. Null
ids are carried as null.
"""

from __future__ import annotations

import base64
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.llm.batches import slices

LENGTH = 1024
SEGMENTS = 128  # pieces in a sequence
END_ID = 0
GROUP = 2_000_000  # tokens placed together
OPEN = 8  # open sequences that are compared

PIECE = (
    "id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, loss_tokens bigint,"
    " sequence_id bigint, offset bigint"
)


@lru_cache(maxsize=2)
def encoder(path: str):
    """Function from texts to lists of ids for a tokenizer file.

    Where the same vocabulary lies beside it as ``.tiktoken`` ranks, those encode every
    text without special strings: the same ids, about four times faster.
    """
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)
    ranks = path.removesuffix(".json") + ".tiktoken"
    if not os.path.exists(ranks):
        return lambda texts: [e.ids for e in slow.encode_batch(texts, add_special_tokens=False)]
    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as lines:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})
    special = [t.content for t in slow.get_added_tokens_decoder().values()]

    def encode(text: str) -> list[int]:
        if any(t in text for t in special):
            return slow.encode(text, add_special_tokens=False).ids
        try:
            return fast.encode_ordinary(text)
        except (ValueError, RuntimeError):  # its pattern engine gives up on some very long runs
            return slow.encode(text, add_special_tokens=False).ids

    return lambda texts: [encode(t) for t in texts]


@dataclass(frozen=True)
class Limits:
    tokens: int = LENGTH
    segments: int = SEGMENTS
    loss: int = LENGTH


class Packer:
    """Open sequences of one task. ``add`` places documents and returns their pieces.

    A piece is (document, start, length, loss-bearing tokens, sequence, offset). The
    loss-bearing tokens of a document are its last ones.
    """

    def __init__(self, limits: Limits):
        self.limits = limits
        self.full = np.array([limits.tokens, limits.segments, limits.loss], float)
        self.room = np.zeros((OPEN, 3))
        self.name = np.full(OPEN, -1, np.int64)
        self.made = 0

    def add(self, lengths: list[int], losses: list[int]) -> list[tuple[int, int, int, int, int, int]]:
        most, out, rest = self.limits.tokens, [], []
        for doc, (n, loss) in enumerate(zip(lengths, losses, strict=True)):
            start, free = 0, n - loss
            while n - start > most:
                take = min(most, max(0, free - start) + self.limits.loss)
                out.append((doc, start, take, max(0, start + take - max(free, start)), self.made, 0))
                self.made += 1
                start += take
            rest.append((n - start, doc, start, max(0, free - start)))
        rest.sort(key=lambda x: (-x[0], x[1]))
        for left, doc, start, free in rest:
            while left:
                slot, take = self._slot(left, left - min(left, free))
                loss = max(0, take - free)
                out.append((doc, start, take, loss, int(self.name[slot]), most - int(self.room[slot, 0])))
                self.room[slot] -= (take, 1, loss)
                if (self.room[slot] <= 0).any():
                    self.name[slot] = -1
                start, left, free = start + take, left - take, max(0, free - take)
        return out

    def _slot(self, left: int, loss: int) -> tuple[int, int]:
        """An open sequence and how many tokens of the piece it takes."""
        used = self.name >= 0
        demand = np.array([left, 1, loss], float)
        fits = used & (self.room >= demand).all(1)
        if fits.any():
            return int(np.argmax(np.where(fits, (self.room / self.full) @ (demand / self.full), -1.0))), left
        if not used.all():
            slot = int(np.argmin(used))
            self.name[slot], self.room[slot] = self.made, self.full
            self.made += 1
            return slot, int(min(left, left - loss + self.limits.loss))
        takes = np.minimum(self.room[:, 0], left - loss + self.room[:, 2])
        slot = int(np.argmax(takes))
        return slot, int(min(left, takes[slot]))


def _pack(path: str, limits: Limits, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        base = TaskContext.get().partitionId() << 40
        packer = Packer(limits)
        ids, tokens, losses, held = [], [], [], 0
        for batch in slices(batches, "text"):
            heads = encode([t or "" for t in batch.column("prompt").to_pylist()])
            for key, head, body in zip(
                batch.column("id").to_pylist(), heads, encode([t or "" for t in batch.column("text").to_pylist()]), strict=True
            ):
                ids.append(key)
                tokens.append(np.array([*head, *body, end_id], "<u4"))
                losses.append(len(body) + 1)
                held += len(tokens[-1])
            if held >= GROUP:
                yield _rows(packer, ids, tokens, losses, base, with_ids)
                ids, tokens, losses, held = [], [], [], 0
        if ids:
            yield _rows(packer, ids, tokens, losses, base, with_ids)

    return run


def _rows(packer: Packer, ids, tokens, losses, base: int, with_ids: bool) -> pa.RecordBatch:
    pieces = packer.add([len(t) for t in tokens], losses)
    columns = {
        "id": pa.array([ids[p[0]] for p in pieces], pa.int64()),
        "start": pa.array([p[1] for p in pieces], pa.int64()),
        "length": pa.array([p[2] for p in pieces], pa.int64()),
        "ids_crc32": pa.array([zlib.crc32(tokens[p[0]][p[1] : p[1] + p[2]].tobytes()) for p in pieces], pa.int64()),
        "doc_tokens": pa.array([len(tokens[p[0]]) for p in pieces], pa.int64()),
        "loss_tokens": pa.array([p[3] for p in pieces], pa.int64()),
        "sequence_id": pa.array([base | p[4] for p in pieces], pa.int64()),
        "offset": pa.array([p[5] for p in pieces], pa.int64()),
    }
    if with_ids:
        parts = [tokens[p[0]][p[1] : p[1] + p[2]].astype(np.int32) for p in pieces]
        columns["ids"] = pa.array(parts, pa.list_(pa.int32()))
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def pack(
    docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", prompt: str | None = None,
    limits: Limits | None = None, end_id: int = END_ID, with_ids: bool = True,
) -> DataFrame:
    """One row per piece: its place in the document and in its sequence, and its ids.

    ``prompt`` names a column whose tokens come first and bear no loss.
    """
    rows = docs.select(
        F.col(id).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"),
        (F.col(prompt) if prompt else F.lit(None)).cast("string").alias("prompt"),
    )
    schema = PIECE + ", ids array<int>" * with_ids
    return rows.mapInArrow(_pack(tokenizer, limits or Limits(), end_id, with_ids), schema)
