"""Exact removal of repeated substrings with a run-length compressed index.

Every byte covered by a ``LENGTH``-byte string that also starts earlier in the corpus
(smaller id, or earlier in the same document) is removed; strings are judged on the
input. Matches never cross documents.

1. Anchors. Each window of ``LENGTH`` bytes has as anchor its ``SEED``-byte piece of
   least hash (leftmost of equals). Equal windows have equal anchors, so only anchors
   that occur twice can lie in repeated windows. Counts are pre-aggregated per task.
2. Contexts. The windows of one anchor are one run of bytes, its context. Contexts meet
   by anchor and 64-bit hash; all but the first of equal ones are repeats. Equal contexts
   of one slice are sent once. An anchor with more than ``HOT`` occurrences is dealt by
   the hashes of each single window instead, so no task gets an unbounded group.
3. Index. Different contexts of one anchor may still share windows. Over the bytes of
   those that share a block with another, suffixes are ranked by prefix doubling; rows
   that share ``LENGTH`` bytes form an interval, and a window is a repeat when its interval
   holds an earlier place. These ranks decide. The Burrows-Wheeler transform over the same
   rows is kept as runs, and LF steps over them only lead from row to row; the full suffix
   order is held too, and the samples at run ends are not read.
4. Removed runs go back to their documents.

Scale: rows that cross the network are two numbers per anchor (about one per 39 bytes),
the texts once, six numbers per repeated anchor, and the bytes of contexts that differ
under one anchor; all steps are joins and
pre-aggregated groupings on keys, and nothing goes through the driver.

Defined cases: a null or empty text, and one shorter than ``LENGTH``, loses nothing;
rows with equal ids are one document: a row is never removed for its own twin, and what
goes from one goes from all; rows without an id come after all others, ordered by a hash
of their text; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.llm.batches import mix, prefix_hash, signed, slices, span_hash, texts_of
from helioframe.session import stage

LENGTH = 100
SEED = 24
HOT = 4096
CONTEXTS = 6000  # indexed together, in whole anchors
BLOCKS = 4
SEGMENT = 1 << 18  # windows hashed together, small enough for a processor cache
_POSITION = 26  # low bits of an order key; a segment is shorter than 2 ** 26
_NO_ID = 2**62  # rows without an id come after those with one, by a hash of their text
_U = np.uint64


def _seed_hashes(data: np.ndarray) -> np.ndarray:
    n = len(data) - SEED + 1
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray((len(data),), "<u8", padded.tobytes(), strides=(1,))
    h = words[:n] * _U(0x9E3779B97F4A7C15)
    h += words[8 : 8 + n] * _U(0xC2B2AE3D27D4EB4F)
    h ^= h >> _U(31)
    h += words[16 : 16 + n] * _U(0x165667B19E3779F9)
    h ^= h >> _U(32)
    h *= _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(29)
    return h


def anchors(data: np.ndarray, places: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """For every anchor: its hash, text number, first window start, count of windows, place."""
    found = []
    for base in range(0, max(len(data) - length + 1, 0), SEGMENT):
        part = data[base : base + SEGMENT + length - 1]
        hashes = _seed_hashes(part)
        low = _U((1 << _POSITION) - 1)
        least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
        width, span = length - SEED + 1, 1
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < width:
            least = np.minimum(least[: -(width - span)], least[width - span :])
        at = (least & low).astype(np.int64)
        starts = np.arange(len(at)) + base
        doc = np.searchsorted(places, starts, "right") - 1
        valid = starts + length <= places[doc + 1]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1]) | ~valid[:-1]
        first = np.flatnonzero(new & valid)
        edge = np.flatnonzero(new | ~valid)
        nxt = np.append(edge, len(at))[np.searchsorted(edge, first, "right")]
        found.append((hashes[at[first]], doc[first], starts[first], nxt - first, at[first] + base))
    if not found:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        hashes, doc, _, _, _ = anchors(*texts_of(batch.column("text")))
        ids = batch.column("id").to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(signed(hashes)), pa.array(ids[doc])], names=["a", "id"])


_CONTEXT = "key bigint, c bigint, id bigint, s bigint, n int, p int"


def _context_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts of the repeated anchors (columns ``cold`` and ``hot``) of each text.

    ``n`` windows from ``s`` on, the anchor ``p`` bytes further. Of equal contexts in a
    slice the first is sent; the others are removed runs already, joined where they
    touch, and marked by a negative ``p`` (``n`` is then their length).
    """
    for batch in slices(batches, "text"):
        data, places = texts_of(batch.column("text"))
        hashes, doc, start, count, at = anchors(data, places)
        ids = batch.column("id").to_numpy()
        cold, hot = (_member(batch.column(c), doc, hashes) for c in ("cold", "hot"))
        sums = prefix_hash(data)
        # Every window of a hot anchor is a context of its own, known by two unrelated hashes.
        spread = np.repeat(np.flatnonzero(hot), count[hot])
        lone = start[spread] + np.arange(len(spread)) - np.repeat(np.cumsum(count[hot]) - count[hot], count[hot])
        lone_hash = span_hash(sums, lone, lone + LENGTH)
        key = np.concatenate([hashes[cold], _window_hash(data, lone)])
        c = np.concatenate([span_hash(sums, start[cold], start[cold] + count[cold] - 1 + LENGTH), lone_hash])
        s = np.concatenate([start[cold], lone])
        n = np.concatenate([count[cold], np.ones(len(lone), np.int64)])
        p = np.concatenate([(at - start)[cold], np.zeros(len(lone), np.int64)])
        d = np.concatenate([doc[cold], doc[spread]])
        owner, local = ids[d], s - places[d]
        first, _ = _firsts(key, c, owner, local)
        done = ~((owner == owner[first]) & (local == local[first]))
        whole, lo, hi = _joined(d[done], local[done], local[done] + n[done] - 1 + LENGTH)
        away = mix(ids[whole].astype(np.uint64) * _U(0x9E3779B97F4A7C15) + lo.astype(np.uint64))
        keep = ~done
        columns = [
            np.concatenate([signed(key[keep]), signed(away)]), np.concatenate([signed(c[keep]), signed(away)]),
            np.concatenate([owner[keep], ids[whole]]), np.concatenate([local[keep], lo]),
            np.concatenate([n[keep], hi - lo]).astype(np.int32),
            np.concatenate([p[keep], np.full(len(lo), -1)]).astype(np.int32),
        ]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["key", "c", "id", "s", "n", "p"])


def _joined(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of each text with those that touch or overlap made one."""
    order = np.lexsort((lo, doc))
    doc, lo, hi = doc[order], lo[order], hi[order]
    if not len(doc):
        return doc, lo, hi
    # Ends grow within a text once shifted by the text's number.
    shift = doc.astype(np.int64) * (int(hi.max()) + 1)
    reach = np.maximum.accumulate(hi + shift)
    new = np.append(True, (lo + shift)[1:] > reach[:-1])
    new[1:] |= doc[1:] != doc[:-1]
    lead = np.flatnonzero(new)
    last = np.append(lead[1:], len(doc)) - 1
    return doc[lead], lo[lead], reach[last] - shift[last]


def _window_hash(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hash of the ``LENGTH`` bytes from each start, from its pieces of ``SEED`` bytes; shares nothing with ``span_hash``."""
    out = np.full(len(starts), LENGTH, np.uint64)
    if len(starts):
        pieces = _seed_hashes(data)
        for at in [*range(0, LENGTH - SEED, SEED), LENGTH - SEED]:
            out = mix(out * _U(0xD6E8FEB86659FD93) + pieces[starts + at])
    return out


def _member(lists: pa.Array, doc: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each anchor's hash is in the list of its own document."""
    owner = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    values = lists.flatten().to_numpy().astype(np.int64).view(np.uint64)
    salt = lambda d: mix(d.astype(np.uint64) + _U(77))
    return np.isin(hashes ^ salt(doc), values ^ salt(owner))


def _firsts(key: np.ndarray, c: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the row of its equal context that comes first, and whether that is itself."""
    order = np.lexsort((starts, ids, c, key))
    new = np.ones(len(order), bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (c[order][1:] != c[order][:-1])
    lead = order[np.flatnonzero(new)][np.cumsum(new) - 1] if len(order) else order
    first = np.empty(len(order), np.int64)
    first[order] = lead
    return first, first == np.arange(len(order))


class RunLengthIndex:
    """Burrows-Wheeler transform of some contexts, kept as runs.

    Each context ends in a separator of its own. ``rows`` are sorted suffixes; the
    transform's runs hold their symbol, first row and the count of the symbol before
    them, and the position (context, offset) of their first and last row.
    """

    def __init__(self, contexts: list[bytes], depth: int):
        count, self.sizes = len(contexts), np.array([len(x) for x in contexts])
        width = int(self.sizes.max()) + 1
        raw = np.frombuffer(b"".join(contexts), np.uint8)
        inside = np.arange(width) < self.sizes[:, None]
        symbols = np.zeros((count, width), np.uint64)
        symbols[inside] = raw.astype(np.uint64) + _U(1)
        valid = np.arange(width) <= self.sizes[:, None]
        # Ranks of suffixes cut at 7, 14, ... symbols; a suffix ends at its separator.
        packed = np.zeros((count, width), np.uint64)
        for i in range(7):
            packed[:, : width - i] |= symbols[:, i:] << _U(9 * (6 - i))
        rank, span, ranks = self._ranked(packed, valid), 7, {}
        while span < width:
            ranks[span] = rank
            rank = self._ranked(self._joined(rank, rank, span), valid)
            span *= 2
        at = np.flatnonzero(valid.ravel())
        order = at[np.argsort(rank.ravel()[at], kind="stable")]  # equal suffixes by context
        self.row_context, self.row_offset = np.divmod(order, width)
        # Rows that share ``depth`` symbols: the longest stored cut, twice.
        cut = max(s for s in ranks if s <= depth)
        head = self._joined(ranks[cut], ranks[cut], depth - cut).ravel()[order] if 2 * cut >= depth else None
        if head is None:
            raise ValueError("depth is too small or too large for the stored ranks")
        change = np.ones(len(order), bool)
        change[1:] = head[1:] != head[:-1]
        self.interval = np.cumsum(change) - 1
        self.interval_start = np.flatnonzero(change)
        before = symbols[self.row_context, np.maximum(self.row_offset - 1, 0)]
        bwt = np.where(self.row_offset > 0, before, 0).astype(np.int64)
        heads = np.ones(len(bwt), bool)
        heads[1:] = bwt[1:] != bwt[:-1]
        self.run_start = np.flatnonzero(heads)
        self.run_symbol = bwt[self.run_start]
        run_end = np.append(self.run_start[1:], len(bwt)) - 1
        self.samples = [(self.row_context[r], self.row_offset[r]) for r in (self.run_start, run_end)]
        sizes = run_end - self.run_start + 1
        by_symbol = np.argsort(self.run_symbol, kind="stable")
        running = np.cumsum(sizes[by_symbol]) - sizes[by_symbol]
        # First row of the symbol and the symbols counted before the run, in one number.
        self.run_target = np.empty(len(sizes), np.int64)
        self.run_target[by_symbol] = running

    @staticmethod
    def _joined(left: np.ndarray, right: np.ndarray, step: int) -> np.ndarray:
        out = left << _U(32)
        if step < left.shape[1]:
            out[:, : left.shape[1] - step] |= right[:, step:]
        return out

    @staticmethod
    def _ranked(keys: np.ndarray, valid: np.ndarray) -> np.ndarray:
        out = np.zeros(keys.shape, np.uint64)
        _, inverse = np.unique(keys[valid], return_inverse=True)
        out[valid] = inverse.astype(np.uint64) + _U(1)
        return out

    def step(self, rows: np.ndarray) -> np.ndarray:
        """LF: from the rows of suffixes to the rows of the suffixes one symbol longer."""
        run = np.searchsorted(self.run_start, rows, "right") - 1
        return self.run_target[run] + rows - self.run_start[run]

    def stream(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Contexts, offsets and rows, read from every context's end to its start."""
        rows = np.arange(len(self.sizes))  # the separators' rows come first, by context
        active, offset = np.arange(len(self.sizes)), self.sizes.copy()
        while len(active):
            rows, offset = self.step(rows), offset - 1
            yield active, offset, rows
            go = offset > 0
            rows, active, offset = rows[go], active[go], offset[go]


def repeated_windows(contexts: list[bytes], ids: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """(context, offset) of every window that also starts at an earlier (id, start)."""
    index = RunLengthIndex(contexts, length)
    # Place of each row in corpus order, and the first of each interval.
    row_start = starts[index.row_context] + index.row_offset
    order = np.lexsort((row_start, ids[index.row_context]))
    place = np.empty(len(order), np.int64)
    same = np.zeros(len(order), bool)
    same[1:] = (row_start[order][1:] == row_start[order][:-1]) & (
        ids[index.row_context][order][1:] == ids[index.row_context][order][:-1]
    )
    place[order] = np.cumsum(~same)
    first = np.minimum.reduceat(place, index.interval_start)
    out = []
    for context, offset, rows in index.stream():
        whole = offset + length <= index.sizes[context]
        context, offset, rows = context[whole], offset[whole], rows[whole]
        hit = place[rows] > first[index.interval[rows]]
        out.append(np.stack([context[hit], offset[hit]], 1))
    return np.concatenate(out) if out else np.zeros((0, 2), np.int64)


_SPAN = "id bigint, lo bigint, hi bigint"
_FOUND = _SPAN + ", key bigint, n int, p int"


def _sorted_groups(batches: Iterator[pa.RecordBatch], reduce) -> Iterator[pa.Table]:
    """Rows sorted by key in tables of whole groups; ``reduce`` shrinks a group still open."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table]).combine_chunks()
        keys = table.column("key").to_numpy()
        split = int(np.searchsorted(keys, keys[-1], "left")) if len(keys) else 0
        if split:
            yield table.slice(0, split)
        held = yield from reduce(table.slice(split))
    if held is not None and held.num_rows:
        yield held


def _match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From contexts sorted by key, id and start: removed runs (null key), and the first of
    each of several different contexts of one anchor, whose bytes the index must compare."""

    def rows(ids, lo, hi, key=None, n=None, p=None) -> pa.RecordBatch:
        none = pa.nulls(len(ids), pa.int64()), pa.nulls(len(ids), pa.int32()), pa.nulls(len(ids), pa.int32())
        more = none if key is None else (pa.array(key), pa.array(n), pa.array(p))
        return pa.RecordBatch.from_arrays(
            [*(pa.array(x, pa.int64()) for x in (ids, lo, hi)), *more], names=["id", "lo", "hi", "key", "n", "p"]
        )

    def collapse(table: pa.Table) -> tuple[pa.RecordBatch, pa.Table]:
        key, c, ids, starts, n, p = (table.column(x).to_numpy() for x in ("key", "c", "id", "s", "n", "p"))
        first, _ = _firsts(key, c, ids, starts)
        ready = p < 0
        out = ready | ~((ids == ids[first]) & (starts == starts[first]))
        end = starts + np.where(ready, n, n - 1 + LENGTH)
        return rows(ids[out], starts[out], end[out]), table.filter(pa.array(~out))

    spans: list[pa.RecordBatch] = []

    def shrink(table: pa.Table):
        gone, rest = collapse(table)
        spans.append(gone)
        return rest
        yield

    for table in _sorted_groups(batches, shrink):
        gone, rest = collapse(table)
        spans.append(gone)
        key, ids, starts, n, p = (rest.column(x).to_numpy() for x in ("key", "id", "s", "n", "p"))
        _, group, members = np.unique(key, return_inverse=True, return_counts=True)
        several = members[group] > 1
        spans.append(rows(*(x[several] for x in (ids, starts, starts, key, n, p))))
        yield from spans
        spans.clear()
    yield from spans


def _bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted contexts of each text."""
    for whole in batches:
        for batch in slices(iter([whole]), "text"):
            data, places = texts_of(batch.column("text"))
            wanted = batch.column("wanted")
            row = np.repeat(np.arange(batch.num_rows), wanted.value_lengths().to_numpy(zero_copy_only=False))
            key, s, n, p = (wanted.flatten().field(x).to_numpy() for x in ("key", "lo", "n", "p"))
            ids = batch.column("id").to_numpy()[row]
            fits = places[row] + s + n - 1 + LENGTH <= places[row + 1]
            row, key, s, n, p, ids = (x[fits] for x in (row, key, s, n, p, ids))
            size = n.astype(np.int64) - 1 + LENGTH
            at = np.concatenate([[0], np.cumsum(size)])
            take = np.repeat(places[row] + s - at[:-1], size) + np.arange(at[-1])
            blob = pa.Array.from_buffers(
                pa.binary(), len(s), [None, pa.py_buffer(at.astype(np.int32).tobytes()), pa.py_buffer(data[take].tobytes())]
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(ids), pa.array(s), pa.array(p), blob], names=["key", "id", "s", "p", "context"]
            )


def _with_partner(table: pa.Table) -> np.ndarray:
    """Contexts that share with another one of their anchor a block in which a window of
    both could lie: a window that starts l bytes before the anchor holds, for its part of
    the range of l, the same block around it. A context without a partner has no match."""
    key, p = table.column("key").to_numpy(), table.column("p").to_numpy()
    contexts = table.column("context").combine_chunks()
    places = np.frombuffer(contexts.buffers()[1], np.int32)[contexts.offset : contexts.offset + len(contexts) + 1].astype(np.int64)
    data = np.frombuffer(contexts.buffers()[2], np.uint8) if contexts.buffers()[2] is not None else np.zeros(0, np.uint8)
    data, places = data[places[0] : places[-1]], places - places[0]
    sums = prefix_hash(data)
    out = np.zeros(len(key), bool)
    edges = np.linspace(0, LENGTH - SEED, BLOCKS + 1).astype(int)
    for near, far in zip(edges[:-1], edges[1:], strict=True):
        lo, hi = places[:-1] + p - near, places[:-1] + p + LENGTH - far
        inside = np.flatnonzero((lo >= places[:-1]) & (hi <= places[1:]))
        block = mix(span_hash(sums, lo[inside], hi[inside]) ^ mix(key[inside].view(np.uint64)))
        _, which, times = np.unique(block, return_inverse=True, return_counts=True)
        out[inside[times[which] > 1]] = True
    return out


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removed runs from the bytes of contexts sorted by key, id and start."""

    def as_it_is(table: pa.Table):
        return table
        yield

    waiting: list[pa.Table] = []

    def work() -> pa.RecordBatch:
        table = pa.concat_tables(waiting).combine_chunks()
        waiting.clear()
        ids, starts = table.column("id").to_numpy(), table.column("s").to_numpy()
        hits = repeated_windows(table.column("context").to_pylist(), ids, starts)
        return _merged_hits(hits, ids, starts)

    for table in _sorted_groups(batches, as_it_is):
        waiting.append(table.filter(pa.array(_with_partner(table))))
        if sum(t.num_rows for t in waiting) >= CONTEXTS:
            yield work()
    if sum(t.num_rows for t in waiting):
        yield work()


def _span_batch(ids, lo, hi) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (ids, lo, hi)], names=["id", "lo", "hi"])


def _merged_hits(hits: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
    if not len(hits):
        return _span_batch(ids[:0], ids[:0], ids[:0])
    order = np.lexsort((hits[:, 1], hits[:, 0]))
    context, offset = hits[order, 0], hits[order, 1]
    new = np.ones(len(order), bool)
    new[1:] = (context[1:] != context[:-1]) | (offset[1:] != offset[:-1] + 1)
    lead = np.flatnonzero(new)
    last = np.append(lead[1:], len(order)) - 1
    base = starts[context[lead]] if len(lead) else np.zeros(0, np.int64)
    return _span_batch(ids[context[lead]], base + offset[lead], base + offset[last] + LENGTH)


def _whole_characters(text: np.ndarray, runs: list[list[int]]) -> str:
    lead = (text & 0xC0) != 0x80
    out, at = [], 0
    for lo, hi in runs:
        while lo < hi and not lead[lo]:
            lo += 1
        while lo < hi < len(text) and not lead[hi]:
            hi -= 1
        out.append(text[at:lo].tobytes())
        at = max(lo, hi)
    return b"".join([*out, text[at:].tobytes()]).decode()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in slices(batches, "text"):
        data, places = texts_of(batch.column("text"))
        kept, spans, clean = [], [], []
        for i, found in enumerate(batch.column("found").to_pylist()):
            text = data[places[i] : places[i + 1]]
            runs: list[list[int]] = []
            for lo, hi in sorted((r["lo"], min(r["hi"], len(text))) for r in found or ()):
                if lo >= hi:
                    continue
                if runs and lo <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], hi)
                else:
                    runs.append([lo, hi])
            edges = [0, *(x for r in runs for x in r), len(text)]
            kept.append(b"".join(text[a:b].tobytes() for a, b in zip(edges[::2], edges[1::2], strict=True)))
            spans.append([{"start": a, "end": b} for a, b in runs])
            clean.append(_whole_characters(text, runs))
        yield pa.RecordBatch.from_arrays(
            [batch.column("text"), batch.column("rest"), pa.array(np.diff(places), pa.int64()), pa.array(spans, span),
             pa.array(kept, pa.binary()), pa.array(clean, pa.string())],
            names=["text", "rest", "n_bytes", "spans", "kept", "clean"],
        )


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` (columns ``keep``, else all), ``n_bytes``, ``spans`` (removed runs of bytes),
    ``kept`` (remaining bytes) and ``clean`` (the text without those characters that lie
    wholly in a removed run, so it is valid wherever a run starts or ends)."""
    keep = keep or docs.columns
    # The joins below read the same three columns, so the texts are shuffled once.
    texts = docs.select(
        F.coalesce(F.col(id).cast("bigint"), F.lit(_NO_ID) + F.shiftrightunsigned(F.xxhash64(text), 2)).alias("id"),
        F.col(text).cast("string").alias("text"),
        F.struct(F.lit(0).alias("_"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(keep) if c != text]).alias("rest"),
    )
    found = texts.select("id", "text").mapInArrow(_anchor_rows, "a bigint, id bigint")
    often = found.groupBy("a").agg(F.count("*").alias("k")).where("k > 1").select("a", (F.col("k") > HOT).alias("many"))
    often = stage(often, "anchors")  # then both sides of the join are shuffles, which adaptive execution can split
    lists = found.join(often, "a").groupBy("id").agg(
        F.collect_set(F.when(~F.col("many"), F.col("a"))).alias("cold"),
        F.collect_set(F.when(F.col("many"), F.col("a"))).alias("hot"),
    )
    contexts = texts.join(lists, "id").select("id", "text", "rest", "cold", "hot").mapInArrow(_context_rows, _CONTEXT)
    found = contexts.repartition("key").sortWithinPartitions("key", "id", "s").mapInArrow(_match, _FOUND)
    wanted = found.where("key IS NOT NULL").groupBy("id").agg(F.collect_list(F.struct("key", "lo", "n", "p")).alias("wanted"))
    pieces = texts.join(wanted, "id").select("id", "text", "rest", "wanted").mapInArrow(
        _bytes, "key bigint, id bigint, s bigint, p int, context binary"
    )
    indexed = pieces.repartition("key").sortWithinPartitions("key", "id", "s").mapInArrow(_index, _SPAN)
    spans = found.where("key IS NULL").select("id", "lo", "hi").union(indexed)
    per_text = spans.groupBy("id").agg(F.collect_list(F.struct("lo", "hi")).alias("found"))
    joined = texts.join(per_text, "id", "left").select("text", "rest", "found")
    rest = joined.schema["rest"].dataType.simpleString()
    cut = joined.mapInArrow(
        _cut,
        f"text string, rest {rest}, n_bytes bigint, spans array<struct<start: bigint, end: bigint>>, kept binary, clean string",
    )
    row = [(F.col("text") if c == text else F.col(f"rest.c{i}")).alias(c) for i, c in enumerate(keep)]
    return cut.select(F.struct(*row).alias("row"), "n_bytes", "spans", "kept", "clean")
