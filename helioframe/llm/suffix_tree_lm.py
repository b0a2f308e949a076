"""Probabilistic suffix tree over the bytes of words, and scores by longest suffix states.

A text is lower-cased (A-Z) and read as its words joined by one space and closed by an
end symbol, so a probability of the symbols is one of the word sequence. Contexts of up
to ``DEPTH`` symbols are counted on training texts. A context becomes a state when its
share of all positions reaches ``MIN_SHARE`` and its next-symbol distribution differs
from that of its longest suffix by ``MIN_GAIN`` nats over all its positions. Each
state's distribution is smoothed by its suffix's (Witten-Bell weights), down to add-one
over all symbols. The states, closed under prefixes and suffixes, form an automaton: a
text is scored by one table step per byte, and the step leads to the longest suffix that
is a state.

The base score is a unigram model over words with add-one smoothing.

Scale: counts are merged in each task before one shuffle and grow with the corpus. The
model comes to the driver as at most ``1 / MIN_NEXT`` transitions per depth, whatever
the corpus size, and is broadcast. Word counts stay distributed: at most ``COMMON`` of the
most frequent words are broadcast, all others meet their counts in a join on the word's hash.
Texts are read twice and never shuffled.

Defined cases: a null or empty text is the end symbol alone (one token); a null id is
training data; rows with equal ids are scored one by one; an empty table gives an empty
result; without training texts every symbol is equally likely; a NUL byte is read as
byte 1; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helioframe.llm.batches import Words, signed, slices, texts_of
from helioframe.session import stage

DEPTH = 5
MIN_SHARE = 1e-6  # of all positions, for a context
MIN_NEXT = 2e-7  # of all positions, for a context and its next symbol
MIN_GAIN = 5.0  # nats
COMMON = 500_000
STEPS = 256  # symbols scored in a row; rows run side by side
MERGE = 3_000_000  # distinct keys held by a task before they are merged
END, SPACE = 0x0A, 0x20
END_WORD = -1  # key of the end token; a word's hash takes it with chance 2 ** -64
_U = np.uint64


def symbols_of(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """All texts as symbols, each closed by END, and the n + 1 places between texts."""
    n = len(words.count)
    size = words.end - words.start + 1
    total = np.zeros(n, np.int64)
    np.add.at(total, words.doc, size)
    total[words.count == 0] = 1
    places = np.concatenate([[0], np.cumsum(total)])
    out = np.full(places[-1], SPACE, np.uint8)
    at = np.cumsum(size) - size
    shift = places[:-1][words.doc] - at[np.minimum(words.first[:-1], max(len(at) - 1, 0))][words.doc] if len(at) else at
    inner = np.arange(int(size.sum())) - np.repeat(at, size)
    body = inner < np.repeat(size - 1, size)
    source = np.repeat(words.start, size) + inner
    target = np.arange(int(size.sum())) + np.repeat(shift, size)
    out[target[body]] = np.maximum(words.data[source[body]], 1)
    out[places[1:] - 1] = END
    return out, places


def grams(symbols: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """Each symbol with the ``depth`` before it as one number; END opens a text, 0 is nothing."""
    padded = np.concatenate([np.zeros(depth, np.uint8), symbols])
    key = symbols.astype(np.uint64)
    inside = np.arange(len(symbols)) - np.repeat(places[:-1], np.diff(places))
    for back in range(1, depth + 1):
        before = padded[depth - back : depth - back + len(symbols)].astype(np.uint64)
        before = np.where(inside >= back, before, np.where(inside == back - 1, _U(END), _U(0)))
        key |= before << _U(8 * back)
    return key


class _Counter:
    """Counts of keys, merged in sorted arrays."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, keys: np.ndarray) -> None:
        self.parts.append(np.unique(keys, return_counts=True))
        self.held += len(self.parts[-1][0])

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([p[0] for p in self.parts] or [np.zeros(0, np.uint64)])
        counts = np.concatenate([p[1] for p in self.parts] or [np.zeros(0, np.int64)])
        self.parts, self.held = [], 0
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, int)
        return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _counts(depth: int):
    def rows(kind: int, counter: _Counter) -> pa.RecordBatch:
        keys, counts = counter.take()
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(keys), kind, np.int32)), pa.array(signed(keys)), pa.array(counts.astype(np.int64))],
            names=["kind", "key", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (_Counter(), _Counter())
        for batch in slices(batches, "text"):
            words = Words(*texts_of(batch.column("text")))
            symbols, places = symbols_of(words)
            ends = np.full(batch.num_rows, END_WORD, np.int64).view(np.uint64)
            for kind, keys in enumerate((np.concatenate([words.hashes(), ends]), grams(symbols, places, depth))):
                found[kind].add(keys)
                if found[kind].held > MERGE:
                    yield rows(kind, found[kind])
        for kind in (0, 1):
            yield rows(kind, found[kind])

    return run


class SuffixTree:
    """Automaton of the states: ``next`` state and log10 probability for state and byte."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray]], total: int, depth: int, share: float, gain: float):
        """``levels[l]``: strings of l + 1 symbols (contexts of l and the next one) and counts."""
        self.depth = depth
        keys, counts = levels[0] if levels else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        # A column per byte that occurs, and one for each of the others alike.
        seen_bytes = np.unique(np.append(keys.astype(np.int64), END))
        self.columns = np.full(256, len(seen_bytes), np.int64)
        self.columns[seen_bytes] = np.arange(len(seen_bytes))
        self.width = width = len(seen_bytes) + 1
        root = np.ones(width)
        root[self.columns[keys.astype(np.int64)]] += counts
        rows = {0: np.zeros(1, np.uint64)}  # contexts of each length, sorted
        dist = {0: (root / (root.sum() + 255 - width))[None, :]}  # of every candidate; byte 0 does not occur
        keep = {0: np.ones(1, bool)}
        for length in range(1, depth + 1):
            keys, counts = levels[length] if length < len(levels) else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            context, index = np.unique(keys >> _U(8), return_inverse=True)
            # Occurrences of the context, also before symbols too rare to be listed.
            weight = np.bincount(index, counts, len(context)) if len(context) else np.zeros(0)
            listed, times = levels[length - 1] if length - 1 < len(levels) else (np.zeros(0, np.uint64), np.zeros(0))
            if len(listed) and len(context):
                at = np.minimum(np.searchsorted(listed, context), len(listed) - 1)
                weight = np.where(listed[at] == context, np.maximum(times[at], weight), weight)
            often = weight >= max(share * total, 2)
            parent = np.searchsorted(rows[length - 1], context & _U((1 << 8 * (length - 1)) - 1))
            parent = np.minimum(parent, len(rows[length - 1]) - 1)
            often &= rows[length - 1][parent] == context & _U((1 << 8 * (length - 1)) - 1)
            place = np.cumsum(often) - 1
            rows[length], parent, weight = context[often], parent[often], weight[often]
            seen = np.zeros((len(rows[length]), width))
            mine = often[index] if len(context) else np.zeros(0, bool)
            seen[place[index[mine]], self.columns[(keys[mine] & _U(255)).astype(np.int64)]] = counts[mine]
            above = dist[length - 1][parent]
            kinds = (seen > 0).sum(1)[:, None]
            left = weight[:, None] - seen.sum(1)[:, None] + kinds  # goes to the suffix
            dist[length] = (seen + left * above) / (weight[:, None] + kinds)
            with np.errstate(divide="ignore", invalid="ignore"):
                part = dist[length] * np.log(dist[length] / above)
            keep[length] = np.nansum(part, 1) * weight >= gain
        for length in range(depth, 1, -1):  # suffixes and prefixes of states are states
            for part in (rows[length] & _U((1 << 8 * (length - 1)) - 1), rows[length] >> _U(8)):
                at = np.minimum(np.searchsorted(rows[length - 1], part), len(rows[length - 1]) - 1)
                known = rows[length - 1][at] == part
                keep[length] &= known
                keep[length - 1][at[known & keep[length]]] = True
        for length in range(1, depth + 1):
            # Closing from above may have dropped a state whose prefix is no candidate; drop what hung on it.
            low = _U((1 << 8 * (length - 1)) - 1)
            for part in (rows[length] & low, rows[length] >> _U(8)):
                have = rows[length - 1][keep[length - 1]]
                at = np.minimum(np.searchsorted(have, part), len(have) - 1)
                keep[length] &= have[at] == part
        base = np.cumsum([0] + [int(keep[k].sum()) for k in range(depth + 1)])
        self.log = np.concatenate([np.log10(np.maximum(dist[k][keep[k]], 1e-300)) for k in range(depth + 1)]).astype(np.float32)
        self.next = np.zeros((base[-1], width), np.int32)
        states = [rows[k][keep[k]] for k in range(depth + 1)]
        for length in range(depth + 1):
            own = slice(base[length], base[length + 1])
            if length:
                low = _U((1 << 8 * (length - 1)) - 1)
                self.next[own] = self.next[base[length - 1] + np.searchsorted(states[length - 1], states[length] & low)]
            if length < depth and len(states[length + 1]):
                before = np.searchsorted(states[length], states[length + 1] >> _U(8))
                last = self.columns[(states[length + 1] & _U(255)).astype(np.int64)]
                self.next[base[length] + before, last] = base[length + 1] + np.arange(len(before))
        self.states = int(base[-1])

    def score(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """log10 probability of each text."""
        n, ahead = len(symbols), self.depth
        rows = -(-n // STEPS)
        line = np.full(ahead + rows * STEPS, self.columns[END])
        line[ahead : ahead + n] = self.columns[symbols]
        at = np.arange(rows) * STEPS
        state = np.zeros(rows, np.int64)
        table, logs = self.next.ravel(), self.log.ravel()
        gained = np.empty((STEPS, rows), np.float32)
        for step in range(-ahead, STEPS):
            move = state * self.width + line[at + step + ahead]
            if step >= 0:
                gained[step] = logs[move]
            state = table[move].astype(np.int64)
        sums = np.concatenate([[0.0], np.cumsum(gained.T.ravel()[:n], dtype=np.float64)])
        return sums[places[1:]] - sums[places[:-1]]


@lru_cache(maxsize=1)
def _tree(held_id: int, held) -> SuffixTree:
    return SuffixTree(**held.value["tree"])


def _scores(held, depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, common, counts = _tree(id(held), held), held.value["words"], held.value["counts"]
        gain = np.log10(counts + 1.0)
        row = TaskContext.get().partitionId() << 40
        for batch in slices(batches, "text"):
            words = Words(*texts_of(batch.column("text")))
            symbols, places = symbols_of(words)
            hashes = words.hashes().view(np.int64)
            at = np.minimum(np.searchsorted(common, hashes), max(len(common) - 1, 0))
            hit = common[at] == hashes if len(common) else np.zeros(len(hashes), bool)
            n = batch.num_rows
            logs = np.bincount(words.doc[hit], gain[at[hit]], n) if hit.any() else np.zeros(n)
            known = np.bincount(words.doc[hit], minlength=n)
            rest_doc, rest = words.doc[~hit], hashes[~hit]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + n)), batch.column("id"), batch.column("held_out"),
                    pa.array(words.count + 1), pa.array(known.astype(np.int64)), pa.array(logs),
                    pa.array(tree.score(symbols, places)),
                    pa.ListArray.from_arrays(
                        pa.array(np.searchsorted(rest_doc, np.arange(n + 1)).astype(np.int32)), pa.array(rest)
                    ),
                ],
                names=["row", "id", "held_out", "n_tokens", "known", "logs", "score", "rare"],
            )
            row += n

    return run


def held_out(id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text is ``fold`` modulo ``folds``; a null id is not."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def score_texts(
    docs: DataFrame, id: str = "doc_id", text: str = "text", folds: int = 7, fold: int = 2, depth: int = DEPTH,
    min_share: float = MIN_SHARE, min_next: float = MIN_NEXT, min_gain: float = MIN_GAIN, common: int = COMMON,
) -> DataFrame:
    """``id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``."""
    spark = docs.sparkSession
    texts = docs.select(
        F.col(id).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"),
        held_out(F.col(id), folds, fold).alias("held_out"),
    )
    counts = texts.where("NOT held_out").select("text").mapInArrow(_counts(depth), "kind int, key bigint, n bigint")
    counts = stage(counts.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    words, strings = counts.where("kind = 0").select("key", "n"), counts.where("kind = 1").select("key", "n")
    totals = words.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    tokens, distinct = totals["n"] or 0, totals["v"]

    total = strings.agg(F.sum("n")).first()[0] or 0
    levels: list[tuple[np.ndarray, np.ndarray]] = []
    for length in range(depth, -1, -1):  # strings of length + 1 symbols; shorter ones are sums of longer ones
        if length < depth:
            low = (1 << 8 * (length + 1)) - 1
            strings = stage(strings.groupBy(F.col("key").bitwiseAND(F.lit(low)).alias("key")).agg(F.sum("n").alias("n")), "strings")
        # A context of length symbols starts with one: no padding before it.
        often = strings.where(F.col("n") >= max(1, min_next * total))
        often = often.where(F.col("key") >= F.lit(1 << 8 * length)) if length else often
        kept = often.select("key", "n").toArrow()  # at most 1 / min_next rows
        keys = kept.column("key").to_numpy().astype(np.int64).view(np.uint64)
        order = np.argsort(keys)
        levels.append((keys[order], kept.column("n").to_numpy()[order]))
    # The most frequent words by classes of count, as many whole classes as ``common`` allows.
    rank = F.floor(F.log2("n") * 8).cast("int")
    classes = sorted(((r["rank"], r["count"]) for r in words.groupBy(rank.alias("rank")).count().collect()), reverse=True)
    held_words, least = 0, 10_000
    for value, count in classes:  # at most some hundred classes
        held_words += count
        if held_words > common:
            break
        least = value
    top = words.where((F.col("key") != END_WORD) & (rank >= least)).toArrow()
    order = np.argsort(top.column("key").to_numpy())
    held = spark.sparkContext.broadcast(
        {
            "tree": {"levels": levels[::-1], "total": total, "depth": depth, "share": min_share, "gain": min_gain},
            "words": top.column("key").to_numpy()[order].astype(np.int64),
            "counts": top.column("n").to_numpy()[order].astype(np.int64),
        }
    )
    schema = (
        "row bigint, id bigint, held_out boolean, n_tokens bigint, known bigint, logs double, score double, rare array<bigint>"
    )
    scored = stage(texts.mapInArrow(_scores(held, depth), schema), "scores")
    rare = scored.select("row", F.explode("rare").alias("key")).groupBy("key", "row").agg(F.count("*").alias("m"))
    rare = rare.join(words, "key").groupBy("row").agg(
        F.sum(F.col("m") * F.log10(F.col("n") + 1.0)).alias("more"), F.sum("m").alias("also")
    )
    ends = words.where(F.col("key") == END_WORD).agg(F.max("n")).first()[0] or 0
    unit = float(np.log10(tokens + 1.0 * (distinct + 1)))
    return scored.join(rare, "row", "left").select(
        "id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("also", F.lit(0)) + F.lit(int(ends > 0))).alias("n_known"),
        F.lit(tokens).cast("bigint").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more", F.lit(0.0)) + F.lit(float(np.log10(ends + 1.0))) - F.col("n_tokens") * F.lit(unit)).alias(
            "base_score"
        ),
        "score",
    )
