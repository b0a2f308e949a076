"""Language identification by unigrams of pieces, summed over all segmentations.

Over a fixed public piece vocabulary each language has a probability for every piece.
The probability of a word is the sum, over all ways to cut it into pieces, of the
product of their probabilities (forward algorithm); that of a text is the product over
its words. Piece probabilities are fitted by expectation-maximisation: the
forward-backward algorithm gives each piece's expected count in the words of a language.

Scale: the model is fitted on at most ``TRAIN_ROWS`` labelled documents (those of least
id hash; a documented bound), through distinct words counted per language in one
pre-aggregated shuffle. It has one number per piece and language and is broadcast.
Scoring is one map over all texts, with a bounded cache of word scores. Words of more than
``LATTICE`` bytes are summed in logs, block by block, with the sums of the last bytes
carried along; their backward sums make each block anew, so memory stays near a block's.

Defined cases: a null text, or one without letters, is ``und`` with score 0; a null
language is not learned from; a null id counts as training data; equal posteriors give
the language first in order; without training rows every text is ``und``; a word of any
length is summed as a whole; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.llm.batches import Words, mix, prefix_hash, signed, slices, span_hash, texts_of
from helioframe.llm.samples import least_hashed
from helioframe.llm.suffix_tree_lm import held_out
from helioframe.session import stage

TRAIN_ROWS = 20_000
ROUNDS = 3
LATTICE = 32  # bytes; products of piece probabilities over more could leave the range of a double
BLOCK = 4096  # bytes of a longer word whose arcs are held at once
CACHE = 400_000  # words
PART = 20_000  # words segmented together
SMOOTHING = 0.1
UNKNOWN = "und"
_U = np.uint64
_START = _U(0x5851F42D4C957F2D)


@lru_cache(maxsize=1)
def vocabulary(path: str) -> tuple[np.ndarray, np.ndarray, int, int, int]:
    """Sorted piece hashes and their ids, the id of byte 0, the longest piece, the size.

    Pieces that open a word have a hash of their own; id ``size`` is the bare opening.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.vocab_size()
    keys, ids, longest, first_byte, bare = [], [], 1, None, size
    for i in range(size):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            first_byte = i if first_byte is None else first_byte
            continue
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            continue
        opens, body = piece.startswith("▁"), piece.removeprefix("▁").encode()
        if not body:
            bare = i
            continue
        if "▁" in piece[1:]:
            continue
        data = np.frombuffer(body, np.uint8)
        key = span_hash(prefix_hash(data), np.array([0]), np.array([len(data)]))[0]
        keys.append(int(mix(np.array([key ^ _START]))[0]) if opens else int(key))
        ids.append(i)
        longest = max(longest, len(body))
    if first_byte is None:
        raise ValueError("the vocabulary has no byte pieces, so some texts have no segmentation")
    keys = np.array(keys, np.uint64)
    order = np.argsort(keys)
    return keys[order], np.array(ids)[order], first_byte, longest, bare


class Lattice:
    """All pieces that match anywhere in some words, with forward and backward sums."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, opens: np.ndarray, path: str):
        keys, ids, first_byte, longest, self.bare = vocabulary(path)
        self.order = np.argsort(start - end, kind="stable")  # longest first
        start, size, opens = start[self.order], (end - start)[self.order], opens[self.order]
        self.size, self.opens, sums = size, opens, prefix_hash(data)
        self.arcs: list[tuple[int, int, np.ndarray, np.ndarray]] = []  # from, to, words, pieces
        for b in range(1, int(size[0]) + 1 if len(size) else 1):
            n = int(np.searchsorted(-size, -b, "right"))
            at = start[:n]
            for width in range(1, min(b, longest) + 1):
                a = b - width
                found = span_hash(sums, at + a, at + b)
                for key, inner in ((found, True), (mix(found ^ _START), False)) if a == 0 else ((found, True),):
                    place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                    hit = keys[place] == key
                    if not inner:
                        hit &= opens[:n]
                    if hit.any():
                        self.arcs.append((a if inner else -1, b, np.flatnonzero(hit), ids[place[hit]]))
            self.arcs.append((b - 1, b, np.arange(n), first_byte + data[at + b - 1].astype(np.int64)))

    def forward(self, p: np.ndarray) -> np.ndarray:
        """Sums over all segmentations of each prefix: (length + 1, word, language)."""
        top = int(self.size[0]) if len(self.size) else 0
        alpha = np.zeros((top + 1, len(self.size), p.shape[1]))
        alpha[0] = np.where(self.opens[:, None], p[self.bare], 1.0)
        for a, b, words, pieces in self.arcs:
            alpha[b, words] += p[pieces] if a < 0 else alpha[a, words] * p[pieces]
        return alpha

    def scores(self, p: np.ndarray) -> np.ndarray:
        """log probability of each word, in the order given, for each language."""
        out = np.empty((len(self.size), p.shape[1]))
        out[self.order] = self.forward(p)[self.size, np.arange(len(self.size))]
        return np.log(np.maximum(out, 1e-300))

    def expected(self, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected count of each piece in words that occur ``counts`` times per language."""
        alpha = self.forward(p)
        whole = np.maximum(alpha[self.size, np.arange(len(self.size))], 1e-300)
        beta = np.zeros_like(alpha)
        beta[self.size, np.arange(len(self.size))] = counts[self.order] / whole
        out = np.zeros_like(p)
        for a, b, words, pieces in reversed(self.arcs):
            share = p[pieces] * beta[b, words]
            if a < 0:
                np.add.at(out, pieces, share)
                continue
            np.add.at(out, pieces, alpha[a, words] * share)
            beta[a, words] += share
        opened = np.flatnonzero(self.opens)
        out[self.bare] += (p[self.bare] * beta[0, opened]).sum(0)
        return out


class LongWord:
    """The sums of ``Lattice`` in logs, for one word of any length.

    Node 0 is the opening of the word, node 1 + b its first b bytes.
    """

    def __init__(self, data: np.ndarray, path: str):
        self.data, self.sums, self.path = data, prefix_hash(data), path
        self.longest, self.bare = vocabulary(path)[3:]

    def arcs(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nodes before and after, and the piece, of all arcs that end after bytes lo + 1 to hi, by end."""
        keys, ids, first_byte, longest, _ = vocabulary(self.path)
        ends = np.arange(lo + 1, hi + 1)
        found = [(ends, ends + 1, first_byte + self.data[lo:hi].astype(np.int64))]
        for width in range(1, min(hi, longest) + 1):
            to = ends[ends >= width]
            hashes = span_hash(self.sums, to - width, to)
            tries = [(hashes, to, to - width + 1)]
            if to[0] == width:
                tries.append((mix(hashes[:1] ^ _START), to[:1], np.zeros(1, np.int64)))
            for key, end, source in tries:
                place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = keys[place] == key
                found.append((source[hit], end[hit] + 1, ids[place[hit]]))
        source, target, piece = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(target, kind="stable")
        return source[order], target[order], piece[order]

    def _blocks(self) -> list[tuple[int, int, int]]:
        """Bytes lo to hi of each block, and the first node from which an arc can end in it."""
        size = len(self.data)
        return [(lo, min(lo + BLOCK, size), max(lo + 1 - self.longest, 0)) for lo in range(0, size, BLOCK)]

    def _ahead(self, logs: np.ndarray, block: tuple[int, int, int], carry: np.ndarray, arcs: tuple) -> np.ndarray:
        """Forward sums of the nodes from ``base``, of which ``carry`` holds those up to lo + 1."""
        lo, hi, base = block
        source, target, piece = arcs
        sums = np.concatenate([carry, np.empty((hi - lo, logs.shape[1]))])
        source, step = source - base, logs[piece]
        cut = np.searchsorted(target, np.arange(lo + 2, hi + 3))
        for i in range(hi - lo):
            here = slice(cut[i], cut[i + 1])
            sums[len(carry) + i] = np.logaddexp.reduce(sums[source[here]] + step[here], axis=0)
        return sums

    def _carries(self, logs: np.ndarray) -> list[np.ndarray]:
        """Forward sums that each block starts from, and at last those of the end."""
        out = [np.stack([np.zeros(logs.shape[1]), logs[self.bare]])]
        blocks = self._blocks()
        for n, block in enumerate(blocks):
            sums = self._ahead(logs, block, out[-1], self.arcs(*block[:2]))
            after = blocks[n + 1][2] if n + 1 < len(blocks) else block[1] + 1
            out.append(sums[after - block[2] :])
        return out

    def score(self, logs: np.ndarray) -> np.ndarray:
        """log probability for each language, from the logs of piece probabilities."""
        return self._carries(logs)[-1][-1]

    def expected(self, logs: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected count of each piece in the word, which occurs ``counts`` times per language."""
        carries, out = self._carries(logs), np.zeros_like(logs)
        total = np.maximum(carries[-1][-1], -1e300)
        after = np.zeros((1, logs.shape[1]))  # backward sums of the last nodes of a block
        for block, carry in zip(reversed(self._blocks()), reversed(carries[:-1]), strict=True):
            lo, hi, base = block
            source, target, piece = arcs = self.arcs(lo, hi)
            ahead = self._ahead(logs, block, carry, arcs)
            sums = np.full_like(ahead, -np.inf)
            sums[len(sums) - len(after) :] = after
            source, target, step = source - base, target - base, logs[piece]
            cut = np.searchsorted(target, np.arange(lo + 2, hi + 3) - base)
            for i in range(hi - lo - 1, -1, -1):
                here = slice(cut[i], cut[i + 1])
                np.logaddexp.at(sums, source[here], sums[len(carry) + i] + step[here])
            np.add.at(out, piece, np.exp(ahead[source] + step + sums[target] - total) * counts)
            after = sums[: len(carry)]
        out[self.bare] += np.exp(logs[self.bare] + after[1] - total) * counts
        return out


def _logs(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log(p)


def word_scores(data: np.ndarray, start: np.ndarray, end: np.ndarray, p: np.ndarray, path: str) -> np.ndarray:
    """log probability of each word, whatever its length, for each language."""
    out = np.full((len(start), p.shape[1]), -np.inf)
    short = np.flatnonzero(end - start <= LATTICE)
    out[short] = Lattice(data, start[short], end[short], np.ones(len(short), bool), path).scores(p)
    logs = _logs(p)
    # Longer words, and products that left the range of a double.
    for i in np.flatnonzero((out < -650).any(1)) if p.shape[1] else ():
        out[i] = LongWord(data[start[i] : end[i]], path).score(logs)
    return out


def expected_pieces(data: np.ndarray, start: np.ndarray, end: np.ndarray, p: np.ndarray, counts: np.ndarray, path: str) -> np.ndarray:
    """Expected count of each piece in words that occur ``counts`` times per language."""
    long = end - start > LATTICE
    short = np.flatnonzero(~long)
    out = Lattice(data, start[short], end[short], np.ones(len(short), bool), path).expected(p, counts[short])
    logs = _logs(p)
    for i in np.flatnonzero(long):
        out += LongWord(data[start[i] : end[i]], path).expected(logs, counts[i])
    return out


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words of a slice with their count for each language."""
    for batch in slices(batches, "text"):
        words = Words(*texts_of(batch.column("text")))
        lang = batch.column("lang").dictionary_encode()
        code = lang.indices.to_numpy()[words.doc] if len(words.doc) else words.doc
        key = mix(words.hashes() + code.astype(np.uint64) * _U(0x9E3779B97F4A7C15))
        _, first, n = np.unique(key, return_index=True, return_counts=True)
        text = [words.data[a:b].tobytes() for a, b in zip(words.start[first], words.end[first], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(text, pa.binary()), lang.dictionary.take(pa.array(code[first])), pa.array(n, pa.int64())],
            names=["word", "lang", "n"],
        )


def _expected(held, path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, total = held.value, np.zeros_like(held.value)
        for batch in batches:
            for at in range(0, batch.num_rows, PART):
                part = batch.slice(at, PART)
                text = part.column("word").to_pylist()
                size = np.array([len(x) for x in text])
                end = np.cumsum(size)
                counts = np.array(part.column("n").to_pylist(), float).reshape(len(text), p.shape[1])
                data = np.frombuffer(b"".join(text), np.uint8)
                total += expected_pieces(data, end - size, end, p, counts, path)
        piece, lang = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(piece.astype(np.int32)), pa.array(lang.astype(np.int32)), pa.array(total[piece, lang])],
            names=["piece", "lang", "n"],
        )

    return run


def fit(docs: DataFrame, path: str, rounds: int = ROUNDS, rows: int = TRAIN_ROWS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, log priors and piece probabilities from ``id``, ``text``, ``lang`` rows."""
    import sentencepiece

    spark = docs.sparkSession
    labelled = docs.where("lang IS NOT NULL AND text IS NOT NULL")
    # Up to ``rows`` rows whatever the size of the table; more are never needed for this model.
    sample = stage(least_hashed(labelled, rows, "id", "text").select("lang", "text"), "sample")
    shares = {r["lang"]: r["count"] for r in sample.groupBy("lang").count().collect()}
    langs = sorted(shares)
    size = sentencepiece.SentencePieceProcessor(model_file=path).vocab_size() + 1
    if not langs:
        return [], np.zeros(0), np.zeros((size, 0))
    counted = sample.repartition(spark.sparkContext.defaultParallelism).mapInArrow(
        _word_counts, "word binary, lang string, n bigint"
    )
    per_lang = [F.coalesce(F.sum(F.when(F.col("lang") == x, F.col("n"))), F.lit(0)).cast("double") for x in langs]
    words = stage(counted.groupBy("word").agg(F.array(*per_lang).alias("n")), "words")
    words = words.repartition(spark.sparkContext.defaultParallelism)
    p = np.full((size, len(langs)), 1.0 / size)
    for _ in range(rounds):
        held = spark.sparkContext.broadcast(p)
        found = words.mapInArrow(_expected(held, path), "piece int, lang int, n double")
        # At most one row for each piece of the fixed vocabulary and language.
        table = found.groupBy("piece", "lang").agg(F.sum("n").alias("n")).toArrow()
        counts = np.full(p.shape, SMOOTHING)
        np.add.at(counts, (table.column("piece").to_numpy(), table.column("lang").to_numpy()), table.column("n").to_numpy())
        p = counts / counts.sum(0)
    prior = np.log(np.array([shares[x] for x in langs], float) / sum(shares.values()))
    return langs, prior, p


def _predict(held, path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, prior, p = held.value
        known, values = np.zeros(0, np.uint64), np.zeros((0, len(langs)), np.float32)
        for batch in slices(batches, "text"):
            words = Words(*texts_of(batch.column("text")))
            keys, first, inverse = np.unique(words.hashes(), return_index=True, return_inverse=True)
            if len(known) > CACHE:
                known, values = known[:0], values[:0]
            fresh = ~np.isin(keys, known, assume_unique=True)
            new = np.flatnonzero(fresh)
            parts = [values]
            for at in range(0, len(new), PART):
                rows = first[new[at : at + PART]]
                parts.append(word_scores(words.data, words.start[rows], words.end[rows], p, path).astype(np.float32))
            both = np.concatenate([known, keys[new]])
            order = np.argsort(both)
            known, values = both[order], np.concatenate(parts)[order]
            score = values[np.searchsorted(known, keys)]
            logs = np.stack(
                [np.bincount(words.doc, score[inverse, j], batch.num_rows) for j in range(len(langs))], 1
            ).reshape(batch.num_rows, len(langs)) + prior if len(langs) else np.zeros((batch.num_rows, 0))
            letters = batch.column("letters").to_numpy(zero_copy_only=False)
            if len(langs):
                best = logs.argmax(1)
                share = 1.0 / np.exp(logs - logs.max(1, keepdims=True)).sum(1)
                names = [langs[i] if ok else UNKNOWN for i, ok in zip(best, letters, strict=True)]
                share = np.where(letters, share, 0.0)
            else:
                names, share = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(share)],
                names=["id", "held_out", "lang_pred", "score"],
            )

    return run


def identify(
    docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 4, fold: int = 2,
) -> DataFrame:
    """``id``, ``held_out``, ``lang_pred`` and ``score`` (posterior of that language)."""
    rows = docs.select(
        F.col(id).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"),
        held_out(F.col(id), folds, fold).alias("held_out"),
    )
    model = fit(rows.where("NOT held_out").select("id", "text", "lang"), path)
    held = docs.sparkSession.sparkContext.broadcast(model)
    rows = rows.select("id", "held_out", "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    return rows.mapInArrow(_predict(held, path), "id bigint, held_out boolean, lang_pred string, score double")
