"""Quality classifier from positives and unlabelled text: non-negative unbiased risk.

Trusted positives are documents labelled 1; the unlabelled sample is training text
whatever its label. A first classifier of positive against unlabelled gives the class
prior: over thresholds, the least ratio of the unlabelled share above to the positive
share above, with a bound for the sampling error (best-bin estimate). A small network
on shape features then minimises

    prior * E_p[loss(+)] + max(0, E_u[loss(-)] - prior * E_p[loss(-)])

with logistic loss, so its output is the probability of label 1. When the second term
falls below zero the step goes against it alone.

Scale: features are one map over whole texts, written once (a few dozen numbers for each
document). The fit takes at most ``SAMPLE`` positives and ``SAMPLE`` unlabelled rows of
least id hash (a documented bound); scoring is a second map over the features.

Defined cases: a null or empty text has zero counts and gets the model's score for
those; labels without a document, or with a null quality, are ignored, and of repeated
labels the largest counts; without positives or unlabelled rows every score is 0.5; a
null id counts as training data without a label; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.llm.batches import Words, byte_set, mix, slices, texts_of, windows
from helioframe.llm.samples import least_hashed
from helioframe.llm.suffix_tree_lm import held_out
from helioframe.session import stage

SAMPLE = 20_000
HIDDEN, STEPS, RATE, DECAY = 24, 600, 0.02, 1e-3
THRESHOLD = 0.3
_U = np.uint64


def _table(chars: bytes) -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[np.frombuffer(chars, np.uint8)] = True
    return flags


_CLASSES = {
    "upper": _table(bytes(range(65, 91))), "lower": _table(bytes(range(97, 123))), "digit": _table(b"0123456789"),
    "symbol": _table(b"#*$%&<>@^~=+_\\{}[]"), "bar": _table(b"|"), "shout": _table(b"!?"), "point": _table(b".,;:"),
    "quote": _table(b"\"'()-/"), "high": _table(bytes(range(128, 256))), "space": _table(b" \t\r\v\f"), "line": _table(b"\n"),
}
_NOT_LINE = byte_set((0x0A, 0x0A))


def _distinct(doc: np.ndarray, keys: np.ndarray, n: int) -> np.ndarray:
    """Number of different keys of each text."""
    pairs = np.unique(mix(keys + mix(doc.astype(np.uint64) + _U(5))), return_index=True)[1]
    return np.bincount(doc[pairs], minlength=n)


def features(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Shape of each text: shares of character classes, words, repeats and lines."""
    n = len(places) - 1
    words, lines = Words(data, places), Words(data, places, _NOT_LINE)
    hashes = words.hashes()
    size = np.diff(places).astype(float)
    count = words.count.astype(float)
    length = (words.end - words.start).astype(float)
    some, many = np.maximum(size, 1), np.maximum(count, 1)
    out = [np.log1p(count)]
    for flags in _CLASSES.values():
        sums = np.concatenate([[0], np.cumsum(flags[data])])
        out.append((sums[places[1:]] - sums[places[:-1]]) / some)
    out.append(np.bincount(words.doc, length, n) / many)
    out.append(np.sqrt(np.bincount(words.doc, length**2, n) / many))
    out.append(_distinct(words.doc, hashes, n) / many)
    for k in (2, 3):
        keys = windows(hashes, k)
        doc = words.doc[: len(keys)]
        inside = doc == words.doc[k - 1 :] if len(keys) else np.zeros(0, bool)
        whole = np.maximum(np.bincount(doc[inside], minlength=n), 1)
        out.append(1 - _distinct(doc[inside], keys[inside], n) / whole)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (words.doc[1:] == words.doc[:-1])
    out.append(np.bincount(words.doc, same, n) / many)
    last, head = data[words.end - 1], data[words.start]
    for flags in (_CLASSES["symbol"][last], _CLASSES["shout"][last], _CLASSES["point"][last], _CLASSES["upper"][head]):
        out.append(np.bincount(words.doc, flags, n) / many)
    out.append(np.bincount(words.doc, length == 1, n) / many)
    rows = np.maximum(lines.count, 1)
    out.append(1 - _distinct(lines.doc, lines.hashes(), n) / rows)
    out.append(np.log1p(count / rows))
    out.append(np.bincount(lines.doc, _CLASSES["point"][data[lines.end - 1]], n) / rows)
    shares = np.stack(out, 1)
    rates = np.log(shares[:, 1:] + 1e-3)
    return np.concatenate([shares, rates], 1).astype(np.float32)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        x = features(*texts_of(batch.column("text")))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("held_out"), lists], names=["id", "held_out", "x"])


class Network:
    """One hidden layer over standardised features; ``logit`` of label 1."""

    def __init__(self, x: np.ndarray, seed: int = 1):
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        draw = np.random.default_rng(seed)
        d = x.shape[1]
        self.w = [draw.normal(0, d**-0.5, (d, HIDDEN)), np.zeros(HIDDEN), draw.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]

    def _ready(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def logit(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.w
        return np.tanh(self._ready(x) @ a + b) @ c + d

    def train(self, x: np.ndarray, slope) -> None:
        """Adam; ``slope(logits)`` is the derivative of the risk by each logit."""
        x = self._ready(x)
        m, v = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w]
        for step in range(1, STEPS + 1):
            a, b, c, d = self.w
            h = np.tanh(x @ a + b)
            g = slope(h @ c + d)
            back = g[:, None] * c * (1 - h * h)
            grads = [x.T @ back + DECAY * a, back.sum(0), h.T @ g + DECAY * c, np.array([g.sum()])]
            for i, grad in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * grad
                v[i] = 0.99 * v[i] + 0.01 * grad * grad
                self.w[i] = self.w[i] - RATE * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.99**step)) + 1e-8)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def class_prior(p: np.ndarray, u: np.ndarray) -> float:
    """Share of positives in ``u``: the best-bin ratio over thresholds of a held-out half."""
    both = np.concatenate([p[::2], u[::2]])
    first = np.arange(len(both)) < len(p[::2])
    net = Network(both)
    weight = np.where(first, 0.5 / max(first.sum(), 1), 0.5 / max((~first).sum(), 1))
    net.train(both, lambda z: weight * (sigmoid(z) - first))
    at_p, at_u = np.sort(net.logit(p[1::2])), np.sort(net.logit(u[1::2]))
    cut = np.quantile(at_p, np.linspace(0, 0.95, 200))
    above_p = 1 - np.searchsorted(at_p, cut) / len(at_p)
    above_u = 1 - np.searchsorted(at_u, cut) / len(at_u)
    error = np.sqrt(np.log(40) / (2 * len(at_p))) + np.sqrt(np.log(40) / (2 * len(at_u)))
    best = int(np.argmin((above_u + error) / np.maximum(above_p, 1e-9)))
    return float(np.clip(above_u[best] / above_p[best], 0.01, 0.99))


def fit(p: np.ndarray, u: np.ndarray) -> tuple[Network, float]:
    """Network of least non-negative risk, and the estimated class prior."""
    prior = class_prior(p, u)
    both = np.concatenate([p, u])
    n = len(p)
    net = Network(u)

    def slope(z: np.ndarray) -> np.ndarray:
        positive, soft = sigmoid(z), np.logaddexp(0, z)
        lower = np.concatenate([-prior * positive[:n] / n, positive[n:] / len(u)])
        if soft[n:].mean() - prior * soft[:n].mean() < 0:
            return -lower
        lower[:n] += prior * (positive[:n] - 1) / n
        return lower

    net.train(both, slope)
    return net, prior


def _score_rows(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = held.value
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
            score = np.full(len(x), 0.5) if net is None else sigmoid(net.logit(x))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("held_out"), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))],
                names=["id", "held_out", "score", "predicted"],
            )

    return run


def _sample(rows: DataFrame, size: int) -> np.ndarray:
    """At most ``size`` feature rows, those of least id hash."""
    table = least_hashed(rows.select("id", "x"), size, "id").select("x").toArrow()
    values = table.column("x").combine_chunks().flatten().to_numpy()
    return values.reshape(table.num_rows, len(values) // max(table.num_rows, 1)).astype(float)


def classify(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", quality: str = "quality",
    folds: int = 5, fold: int = 0, sample: int = SAMPLE,
) -> DataFrame:
    """``id``, ``held_out``, ``score`` (probability of label 1) and ``predicted``."""
    rows = docs.select(
        F.col(id).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"), held_out(F.col(id), folds, fold).alias("held_out")
    )
    shaped = stage(rows.mapInArrow(_feature_rows, "id bigint, held_out boolean, x array<float>"), "features")
    train = shaped.where("NOT held_out")
    trusted = labels.groupBy(F.col(id).cast("bigint").alias("id")).agg(F.max(quality).alias("q")).where("q = 1").select("id")
    p, u = _sample(train.join(trusted, "id", "left_semi"), sample), _sample(train, sample)
    net = fit(p, u)[0] if len(p) > 3 and len(u) > 3 else None
    held = docs.sparkSession.sparkContext.broadcast(net)
    return shaped.mapInArrow(_score_rows(held), "id bigint, held_out boolean, score double, predicted int")
