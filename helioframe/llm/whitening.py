"""Embedding whitening with eigenvectors refined in mixed precision.

The covariance of the distinct integer vectors is summed on Spark. Its eigenvectors are
first computed in single precision and then corrected by Ogita-Aishima iterations,
which consist of matrix products in a higher precision. Where eigenvalues are so close
that the correction of single vectors has no meaning, the small problem inside their
common subspace is solved and the vectors are rotated.

Scale: a row's integers are written once, as bytes; equal vectors meet by those bytes,
each task keeping one of each, so a vector that a third of all rows share is one row a
task. Sums and products come from the distinct vectors, one block of numbers a task and
place, summed on Spark. Only sums (``d`` numbers) and products (``d * d``) reach the
driver, where ``d`` is the width of the vectors and does not grow with the rows.

Defined cases: a row is left out when its vector is null, holds a null or non-finite
entry, or has another width than most vectors (the greater of equally common widths; an
empty vector never counts); rows with null or repeated ids are rows of their own. An
integer further than ``LIMIT`` from the shift counts as ``LIMIT``. A component whose
eigenvalue is not above ``RANK`` times the largest has no direction to scale: its
``whitened`` entry is null, its ``explained`` share is given, and ``identity_error``
leaves it out. ``deviation`` is null where the exact sum does not fit a long. Without a
row, the result is empty. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.llm.vectors import BLOCK, as_lists, blocks, finite_vectors, sum_blocks
from helioframe.session import stage

LIMIT = 1 << 36
RANK = 1e-12
TURNS = 12
NOISE = 1e-15
_PARTS = "row int, block int, part array<double>"


# --- integers


def _packed(scale: float):
    """Arrow map to ``id``, ``width`` and ``x``: a vector's integers in as few bytes as they need."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sizes, values = finite_vectors(batch.column("vector"))
            with np.errstate(over="ignore"):
                x = np.clip(np.floor(scale * values), -LIMIT, LIMIT).astype(np.int64)
            starts = np.cumsum(sizes) - sizes
            packed = [b""] * len(sizes)
            for size in np.unique(sizes[sizes > 0]):
                at = np.flatnonzero(sizes == size)
                part = x[starts[at, None] + np.arange(size)]
                top = np.abs(part).max(axis=1)
                for low, high, kind in ((0, 1 << 15, "<i2"), (1 << 15, 1 << 31, "<i4"), (1 << 31, 1 << 62, "<i8")):
                    mine = np.flatnonzero((top >= low) & (top < high))
                    raw, step = part[mine].astype(kind).tobytes(), size * int(kind[-1])
                    for n, i in enumerate(at[mine]):
                        packed[i] = raw[n * step : (n + 1) * step]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(rows)), pa.array(sizes, pa.int32()), pa.array(packed, pa.binary())],
                names=["id", "width", "x"],
            )

    return run


def unpack(column: pa.Array, width: int) -> np.ndarray:
    """The integers of a batch as a matrix."""
    raw = column.to_pylist()
    out = np.zeros((len(raw), width), np.int64)
    sizes = np.array([len(r) for r in raw])
    for size, kind in ((2 * width, "<i2"), (4 * width, "<i4"), (8 * width, "<i8")):
        at = np.flatnonzero(sizes == size)
        if len(at):
            out[at] = np.frombuffer(b"".join(raw[i] for i in at), kind).reshape(len(at), width)
    return out


# --- sums and products over the fit list


def _rows_of(matrix: np.ndarray) -> pa.RecordBatch:
    parts = [blocks(row) for row in matrix]
    n = len(parts[0]) if parts else 0
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat(np.arange(len(parts)), n), pa.int32()),
            pa.array(np.tile(np.arange(n), len(parts)), pa.int32()),
            as_lists(np.concatenate(parts) if parts else np.zeros((0, BLOCK)), pa.float64()),
        ],
        names=["row", "block", "part"],
    )


def _gather(df: DataFrame, rows: int, columns: int) -> np.ndarray:
    out = np.zeros((rows, -(-columns // BLOCK), BLOCK))
    for r in sum_blocks(df, ["row", "block"]).collect():
        out[r.row, r.block] = r.part
    return out.reshape(rows, -1)[:, :columns]


def _totals(width: int):
    """Arrow map to one row a block: exact sums of the integers, then the number of vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width + 1, np.int64)
        for batch in batches:
            x = unpack(batch.column("x"), width)
            total[:width] += x.sum(axis=0)
            total[width] += len(x)
        parts = blocks(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(parts)), pa.int32()), as_lists(parts, pa.int64())], names=["block", "part"])

    return run


@dataclass(frozen=True)
class Centre:
    """Number of vectors and exact sums; ``floor`` and ``rest`` are their integer means and remainders."""

    n: int
    sums: list[int]

    @property
    def floor(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        return np.array([s % self.n for s in self.sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n, from integers that are already close to the mean."""
        return (x - self.floor) - self.rest / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Exact sum of (n * x - sums) ** 2 of every row, None where it does not fit a long."""
        z = x - self.floor
        top = (int(np.abs(z).max(initial=0)) + 1) * self.n
        if top * top * max(1, x.shape[1]) < 1 << 63:
            return ((z * self.n - self.rest) ** 2).sum(axis=1).tolist()
        exact = ((z.astype(object) * self.n - self.rest.astype(object)) ** 2).sum(axis=1)
        return [int(v) if v < 1 << 63 else None for v in exact]


def _products(width: int, centre: Centre):
    """Arrow map to the products of all pairs of centred dimensions, summed over the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            y = centre.centred(unpack(batch.column("x"), width))
            total += y.T @ y
        yield _rows_of(total)

    return run


def _whitened_products(width: int, centre: Centre, matrix: np.ndarray):
    """As above for the whitened vectors; a last row holds their sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((matrix.shape[1] + 1, matrix.shape[1]))
        for batch in batches:
            w = centre.centred(unpack(batch.column("x"), width)) @ matrix
            total[:-1] += w.T @ w
            total[-1] += w.sum(axis=0)
        yield _rows_of(total)

    return run


# --- eigenvectors


def _corrected(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One Ogita-Aishima step: (better vectors, eigenvalues, distance below which values count as equal).

    With R = I - X'X and S = X'AX, the correction of X is X E, where
    e_ij = (s_ij + l_j r_ij) / (l_j - l_i) for separated values and r_ij / 2 otherwise.
    The first is r_ij / 2 plus (s_ij + (l_i + l_j) r_ij / 2) / (l_j - l_i), which is
    exactly antisymmetric when S is symmetric and so leaves the vectors orthogonal.
    """
    r = np.eye(x.shape[1], dtype=a.dtype) - x.T @ x
    s = x.T @ (a @ x)
    r, s = (r + r.T) / 2, (s + s.T) / 2
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(values)
    size = np.linalg.norm(a.astype(float))
    close = float(2 * (np.linalg.norm(off.astype(float)) + size * np.linalg.norm(r.astype(float))))
    close = max(close, NOISE * size)  # values nearer than the matrix itself is known
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > close
    turn = (s + (values[None, :] + values[:, None]) / 2 * r) / np.where(apart, gap, 1)
    e = r / 2 + np.where(apart, turn, 0)
    return x + x @ e, values, close


def _orthonormal(x: np.ndarray) -> np.ndarray:
    """An orthonormal basis of the space of nearly orthonormal columns, by two Newton steps."""
    for _ in range(2):
        x = x @ (1.5 * np.eye(x.shape[1], dtype=x.dtype) - 0.5 * (x.T @ x))
    return x


def _clusters(values: np.ndarray, close: float) -> list[np.ndarray]:
    """Runs of two or more values whose neighbours are not further apart than ``close``."""
    order = np.argsort(-values, kind="stable")
    cuts = np.flatnonzero(-np.diff(values[order]) > close) + 1
    return [run for run in np.split(order, cuts) if len(run) > 1]


def eigenvectors(v: np.ndarray, turns: int = TURNS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a symmetric matrix to double precision.

    Starts from single precision. Every turn corrects all vectors by matrix products in
    extended precision; then each cluster of close values is solved in its own subspace:
    its vectors V give the small matrix V'(A - m I)V, whose eigenvectors rotate them.
    It ends when a turn no longer lowers the residual.
    """
    scale = float(np.abs(v).max(initial=0)) or 1.0
    a = (v / scale).astype(np.longdouble)
    _, start = np.linalg.eigh((v / scale).astype(np.float32))
    x, best, least = start.astype(np.longdouble), None, np.inf
    for _ in range(turns):
        x, values, close = _corrected(a, x)
        for run in _clusters(values, close):
            basis = _orthonormal(x[:, run])
            middle = values[run].mean()
            inner = basis.T @ (a @ basis - middle * basis)
            size = float(np.abs(inner).max()) or 1.0
            _, turn = np.linalg.eigh((inner / size).astype(float))
            x[:, run] = basis @ _orthonormal(turn.astype(np.longdouble))
        values = np.einsum("ij,ij->j", x, a @ x) / np.einsum("ij,ij->j", x, x)
        error = float(np.abs(a @ x - x * values).max() + np.abs(x.T @ x - np.eye(len(a))).max())
        if not error < least:
            break
        best, least = (x.copy(), values), error
    x, values = best
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.sqrt(np.einsum("ij,ij->j", x, x))[order]
    return (values[order] * scale).astype(float), x.astype(float)


# --- the operator


@dataclass(frozen=True)
class Whitening:
    """``rows`` holds ``id``, ``deviation`` and ``whitened`` (one entry a component)."""

    rows: DataFrame
    n: int
    explained: list[float]
    identity_error: float


def _applied(width: int, centre: Centre, matrix: np.ndarray, ranked: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unpack(batch.column("x"), width)
            w = centre.centred(x) @ matrix
            cells = pa.array(w.ravel(), pa.float64(), mask=np.tile(~ranked, len(w)))
            ends = pa.array(np.arange(len(w) + 1, dtype=np.int32) * matrix.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(centre.deviation(x), pa.int64()), pa.ListArray.from_arrays(ends, cells)],
                names=["id", "deviation", "whitened"],
            )

    return run


def whiten(df: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = 16, scale: float = 64.0) -> Whitening:
    """Every vector projected on the first ``components`` eigenvectors, each scaled to unit variance.

    Entries are read as floor(scale * entry); a constant shift of all entries changes
    nothing. The covariance counts each distinct vector once, divisor their number.
    """
    rows = df.select(F.col(id).alias("id"), F.col(vector).alias("vector"))
    kind = dict(rows.dtypes)["id"]
    out = f"id {kind}, deviation bigint, whitened array<double>"
    kept = stage(rows.mapInArrow(_packed(scale), f"id {kind}, width int, x binary"), "packed")
    widths = kept.where("width > 0").groupBy("width").agg(F.count("*").alias("n"))
    common = widths.orderBy(F.desc("n"), F.desc("width")).first()
    if common is None:
        return Whitening(df.sparkSession.createDataFrame([], out), 0, [], 0.0)
    width = common.width
    kept = kept.where(F.col("width") == width).select("id", "x")
    fit = stage(kept.select("x").distinct(), "fit")
    totals = sum_blocks(fit.mapInArrow(_totals(width), "block int, part array<bigint>"), ["block"], kind="decimal(38,0)")
    flat = [int(v) for r in sorted(totals.collect()) for v in r.part]
    centre = Centre(flat[width], flat[:width])

    v = _gather(fit.mapInArrow(_products(width, centre), _PARTS), width, width) / centre.n
    v = (v + v.T) / 2
    values, vectors = eigenvectors(v)
    m = min(components, width)
    ranked = values[:m] > RANK * max(values[0], 0)
    matrix = vectors[:, :m] / np.sqrt(np.where(ranked, values[:m], 1))
    trace = float(np.trace(v))
    sums = _gather(fit.mapInArrow(_whitened_products(width, centre, matrix), _PARTS), m + 1, m) / centre.n
    away = np.abs(sums[:-1] - np.outer(sums[-1], sums[-1]) - np.eye(m))[np.ix_(ranked, ranked)]
    return Whitening(
        kept.mapInArrow(_applied(width, centre, matrix, ranked), out), centre.n,
        [float(e) / trace if trace > 0 else 0.0 for e in values[:m]], float(away.max(initial=0.0)),
    )
