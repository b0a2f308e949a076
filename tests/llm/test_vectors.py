"""Centroid clustering and whitening against plain versions in exact or double arithmetic."""

from __future__ import annotations

import hashlib
import random
from math import floor, isfinite

import numpy as np
import pytest
from pyspark.sql import functions as F
from small_tables import SF_DIR

from helioframe.llm import lookup_clusters, queries, whitening

SCHEMA = "vec_id bigint, embedding array<float>, x int, id string, cluster int, row int, part string"


def rows_of(n: int, width: int = 64) -> list[tuple]:
    draw = random.Random(11)
    rows = [(i, [draw.gauss(0.1 * (i % 5), 0.2) for _ in range(width)]) for i in range(n)]
    rows += [rows[3], rows[3], (900, rows[5][1]), (None, rows[6][1]), (901, None), (902, []), (903, [0.5] * (width - 1))]
    rows += [(904, [None, *rows[0][1][1:]]), (905, [float("nan"), *rows[0][1][1:]]), (906, [float("inf"), *rows[0][1][1:]])]
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, 1, "a", 2, 3, None) for r in rows_of(120)], SCHEMA).repartition(3)


def floats(rows, width=64):
    out = []
    for i, v in rows:
        if v is not None and len(v) == width and all(e is not None and isfinite(e) for e in v):
            out.append((i, [float(np.float32(e)) for e in v]))
    return out


# --- 11 clusters


def plain_clusters(rows, k=40, rounds=5):
    kept = [(i, tuple(floor(256 * e) for e in v)) for i, v in floats(rows)]
    start = sorted((i is None, hashlib.sha256(f"2:{i}".encode()).hexdigest(), x) for i, x in kept)
    cents = [x for _, _, x in start[:k]]

    def near(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(cents))

    for _ in range(rounds):
        members = {}
        for _, x in kept:
            members.setdefault(near(x)[1], []).append(x)
        cents = [tuple(sum(d) // len(members[n]) for d in zip(*members[n])) if n in members else c for n, c in enumerate(cents)]
    return sorted(((i, x), *near(x)[::-1]) for i, x in kept if i is not None), cents


def test_clusters_equal_a_plain_version(spark, odd):
    expected, cents = plain_clusters(rows_of(120))
    found = lookup_clusters.cluster_vectors(odd)
    assert found.centroids.tolist() == [list(c) for c in cents]
    got = sorted((r.id, r.cluster, r.distance) for r in found.assigned.where("id IS NOT NULL").collect())
    assert got == sorted((i, c, d) for (i, _), c, d in expected)
    assert found.assigned.where("id IS NULL").count() == 1
    sums = {r.cluster: r.s for r in found.assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    assert [sums.get(c, 0) for c in range(40)] == found.inertia
    assert found.digest(0) == hashlib.sha256(",".join(map(str, cents[0])).encode()).hexdigest()


def test_few_huge_and_no_vectors(spark, odd):
    two = spark.createDataFrame([(1, [1e30] * 64), (2, [-1e30] * 64)], "vec_id bigint, embedding array<double>")
    found = lookup_clusters.cluster_vectors(two)
    assert sorted(abs(v) for c in found.centroids.tolist() for v in set(c)) == [lookup_clusters.LIMIT] * 2
    assert found.assigned.where("distance = 0").count() == 2
    empty = lookup_clusters.cluster_vectors(odd.where("false"))
    assert empty.assigned.count() == 0 and empty.inertia == []


def test_tables_of_sparse_and_dense_values():
    draw = np.random.default_rng(1)
    x = np.concatenate([draw.integers(-50, 50, (300, 3)), draw.integers(-(2**26), 2**26, (300, 3))])
    cents = draw.integers(-(2**26), 2**26, (7, 3))
    assert (lookup_clusters.distances(x, cents) == ((x[:, None] - cents[None]) ** 2).sum(2)).all()


# --- 12 whitening


def plain_whitening(rows, width=64, m=16):
    kept = [(i, [floor(64 * e) + 1000000 for e in v]) for i, v in floats(rows, width)]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(d) for d in zip(*fit)]
    y = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for x in fit])
    v = y.T @ y / n
    e, p = np.linalg.eigh(v)
    e, p = e[::-1], p[:, ::-1]
    out = []
    for i, x in kept:
        dev = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        out.append((i, dev, np.array([(n * a - s) / n for a, s in zip(x, sums)]) @ p[:, :m] / np.sqrt(e[:m])))
    return n, out, e / np.trace(v)


def check_whitening(found, rows, width=64):
    n, out, shares = plain_whitening(rows, width)
    got = found.rows.collect()
    assert found.n == n and len(got) == len(out)
    assert np.allclose(found.explained, shares[: len(found.explained)], rtol=1e-9) and found.identity_error < 1e-9
    key = lambda i, d: (i is None, i or 0, d)
    got = sorted(((key(r.id, r.deviation), r.whitened) for r in got), key=lambda r: r[0])
    out = sorted(((key(i, d), w) for i, d, w in out), key=lambda r: r[0])
    assert [g[0] for g in got] == [o[0] for o in out]
    a, b = np.array([g[1] for g in got]), np.array([o[1] for o in out])
    sign = np.sign((a * b).sum(axis=0))
    assert np.allclose(a, b * sign, atol=1e-8)


def test_whitening_equals_a_plain_version(spark, odd):
    check_whitening(whitening.whiten(odd), rows_of(120))
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    check_whitening(whitening.whiten(spark.read.parquet(f"{SF_DIR}/embeddings.parquet")), rows)


def test_whitening_query(spark):
    out = queries.queries()["op12_refined_whitening"](spark, SF_DIR)
    rows = out.collect()
    assert len(rows) == 16 * spark.read.parquet(f"{SF_DIR}/embeddings.parquet").count()
    assert {r.component for r in rows} == set(range(1, 17)) and len({r.identity_error for r in rows}) == 1
    assert dict(out.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
        "explained": "double", "identity_error": "double",
    }


def test_whitening_of_few_flat_and_no_vectors(spark, odd):
    schema = "vec_id bigint, embedding array<double>"
    flat = whitening.whiten(spark.createDataFrame([(i, [float(i % 3), 5.0, 2.0 * (i % 3)]) for i in range(9)], schema))
    assert flat.n == 3 and flat.explained[0] == pytest.approx(1) and flat.identity_error < 1e-9
    assert all(r.whitened[0] is not None and r.whitened[1:] == [None, None] for r in flat.rows.collect())
    one = whitening.whiten(spark.createDataFrame([(1, [2.0, 3.0])] * 2, schema))
    assert one.n == 1 and one.identity_error == 0 and {tuple(r.whitened) for r in one.rows.collect()} == {(None, None)}
    huge = whitening.whiten(spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 0.0]), (3, [0.0, 1.0])], schema))
    assert huge.n == 3 and {r.deviation for r in huge.rows.collect()} >= {None}
    assert whitening.whiten(odd.where("false")).rows.count() == 0


def test_eigenvectors_of_clustered_values():
    draw = np.random.default_rng(4)
    q, _ = np.linalg.qr(draw.normal(size=(40, 40)))
    for e in (np.r_[np.ones(5), np.ones(5) + 1e-9 * np.arange(5), np.arange(2, 32)], np.geomspace(1, 1e-8, 40), np.ones(40), np.zeros(40)):
        v = (q * e) @ q.T
        v = (v + v.T) / 2
        values, x = whitening.eigenvectors(v)
        assert np.allclose(values, np.sort(e)[::-1], atol=1e-14 * 40)
        assert np.abs(v @ x - x * values).max() < 1e-13 and np.abs(x.T @ x - np.eye(40)).max() < 1e-14


def test_refinement_reaches_double_precision():
    """Separated values: the vectors agree with a solver in double to its own error."""
    draw = np.random.default_rng(5)
    v = np.cov(draw.normal(size=(64, 500)) * np.linspace(1, 4, 64)[:, None])
    values, x = whitening.eigenvectors(v)
    e, p = np.linalg.eigh(v)
    assert np.abs(np.abs((p[:, ::-1] * x).sum(0)) - 1).max() < 1e-13 and np.allclose(values, e[::-1], rtol=1e-14)
    exact = (v.astype(np.longdouble) @ x.astype(np.longdouble) - x * values.astype(np.longdouble)).astype(float)
    assert np.abs(exact).max() < 4e-15 * values[0]
