"""Whitening against the eigenvectors that numpy finds, and the steps of the bidiagonalisation."""

import math

import numpy as np
import pytest

from statkit.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>"


def expected(vectors, k):
    """By vec_id: exact deviation, whitened entries by numpy's eigh; and explained shares. Signs: the largest entry positive."""
    used = [(i, v) for i, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    d = max((len(v) for _, v in used), default=0)
    x = [(i, [math.floor(1024 * float(np.float32(c))) + 100_000 for c in v]) for i, v in used if len(v) == d]
    n, sums = len(x), [sum(v[j] for _, v in x) for j in range(d)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for _, v in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, sums, strict=True)] for _, v in x])
    e, q = np.linalg.eigh(centred.T @ centred / n)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    q = q * np.sign(q[np.abs(q).argmax(axis=0), np.arange(q.shape[1])])
    return [i for i, _ in x], n, deviations, centred @ q / np.sqrt(e), e / (centred**2).sum() * n


def check(frame, vectors, k=8, closeness=1e-9):
    ids, n, deviations, whitened, explained = expected(vectors, k)
    rows = sorted(frame.collect(), key=lambda r: (r["vec_id"], r["component"]))
    want = sorted((ids[i], c + 1, deviations[i], float(whitened[i, c]), float(explained[c])) for i in range(n) for c in range(len(explained)))
    want.sort(key=lambda w: w[:2])
    assert [(r["vec_id"], r["component"], r["n"], r["deviation"]) for r in rows] == [(*w[:2], n, w[2]) for w in want]
    assert np.allclose([r["whitened"] for r in rows], [w[3] for w in want], atol=closeness)
    assert np.allclose([r["explained"] for r in rows], [w[4] for w in want], rtol=1e-9)
    assert {r["identity_error"] for r in rows}.pop() < 1e-8


def test_query(spark, sf):
    vectors = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(queries.op11_lanczos_whiten(spark, sf), vectors, closeness=1e-7)


def test_known_spectrum_and_early_end(spark):
    """With a steep spectrum the steps end before they are as many as the entries, by the test of what they have not seen."""
    rng = np.random.default_rng(3)
    turn = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    data = rng.standard_normal((600, 40)) * 2.0 ** -np.arange(40) @ turn
    vectors = [(i, [float(c) for c in row]) for i, row in enumerate(data.astype(np.float32))]
    rows = whitening.whole_vectors(spark.createDataFrame(vectors, SCHEMA)).cache()
    found = whitening.spectrum(rows, k=4)
    assert found.steps < 40
    check(whitening.whiten(spark.createDataFrame(vectors, SCHEMA), k=4), vectors, k=4, closeness=1e-7)
    rows.unpersist()


def test_equal_variances_are_all_found(spark):
    """Equal variances: the steps exhaust what one start can reach and begin anew beside it."""
    vectors = [(2 * j + s, [(1 - 2 * s) * float(j == i) for i in range(6)]) for j in range(6) for s in (0, 1)]
    rows = whitening.whole_vectors(spark.createDataFrame(vectors, SCHEMA))
    found = whitening.spectrum(rows, k=6)
    assert np.allclose(found.variances, found.variances[0]) and len(found.variances) == 6
    assert np.allclose(found.components.T @ found.components, np.eye(6), atol=1e-12)
    error = {r["identity_error"] for r in whitening.whiten(spark.createDataFrame(vectors, SCHEMA), k=6).collect()}
    assert error.pop() < 1e-9


def test_fewer_components_than_asked_for(spark):
    vectors = [(i, [float(i), 2.0 * i, 5.0]) for i in range(20)]
    rows = whitening.whiten(spark.createDataFrame(vectors, SCHEMA)).collect()
    assert len(rows) == 20 and {r["component"] for r in rows} == {1} and abs(rows[0]["explained"] - 1) < 1e-12


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [(1, [0.5, 1.0]), (2, [0.25, -1.0]), (2, [0.25, -1.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, None), (6, [None, 1.0]), (7, [9.0]), (8, []), (9, [2.0, 0.125])]
    frame = spark.createDataFrame(vectors, SCHEMA).selectExpr("*", "1 AS x", "2 AS component", "3 AS n", "4 AS at")
    check(whitening.whiten(frame), vectors, k=2)
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, []), (2, None)], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(None, [1.0]), (None, [2.0])], SCHEMA)).count() == 2


def test_too_large_entries_raise(spark):
    with pytest.raises(ValueError, match="64 bits"):
        whitening.whiten(spark.createDataFrame([(1, [4e15]), (2, [-4e15]), (3, [0.0])], SCHEMA))
