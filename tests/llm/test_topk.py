import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from statkit.llm import queries, topk


def brute(rows, k, wanted):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ok[i] = [math.floor(1024 * float(np.float32(x))) for x in v]
    out = []
    for q in filter(wanted, ok):
        best = sorted((-sum(a * b for a, b in zip(ok[q], ok[c], strict=True)), c) for c in ok if c != q)[:k]
        out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(best)]
    return sorted(out)


def test_query_equals_brute_force(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted(map(tuple, queries.op8_mtree_topk(spark, sf).collect())) == brute(rows, 10, lambda i: i % 100 == 0)


def test_ties_odd_rows_and_clusters(spark, monkeypatch):
    monkeypatch.setattr(topk, "TOPS", 4)
    monkeypatch.setattr(topk, "FAN", 3)
    monkeypatch.setattr(topk, "BLOCK", 4)
    monkeypatch.setattr(topk, "SAMPLE", 60)
    monkeypatch.setattr(topk, "PAGE", 16)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 5))
    rows = [(i, [float(x) for x in centres[i % 6] + 0.05 * rng.normal(size=5)]) for i in range(400)]
    rows += [(1000 + i, [0.5, 0.5, 0.5, 0.5, 0.5]) for i in range(30)]  # ties
    rows += [(2000, None), (2001, [1.0, None, 1.0, 1.0, 1.0]), (2002, [float("nan")] * 5), (2003, [float("inf")] + [0.0] * 4), (None, [1.0] * 5)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit("clash"))
    got = topk.top_k(frame, F.pmod(F.col("vec_id"), F.lit(50)) == 0, k=7)
    assert sorted(map(tuple, got.collect())) == brute(rows, 7, lambda i: i % 50 == 0)


def test_few_rows(spark):
    frame = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.0, -1.0]), (2, [3.0, 1.0])], "vec_id long, embedding array<float>")
    assert topk.top_k(frame, F.col("vec_id") == 0).count() == 2
    assert topk.top_k(frame.limit(0), F.col("vec_id") == 0).count() == 0


def test_rows_of_one_vec_id_and_unequal_lengths(spark):
    rows = [(0, [5.0, 5.0]), (0, [1.0, 1.0]), (7, [2.0]), (8, []), (9, [1.0, -1.0, 4.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    want = []
    full = [(i, [1024 * x for x in v] + [0.0] * (3 - len(v))) for i, v in rows]
    for n, (i, q) in enumerate(full):
        if i == 0:
            others = sorted((-int(np.dot(q, v)), c) for m, (c, v) in enumerate(full) if m != n)
            want += [(i, r + 1, c, -s) for r, (s, c) in enumerate(others)]
    got = topk.top_k(frame, F.col("vec_id") == 0, k=10)
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_most_pages_of_clustered_vectors_stay_unread(spark, monkeypatch):
    monkeypatch.setattr(topk, "PAGE", 20)
    monkeypatch.setattr(topk, "BLOCK", 8)
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(12, 6))
    centres *= 3 / np.sqrt((centres**2).sum(axis=1))[:, None]
    rows = [(i, [float(x) for x in centres[i % 12] + 0.02 * rng.normal(size=6)]) for i in range(1800)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    counts = {}
    got = topk.top_k(frame, F.pmod(F.col("vec_id"), F.lit(100)) == 0, k=5, counts=counts)
    assert sorted(map(tuple, got.collect())) == brute(rows, 5, lambda i: i % 100 == 0)
    assert counts["blocks"] > 1 and counts["pages"] > 60 * counts["blocks"] and counts["unread"] > 0.7 * counts["pages"]


def tree_of(x):
    tree = topk.grown(x[:40], 10**6)
    leaf = topk.distances(x, tree.leaves).argmin(axis=1)
    away = np.sqrt(((x - tree.leaves[leaf]) ** 2).sum(axis=1))
    for j in range(len(tree.leaves)):
        own = leaf == j
        if own.any():
            tree.low[j], tree.high[j], tree.norm[j] = away[own].min(), away[own].max(), np.sqrt((x[own] ** 2).sum(axis=1)).max()
    return tree, leaf


def test_descent_computes_few_distances_and_loses_nothing():
    rng = np.random.default_rng(4)
    centres = 40 * rng.normal(size=(10, 8))
    x, q = centres[rng.integers(0, 10, 800)] + rng.normal(size=(800, 8)), centres[:3] + rng.normal(size=(3, 8))
    tree, leaf = tree_of(x)
    scores = q @ x.T
    least = np.sort(scores, axis=1)[:, -5]
    to_leaf, done = topk.descended(tree, q, least)
    assert done < 0.5 * q.shape[0] * len(tree.leaves)
    for i, j in zip(*np.nonzero(scores >= least[:, None]), strict=True):
        assert np.isfinite(to_leaf[i, leaf[j]])


def test_a_page_is_passed_over_by_its_ring():
    rng = np.random.default_rng(4)
    x, q = rng.normal(size=(500, 8)) + 50, rng.normal(size=(3, 8)) - 50
    centre = x.mean(axis=0)
    away, to_leaf = (np.sqrt(((y - centre) ** 2).sum(axis=1)) for y in (x, q))
    best = topk.Best(3, 5, np.full(3, 0.0))
    assert topk.visit(best, q, np.arange(3), np.arange(500) + 10, np.arange(500) + 10, x, away, to_leaf) == 0


class Sent:
    def __init__(self, *value):
        self.value = value


def test_a_large_group_of_equal_vectors_is_cut_into_pages(monkeypatch):
    n, pages, scored = 5000, [], []
    visit, add = topk.visit, topk.Best.add
    monkeypatch.setattr(topk, "visit", lambda best, q, q_rows, ids, *a: (pages.append(len(ids)), visit(best, q, q_rows, ids, *a))[1])
    monkeypatch.setattr(topk.Best, "add", lambda self, q, ids, rows, scores: (scored.append(scores.shape), add(self, q, ids, rows, scores))[1])
    x = np.full((n, 2), [3.0, 4.0])
    tree = topk.grown(x[:5], 5000)
    tree.norm[:] = 5.0
    zeros = np.zeros(n, np.int64)
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(n)), pa.array(np.arange(n)), pa.array([[3, 4]] * n), pa.array(np.zeros(n)), pa.array(np.full(n, 5.0)), pa.array(zeros), pa.array(zeros)], names=["row", "vec_id", "v", "away", "norm", "page", "leaf"])
    q = np.full((3000, 2), [3.0, 4.0])
    (out,) = topk._searched(Sent(tree, q, np.full(3000, -np.inf), np.arange(3000), None), 2, topk.PAGE)(iter([batch]))
    got = sorted(zip(*(out.column(i).to_pylist() for i in (0, 1, 3)), strict=True))
    assert got == [(i, c, 25) for i in range(3000) for c in [c for c in range(3) if c != i][:2]]
    assert sum(pages) == n and max(pages) <= topk.PAGE
    assert max(a for a, _ in scored) <= 1024 and max(b for _, b in scored) <= topk.PAGE


def test_components_that_pass_exact_products_are_an_error(spark):
    import pytest

    frame = spark.createDataFrame([(1, [1e5, 1.0]), (2, [0.5, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="lower the scale"):
        topk.top_k(frame, F.col("vec_id") == 1)
