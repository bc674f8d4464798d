"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

The centred rows X (n rows, d columns) stay distributed; what is kept on the driver is d x d at most. A step takes the right
vector v, forms u ~ Xv and then X'u, both block by block in one pass: since X'U of the earlier left vectors is known, what v
has of them is known before the pass, so u is made orthogonal to them in it. Left vectors are never stored: each is X times
a vector of d numbers, and is formed again where it is needed. Both sides are reorthogonalised in full. The singular values
of the small bidiagonal matrix, over the square root of n, are the deviations, and its right vectors give the components.

It ends when the wanted components have converged and all that the steps have not seen (the trace less the squares of the
bidiagonal matrix) is less than the least of them, so that none of equal or larger variance can have been missed; at the
latest after d steps.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored

SCALE, SHIFT = 1024, 100_000
BLOCK = 1 << 19  #: numbers of a block of rows that one product takes
NOTHING = 1e-10  #: a singular value below this share of the whole is none
EVERY = 8  #: steps between two tests of convergence


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x): x the floors of 1024 times each entry, plus 100,000, as longs; without null vectors and those with a null or non-finite entry."""
    entry = F.transform("embedding", lambda c: c.cast("double"))
    usable = F.col("embedding").isNotNull() & ~F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    return embeddings.select("vec_id", F.when(usable, F.transform(entry, lambda c: F.floor(c * SCALE).cast("long") + SHIFT)).alias("x")).filter("x is not null")


def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    rows = max(1, BLOCK // d)
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part, part.column(part.schema.get_field_index("x")).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _total(rows: DataFrame, d: int, work: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """The sum of work(block) over all blocks of rows: a partition gives one vector of a bounded length, and these are summed by place."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _blocks(batches, d):
            total = work(x) if total is None else total + work(x)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["at", "value"])

    sums = rows.mapInArrow(task, f"at int, value {kind}").groupBy("at").agg(F.sum("value").alias("value")).collect()
    return np.array([r["value"] for r in sorted(sums)])


@dataclass
class Spectrum:
    """What whitening needs: n rows of d entries with sums per entry, the trace, and the components as columns with their variances, falling."""

    n: int
    d: int
    sums: np.ndarray
    trace: float
    variances: np.ndarray
    components: np.ndarray
    steps: int = 0

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.n * x - self.sums) / self.n


def bidiagonalised(rows: DataFrame, s: Spectrum, k: int, seed: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(singular values, right vectors as columns, steps): the k largest of the centred rows, without those that are nothing."""
    d, whole = s.d, np.sqrt(s.trace * s.n)
    rng = np.random.default_rng(seed)
    right, left, back = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((d, 0))  # V; P with U = XP; X'U
    alphas: list[float] = []
    betas: list[float] = []

    def orthogonal(w: np.ndarray) -> np.ndarray:
        for _ in range(2):
            w = w - right @ (right.T @ w)
        return w

    def fresh() -> np.ndarray:
        w = orthogonal(rng.standard_normal(d))
        return w / np.linalg.norm(w)

    def pass_over(p: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        def work(x: np.ndarray) -> np.ndarray:
            c = s.centred(x)
            u = c @ p
            return np.concatenate([c.T @ u, (c @ others).T @ u, [u @ u]])

        t = _total(rows, d, work)
        return t[:d], t[d:-1], float(t[-1])

    v = fresh()
    while True:
        known = back.T @ v  # U'Xv, known without a pass
        p = v - left @ known
        xu, rest, square = pass_over(p, left)
        p, xu, square = p - left @ rest, xu - back @ rest, square - float(rest @ rest)
        alpha = float(np.sqrt(max(square, 0.0)))
        if alpha <= NOTHING * whole:  # Xv lies in the span of the earlier left vectors
            alpha, p, xu = 0.0, np.zeros(d), np.zeros(d)
        else:
            p, xu = p / alpha, xu / alpha
        right, left, back = np.column_stack([right, v]), np.column_stack([left, p]), np.column_stack([back, xu])
        alphas.append(alpha)
        j = len(alphas)
        w = orthogonal(xu - alpha * v)
        beta = float(np.linalg.norm(w))
        beta = beta if beta > NOTHING * whole else 0.0
        done = j == d
        if done or j % EVERY == 0 or not beta:
            small = np.diag(alphas) + np.diag(betas, 1)
            z, sigma, vt = np.linalg.svd(small)
            unseen = max(whole**2 - float((sigma**2).sum()), 0.0)
            first = sigma[:k]
            done = done or unseen < NOTHING**2 * whole**2 or (j >= k and np.all(beta * np.abs(z[-1, :k]) <= 1e-15 * sigma[0]) and unseen < first[-1] ** 2 * (1 - 1e-9))
            if done:
                kept = first > 10 * NOTHING * whole
                return first[kept], right @ vt[:k][kept].T, j
        v = w / beta if beta else fresh()
        betas.append(beta)


def spectrum(rows: DataFrame, k: int = 8, seed: int = 7) -> Spectrum | None:
    """The k first components of rows (x: array of longs); None without rows or entries. Only vectors of the greatest length count."""
    d = rows.agg(F.max(F.size("x"))).first()[0]
    if not d:
        return None
    rows = rows.filter(F.size("x") == d).select("x")
    n, most = rows.agg(F.count(F.lit(1)), F.max(F.greatest(F.abs(F.array_max("x")), F.abs(F.array_min("x"))))).first()
    if n * most >= 1 << 62:
        raise ValueError(f"{n} vectors with entries up to {most} pass what whole numbers of 64 bits hold")
    sums = _total(rows, d, lambda x: x.sum(axis=0), "long")
    found = Spectrum(n, d, sums, 0.0, np.zeros(0), np.zeros((d, 0)))
    found.trace = float(_total(rows, d, lambda x: np.array([np.square(found.centred(x)).sum()]))[0]) / n
    if found.trace:
        sigma, vectors, found.steps = bidiagonalised(rows, found, k, seed)
        signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
        found.variances, found.components = sigma**2 / n, vectors * signs
    return found


def whiten(embeddings: DataFrame, k: int = 8, seed: int = 7) -> DataFrame:
    """A row for each usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    embeddings needs vec_id and embedding. Components are numbered from 1 by falling variance; there are fewer than k where
    the vectors have no more variance than that (none if all are equal: no rows). deviation: the exact sum of (n x - S)^2
    over the entries, S being the entry's sum over all n vectors. identity_error: how far the whitened rows' covariance is
    from the identity at most.

    Null vectors and those with a null or non-finite entry take no part, nor do vectors shorter than the longest. Null
    vec_id and repeated rows are rows like any other. Of equal variances any orthogonal components are right. An empty table
    gives no rows. Sums that whole numbers of 64 bits do not hold raise an error.
    """
    rows = stored(whole_vectors(embeddings), "vectors")
    s = spectrum(rows, k, seed)
    out = T.StructType([T.StructField("vec_id", rows.schema["vec_id"].dataType)]).add("component", "integer").add("n", "long").add("deviation", "long").add("whitened", "double").add("explained", "double").add("identity_error", "double")
    if s is None or not len(s.variances):
        return rows.sparkSession.createDataFrame([], out)
    found, d = len(s.variances), s.d
    turn = s.components / np.sqrt(s.variances)

    def second(x: np.ndarray) -> np.ndarray:
        w = s.centred(x) @ turn
        return np.concatenate([(w.T @ w).ravel(), w.sum(axis=0)])

    rows = rows.filter(F.size("x") == d)
    moments = _total(rows, d, second) / s.n
    mean = moments[found * found :]
    error = float(np.abs(moments[: found * found].reshape(found, found) - np.outer(mean, mean) - np.eye(found)).max())
    explained = s.variances / s.trace

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches, d):
            off = s.n * x - s.sums
            if (off.astype(float) ** 2).sum(axis=1).max() >= 2.0**63:
                raise ValueError("a deviation passes what whole numbers of 64 bits hold")
            m = len(x)
            columns = [
                part.column("vec_id").take(pa.array(np.repeat(np.arange(m), found))), pa.array(np.tile(np.arange(1, found + 1, dtype=np.int32), m)),
                pa.array(np.full(m * found, s.n)), pa.array(np.repeat(np.square(off).sum(axis=1), found)), pa.array(((off / s.n) @ turn).ravel()),
                pa.array(np.tile(explained, m)), pa.array(np.full(m * found, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, out.names)

    return rows.mapInArrow(task, out)
