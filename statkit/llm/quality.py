"""Quality classification by co-training.

Two logistic classifiers look at different views of a document: its whole text (shares and counts of kinds of characters,
repetition, vocabulary) and its page metadata (source, language, length on record). They start from a bounded labelled
sample; in each round each view labels the documents of a bounded unlabelled pool that it ranks highest and lowest, in the
ratio of the classes, and these join the other view's training set. A pseudo-label is the view's calibrated probability
and weighs what that tells beyond the prior, so a view that knows little teaches little. Each view is calibrated on labelled documents in folds, by
classifiers that were not trained on them, and the calibrated log odds are added (less the prior's, which both hold). Every whole document is then scored in one pass without a shuffle.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import own_columns, stored, unit_hash

MARKS = [b"!", b"#", b"%$&*", b"|", b"?", b".,;:", b"0123456789", b"\n", b"()[]{}<>=_\\/~^@+", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"]
SOURCES, LANGS = 64, 16  #: hashed one-hot widths of the metadata view


def text_view(text: str | None) -> np.ndarray:
    """Features of a whole text; null and empty texts have the same."""
    data = (text or "").encode("utf-8", "surrogatepass")
    bytes_of = np.bincount(np.frombuffer(data, np.uint8), minlength=256) if data else np.zeros(256, np.int64)
    words = data.split()
    n, size = max(len(words), 1), max(len(data), 1)
    counts = np.array([bytes_of[list(m)].sum() for m in MARKS], float)
    common = Counter(words).most_common(1)[0][1] if words else 0
    again = sum(map(eq, words, words[1:]))
    lines = data.split(b"\n")
    more = np.array([1 - len(set(words)) / n, common / n, again / n, sum(map(len, words)) / n / 20, 1 - len(set(lines)) / len(lines)])
    return np.concatenate([np.log1p(1000 * counts / size), counts / size, np.log1p(counts), more, np.log1p(1000 * more), [np.log1p(len(words)), np.log1p(again), np.log1p(common)]])


def page_view(source: str | None, lang: str | None, n_chars: int | None) -> np.ndarray:
    """Features of a page's metadata; null has a place of its own."""
    out = np.zeros(SOURCES + LANGS + 4)
    out[0 if source is None else 1 + zlib.crc32(source.encode()) % (SOURCES - 1)] = 1
    out[SOURCES + (0 if lang is None else 1 + zlib.crc32(lang.encode()) % (LANGS - 1))] = 1
    size = np.log1p(max(n_chars or 0, 0))
    out[-4:] = (n_chars is None, size, size * size / 10, n_chars is not None and n_chars < 200)
    return out


def _views(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text, page = [], []
        for t, s, x, n in zip(batch.column("text"), batch.column("source").to_pylist(), batch.column("lang").to_pylist(), batch.column("n_chars").to_pylist(), strict=True):
            text.append(text_view(t.as_py()).tolist())
            page.append(page_view(s, x, n).tolist())
        yield pa.RecordBatch.from_arrays([batch.column("draw"), batch.column("quality"), pa.array(text, pa.list_(pa.float64())), pa.array(page, pa.list_(pa.float64()))], names=["draw", "quality", "text", "page"])


class Logistic:
    """Ridge logistic regression by Newton steps on standardised features."""

    def fit(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, weight: np.ndarray | None = None) -> Logistic:
        """y: labels or probabilities; weight: of each row, 1 if not given."""
        weight = np.ones(len(x)) if weight is None else weight
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        z = np.hstack([(x - self.mean) / self.scale, np.ones((len(x), 1))])
        w, penalty = np.zeros(z.shape[1]), np.full(z.shape[1], ridge)
        penalty[-1] = 1e-6
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            move = np.linalg.solve((z.T * (weight * p * (1 - p))) @ z + np.diag(penalty), z.T @ (weight * (y - p)) - penalty * w)
            w = w + move * min(1.0, 5 / (np.abs(move).max() + 1e-9))
            if np.abs(move).max() < 1e-6:
                break
        self.w = w
        return self

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -20, 20) @ self.w[:-1] + self.w[-1]


def told(p: np.ndarray, prior: float) -> np.ndarray:
    """What probabilities p tell beyond the prior: their divergence from it, in units of its entropy, at most 1."""
    p = np.clip(p, 1e-6, 1 - 1e-6)
    entropy = -(prior * np.log(prior) + (1 - prior) * np.log(1 - prior))
    return np.minimum((p * np.log(p / prior) + (1 - p) * np.log((1 - p) / (1 - prior))) / entropy, 1.0)


def cotrain(labelled: list, pool: list, rounds: int = 4, each: int = 200) -> dict | None:
    """The fitted views: rows are (draw, quality, text features, page features). None if there are not both labels.

    In each round a view labels `each` documents of the pool that it has not labelled yet, in the ratio of the classes.
    "given" in the result: of each round and view, how many it labelled good and bad.
    """
    rows = sorted(labelled, key=lambda r: r[0])
    y = np.array([float(r[1]) for r in rows])
    held = np.array([i % 4 == 3 for i in range(len(rows))], dtype=bool)
    if len(rows) < 8 or len(set(y[~held])) < 2 or len(set(y[held])) < 2:
        return None
    views = [np.array([r[2 + v] for r in rows]) for v in (0, 1)]
    pool = sorted(pool, key=lambda r: r[0])
    free = [np.array([r[2 + v] for r in pool]).reshape(len(pool), views[v].shape[1]) for v in (0, 1)]
    taken: list[dict[int, float]] = [{}, {}]  # by view: pool rows that the other one labelled, with its probability
    share = y.mean()

    def fitted(v: int, rows: np.ndarray) -> Logistic:
        """View v's classifier from the labelled rows and from what the other view labelled."""
        extra = list(taken[v])
        p = np.array([taken[v][i] for i in extra])
        x = np.vstack([views[v][rows], free[v][extra]])
        return Logistic().fit(x, np.concatenate([y[rows], p]), weight=np.concatenate([np.ones(rows.sum()), told(p, share)]))

    def calibrated(v: int, folds: list[np.ndarray]) -> Logistic:
        """The scale of view v's log odds, from rows that their classifier was not trained on."""
        raw = np.concatenate([fitted(v, ~fold).logit(views[v][fold]) for fold in folds])
        return Logistic().fit(raw[:, None], np.concatenate([y[fold] for fold in folds]), ridge=0.1)

    given = []
    for _ in range(rounds if len(pool) else 0):
        models, scales = [fitted(v, ~held) for v in (0, 1)], [calibrated(v, [held]) for v in (0, 1)]
        given.append([])
        for v in (0, 1):
            p = 1 / (1 + np.exp(-scales[v].logit(models[v].logit(free[v])[:, None])))
            order = [int(i) for i in np.argsort(p, kind="stable") if int(i) not in taken[1 - v]]
            n_bad = min(max(1, round(each * (1 - share))), len(order))
            n_good = min(max(1, each - n_bad), len(order) - n_bad)
            best = order[:n_bad] + order[len(order) - n_good :]
            taken[1 - v].update((i, float(p[i])) for i in best)
            given[-1].append((n_good, n_bad))
    folds = [np.arange(len(rows)) % 4 == k for k in range(4)]
    folds = folds if all(len(set(y[~fold])) == 2 for fold in folds) else [held]
    models = [fitted(v, np.ones(len(rows), dtype=bool)) for v in (0, 1)]
    return {"models": models, "scales": [calibrated(v, folds) for v in (0, 1)], "prior": np.log(share / (1 - share)), "given": given}


def _scored(model: dict | None, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if model is None or not n:
                logits = [np.full(n, 10.0)] * 2
                total = logits[0]
            else:
                at = {name: batch.column(batch.schema.get_field_index(name)) for name in ("text", "source", "lang", "n_chars")}
                text = np.array([text_view(t.as_py()) for t in at["text"]])
                page = np.array([page_view(*x) for x in zip(at["source"].to_pylist(), at["lang"].to_pylist(), at["n_chars"].to_pylist(), strict=True)])
                logits = [s.logit(m.logit(x)[:, None]) for m, s, x in zip(model["models"], model["scales"], (text, page), strict=True)]
                total = logits[0] + logits[1] - model["prior"]
            shown = [pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30)))) for z in (*logits, total)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *shown], names=[*batch.schema.names, *names])

    return run


def _score_columns(docs: DataFrame) -> list[str]:
    return own_columns(docs, "text_score", "page_score", "score")


def score_quality(docs: DataFrame, labels: DataFrame, sample: int = 6000, pool: int = 6000, seed: int = 9) -> DataFrame:
    """docs with three more columns at the end: text_score, page_score (the views' calibrated probabilities of good quality), score (combined).

    A name that docs has gets underscores before it. docs' own columns stay as they are.

    docs needs doc_id, text, source, lang and n_chars; labels needs doc_id and quality (0 or 1; null rows are not used).
    sample and pool: about so many labelled and unlabelled documents fit the classifiers (all, if fewer), drawn by a hash of
    doc_id, at rates from the numbers of labelled and unlabelled documents that docs has (labels of other ids do not count);
    their features (about 130 numbers a document) are gathered on the driver. With fewer than 8 labelled documents drawn, or
    without both labels in the part that fits or the part that calibrates (each fourth), nothing can be learned and every score is 1.

    Null text counts as empty; null source, lang and n_chars have features of their own. Null doc_id is scored, never
    sampled. Repeated rows are rows like any other; a doc_id with several labels has them all. An empty table gives no rows.
    """
    marks = labels.select(F.col("doc_id").alias("l_id"), F.col("quality").cast("double").alias("quality")).filter("l_id is not null and quality in (0, 1)").distinct()
    rows = docs.select("doc_id", "text", "source", "lang", F.col("n_chars").cast("long").alias("n_chars"), unit_hash(seed, F.col("doc_id")).alias("draw")).filter("doc_id is not null")
    # labels of documents that docs has, with the documents' number: identifiers only, no text
    ids = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    known = stored(marks.join(ids, F.col("l_id") == F.col("doc_id")).select("l_id", "quality", "n"), "known")
    sums = known.groupBy("l_id").agg(F.sum("n").alias("pairs"), F.max("n").alias("n")).agg(F.sum("pairs").alias("pairs"), F.sum("n").alias("n")).first()
    n_pairs, n_other = sums["pairs"] or 0, rows.count() - (sums["n"] or 0)
    # about `sample` ids: few enough to send to every task, so that no text is shuffled
    drawn = known.filter(unit_hash(seed, F.col("l_id")) * max(n_pairs, 1) < sample).select("l_id", "quality")
    first = rows.join(F.broadcast(drawn), F.col("doc_id") == F.col("l_id")).select("draw", "quality", "text", "source", "lang", "n_chars")
    other = rows.filter(unit_hash(seed + 1, F.col("doc_id")) * max(n_other, 1) < pool).join(known, F.col("doc_id") == F.col("l_id"), "left_anti")
    other = other.select("draw", F.lit(None).cast("double").alias("quality"), "text", "source", "lang", "n_chars")
    gathered = first.unionByName(other).mapInArrow(_views, "draw double, quality double, text array<double>, page array<double>")
    gathered = [tuple(r) for r in stored(gathered, "views").collect()]
    model = cotrain([r for r in gathered if r[1] is not None], [r for r in gathered if r[1] is None])
    schema = T.StructType([*docs.schema.fields, *[T.StructField(c, T.DoubleType()) for c in _score_columns(docs)]])
    return docs.mapInArrow(_scored(model, _score_columns(docs)), schema)


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.5, sample: int = 6000, pool: int = 6000) -> DataFrame:
    """docs without the rows whose combined score is below `least`; all columns of docs."""
    score = _score_columns(docs)[-1]
    return score_quality(docs, labels, sample, pool).filter(F.col(score) >= least).select(*[F.col(f"`{c}`") for c in docs.columns])
