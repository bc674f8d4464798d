import math

import numpy as np
from pyspark.sql import functions as F

from statkit.llm import quality, queries


def test_labelled_documents(spark, sf):
    rows = {r["doc_id"]: r for r in queries.op9_cotrain_quality(spark, sf).collect()}
    labels = [tuple(r) for r in spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality").collect()]
    right = [rows[i]["kept"] == bool(q) for i, q in labels if i in rows]
    assert sum(right) / len(right) >= 0.9
    assert all(0 <= rows[i][c] <= 1 for i in rows for c in ("text_score", "page_score", "score"))


def test_unseen_documents(spark):
    """Fitted on one half of the labelled documents, it tells most of the other half's junk and keeps the rest."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    scored = quality.score_quality(docs, labels.filter("doc_id % 2 = 0")).join(labels.filter("doc_id % 2 = 1").withColumnRenamed("doc_id", "i"), F.col("doc_id") == F.col("i"))
    rows = scored.select("quality", "score").collect()
    assert len(rows) > 100
    good, bad = ([r["score"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert sum(s >= 0.5 for s in good) / len(good) >= 0.97 and sum(s < 0.5 for s in bad) / len(bad) >= 0.6


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 10)] + [(None, 1), (3, None)], "doc_id long, quality int")
    assert quality.score_quality(odd, labels).count() == odd.count()
    assert quality.score_quality(odd, labels.limit(0)).filter("score < 0.99").count() == 0
    assert quality.keep_good(odd, labels.limit(0)).columns == odd.columns
    assert quality.score_quality(none, labels).count() == 0


def test_labels_of_foreign_ids_do_not_change_the_samples(spark, monkeypatch):
    docs = spark.range(2000).selectExpr("id AS doc_id", "concat('text ', id) AS text", "'a' AS source", "'en' AS lang", "10L AS n_chars")
    labels = spark.range(400).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS quality").union(spark.range(10**6, 10**6 + 20_000).selectExpr("id", "cast(id % 2 AS int)"))
    seen = []
    monkeypatch.setattr(quality, "cotrain", lambda labelled, pool: seen.append((len(labelled), len(pool))))
    quality.score_quality(docs, labels, sample=200, pool=200)
    (labelled, pool), = seen
    assert 140 <= labelled <= 260 and 140 <= pool <= 260


def brute_cotrain(labelled, pool, rounds, each):
    """The rounds, row by row, with a plain solver; returns the final scores of the pool."""

    def fit(rows, ys, ws, ridge):
        n = len(rows[0])
        mean = [sum(r[j] for r in rows) / len(rows) for j in range(n)]
        dev = [(sum((r[j] - mean[j]) ** 2 for r in rows) / len(rows)) ** 0.5 + 1e-6 for j in range(n)]
        z = [[(r[j] - mean[j]) / dev[j] for j in range(n)] + [1.0] for r in rows]
        w = [0.0] * (n + 1)
        for _ in range(400):  # Newton steps
            h = np.diag([ridge] * n + [1e-6])
            g = np.array([-ridge * v for v in w[:-1]] + [-1e-6 * w[-1]])
            for row, y, weight in zip(z, ys, ws, strict=True):
                p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(row, w, strict=True))))
                g = g + weight * (y - p) * np.array(row)
                h = h + weight * p * (1 - p) * np.outer(row, row)
            move = np.linalg.solve(h, g)
            w = [a + b for a, b in zip(w, move, strict=True)]
            if max(abs(move)) < 1e-9:
                break
        return lambda r: sum(a * max(-20, min(20, (x - m) / d)) for a, x, m, d in zip(w, r, mean, dev)) + w[-1]

    labelled, pool = sorted(labelled), sorted(pool)
    prior = sum(r[1] for r in labelled) / len(labelled)
    got = {0: {}, 1: {}}
    sigmoid = lambda x: 1 / (1 + math.exp(-x))

    def view(v, train):
        ws = [1.0] * len(train)
        for p in got[v].values():
            kl = p * math.log(p / prior) + (1 - p) * math.log((1 - p) / (1 - prior))
            ws.append(min(1.0, kl / -(prior * math.log(prior) + (1 - prior) * math.log(1 - prior))))
        return fit([r[2 + v] for r in train] + [pool[i][2 + v] for i in got[v]], [r[1] for r in train] + list(got[v].values()), ws, 1.0)

    def scaled(v, folds):
        raw, ys = [], []
        for k in folds:
            score = view(v, [r for i, r in enumerate(labelled) if i % 4 != k])
            raw += [[score(r[2 + v])] for i, r in enumerate(labelled) if i % 4 == k]
            ys += [r[1] for i, r in enumerate(labelled) if i % 4 == k]
        return fit(raw, ys, [1.0] * len(ys), 0.1)

    for _ in range(rounds):
        score = {}
        for v in (0, 1):
            raw, scale = view(v, [r for i, r in enumerate(labelled) if i % 4 != 3]), scaled(v, [3])
            score[v] = [sigmoid(scale([raw(r[2 + v])])) for r in pool]
        for v in (0, 1):
            order = sorted((i for i in range(len(pool)) if i not in got[1 - v]), key=lambda i: (score[v][i], i))
            bad = max(1, round(each * (1 - prior)))
            got[1 - v].update((i, score[v][i]) for i in order[:bad] + order[len(order) - (each - bad) :])
    total = [-math.log(prior / (1 - prior))] * len(pool)
    for v in (0, 1):
        raw, scale = view(v, labelled), scaled(v, range(4))
        total = [t + scale([raw(r[2 + v])]) for t, r in zip(total, pool, strict=True)]
    return [sigmoid(t) for t in total]


def sample_rows(n, seed, labels=True):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        good = rng.random() < 0.7
        rows.append((float(rng.random()), float(good) if labels else None, list(rng.normal(0.9 * good, 1, 2)), list(rng.normal(0.9 * good, 1, 3)), good))
    return rows


def test_rounds_equal_brute_force():
    labelled, pool = [r[:4] for r in sample_rows(40, 1)], [r[:4] for r in sample_rows(60, 2, False)]
    model = quality.cotrain(labelled, pool, rounds=2, each=10)
    text, page = (np.array([r[i] for r in sorted(pool)]) for i in (2, 3))
    total = sum(s.logit(m.logit(x)[:, None]) for m, s, x in zip(model["models"], model["scales"], (text, page), strict=True)) - model["prior"]
    assert np.abs(1 / (1 + np.exp(-total)) - brute_cotrain(labelled, pool, 2, 10)).max() < 1e-3


def test_both_views_teach_and_count():
    """Each view gives labels in each round; without the other view's labels, or without either view, scores differ."""
    labelled, pool = [r[:4] for r in sample_rows(60, 3)], [r[:4] for r in sample_rows(400, 4, False)]
    blank = lambda rows, v: [tuple([0.0] * len(x) if i == 2 + v else x for i, x in enumerate(r)) for r in rows]

    def scores(labelled, pool, rounds=3):
        model = quality.cotrain(labelled, pool, rounds=rounds, each=20)
        assert len(model["given"]) == rounds and all(good > 0 and bad > 0 for turn in model["given"] for good, bad in turn)
        ratio = model["given"][0][0][0] / 20 if rounds else 0.7
        assert 0.5 < ratio < 0.9
        x = [np.array([r[i] for r in pool]) for i in (2, 3)]
        return sum(s.logit(m.logit(v)[:, None]) for m, s, v in zip(model["models"], model["scales"], x, strict=True)) - model["prior"]

    full = scores(labelled, pool)
    others = [scores(labelled, pool, 0), scores(blank(labelled, 0), blank(pool, 0)), scores(blank(labelled, 1), blank(pool, 1))]
    assert all(np.abs(full - o).max() > 0.05 for o in others)
    truth = np.array([r[4] for r in sample_rows(400, 4, False)])
    right = lambda s: ((s > 0) == truth).mean()
    assert right(full) > max(right(others[1]), right(others[2]))
