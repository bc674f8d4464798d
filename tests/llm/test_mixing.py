import re

from pyspark.sql import functions as F

from statkit.llm import mixing, queries


def targets(sizes, weights, share, most):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, out = share * sum(sizes.values()), {}
    free = set(order)
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > most * sizes[s]}
        if not over:
            return out | {s: weight[s] * level for s in free}
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
        free -= over
    return out


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(rows, source_of_rows):
    sizes = {}
    for source, text in source_of_rows:
        sizes[source] = sizes.get(source, 0) + words(text)
    want, taken = targets(sizes, queries.MIX_WEIGHTS, 1.5, 2.0), {}
    for r in rows:
        assert abs(r["target"] - want[r["source"]]) < 1e-6 * max(1, want[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s, n in taken.items():
        assert abs(n - want[s]) <= 1


def test_targets_and_words(spark, sf, docs):
    frame = spark.read.parquet(f"{sf}/documents.parquet")
    rows = mixing.pareto_mix(frame, queries.MIX_WEIGHTS).collect()
    assert {r["doc_id"]: r["size"] for r in rows} == {d[0]: words(d[1]) for d in docs}
    check(rows, [(d[3], d[1]) for d in docs])
    again = mixing.pareto_mix(frame.repartition(7), queries.MIX_WEIGHTS).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_odd_rows(spark, odd, none):
    rows = mixing.pareto_mix(odd, queries.MIX_WEIGHTS).collect()
    assert len(rows) == odd.count()
    check(rows, [(r["source"], r["text"]) for r in odd.collect()])
    assert mixing.pareto_mix(none, queries.MIX_WEIGHTS).count() == 0


def test_capped_sources_leave_their_excess(spark):
    frame = spark.createDataFrame([(i, s, "w " * n) for i, (s, n) in enumerate([("a", 1), ("b", 100), ("c", 10), (None, 1000)])], "doc_id int, source string, text string")
    check(mixing.pareto_mix(frame, queries.MIX_WEIGHTS).collect(), [(r["source"], r["text"]) for r in frame.collect()])


def test_whole_documents(spark, odd, sf):
    frame = spark.read.parquet(f"{sf}/documents.parquet")
    plan = {r["doc_id"]: r["copies"] for r in mixing.pareto_mix(frame, queries.MIX_WEIGHTS, partial=False).collect()}
    out = mixing.mixed_documents(frame, queries.MIX_WEIGHTS)
    got = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert got == {k: v for k, v in plan.items() if v} and out.columns == frame.columns
    assert mixing.mixed_documents(odd, queries.MIX_WEIGHTS).columns == odd.columns


def test_longer_documents_are_likelier(spark):
    frame = spark.createDataFrame([(i, "s", "w " * (1 if i % 2 else 64)) for i in range(2000)], "doc_id int, source string, text string")
    rows = mixing.pareto_mix(frame, [1.0], share=0.3).collect()
    rate = lambda n: sum(r["copies"] for r in rows if r["size"] == n) / 1000
    assert rate(64) > 3 * rate(1) > 0


def test_equal_rows_are_rows_of_their_own(spark):
    """400 rows that agree in everything: words taken equal the target, in the mix and in the documents it gives."""
    frame = spark.createDataFrame([(None, "s", "one two", 7)] * 400 + [(1, "t", "w " * 900, 8)], "doc_id long, source string, text string, box int")
    rows = mixing.pareto_mix(frame, [1.0, 10.0], share=0.7).collect()
    check_taken = sum(r["taken"] for r in rows if r["source"] == "s")
    target = next(r["target"] for r in rows if r["source"] == "s")
    assert 0 < target < 800 and abs(check_taken - target) <= 1 and len(rows) == 401
    out = mixing.mixed_documents(frame, [1.0, 10.0], share=0.7)
    assert out.columns == frame.columns
    assert abs(2 * out.filter("source = 's'").count() - target) <= 2 and out.filter("source = 's' and box <> 7").count() == 0


def test_inclusion_frequencies_and_certain_documents(spark):
    """Over many seeds a document is included as often as its p says; one whose share reaches a whole copy always is."""
    sizes = [1000] + [100] * 6 + [25] * 24
    frame = spark.createDataFrame([(i, "s", "w " * n) for i, n in enumerate(sizes)], "doc_id int, source string, text string").cache()
    seen = dict.fromkeys(range(len(sizes)), 0)
    for seed in range(12):
        for r in mixing.pareto_mix(frame, [1.0], share=0.72, most=2.0, seed=seed).collect():  # 1584 words for 2200: all 1000 are certain
            seen[r["doc_id"]] += r["taken"] / r["size"] / 12
    assert seen[0] == 1.0
    scale = (0.72 * sum(sizes) - 1000) / sum(n * n**0.5 for n in sizes[1:])
    mean = lambda n: sum(seen[i] for i, s in enumerate(sizes) if s == n) / sizes.count(n)
    assert abs(mean(100) - scale * 10) < 0.12 and abs(mean(25) - scale * 5) < 0.12


def test_many_sources_need_no_single_task(spark):
    frame = spark.range(300).selectExpr("cast(id AS int) AS doc_id", "concat('h', id % 97) AS source", "repeat('w ', cast(1 + id % 23 AS int)) AS text")
    check(mixing.pareto_mix(frame, queries.MIX_WEIGHTS).collect(), [(r["source"], r["text"]) for r in frame.collect()])


def test_places_of_very_many_sources(spark):
    """More sources than a range partitioning samples: each has the weight of its own place, so all targets are right."""
    sizes = {f"host-{i * 7919 % 30011}": 1 + i * 31 % 97 for i in range(30_000)} | {None: 50}
    frame = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long").repartition(8)
    want = targets(sizes, queries.MIX_WEIGHTS, 1.5, 2.0)
    got = {r["source"]: r["target"] for r in mixing.source_targets(frame, queries.MIX_WEIGHTS, 1.5, 2.0).collect()}
    assert set(got) == set(want) and all(abs(got[s] - want[s]) < 1e-6 * max(1, want[s]) for s in want)


def test_documents_that_share_a_key_are_told_apart(spark, monkeypatch):
    """With keys of two bits nearly all documents clash; each is still taken as often as it should be."""
    docs = [(i % 40 if i % 7 else None, " ".join(["word"] * (1 + i % 5)) + f" {i % 40}", "ab"[i % 2], i) for i in range(80)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string, other long")
    monkeypatch.setattr(mixing, "row_key", lambda: F.pmod(F.xxhash64("doc_id", "source", mixing.whole_text()), F.lit(4)))
    want = {}
    for r in mixing.pareto_mix(frame, [5.0, 2.0, 1.0], partial=False).collect():
        want[r["doc_id"], r["source"]] = want.get((r["doc_id"], r["source"]), 0) + r["copies"]
    got, texts = dict.fromkeys(want, 0), {(d[0], d[1], d[2]) for d in docs}
    for r in mixing.mixed_documents(frame, [5.0, 2.0, 1.0]).collect():
        assert (r["doc_id"], r["text"], r["source"]) in texts
        got[r["doc_id"], r["source"]] += 1
    assert got == want
