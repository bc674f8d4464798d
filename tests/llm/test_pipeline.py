import corpus_pipeline
from statkit.llm import exact_dup, mixing, near_dup, packing, queries

from .test_near_dup import brute
from .test_packing import check_places


def test_stages_one_by_one(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").cache()
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf).cache()
        seen[name] = out
        if name != "pack":
            assert out.columns == docs.columns
            docs = out
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in seen["quality"].collect()}
    wrong = [i for i, q in labels.items() if (i in kept) != bool(q)]
    assert len(wrong) <= 0.1 * len(labels)
    exact = seen["exact_dedup"].collect()
    first = {}
    for r in seen["quality"].collect():
        first[r["text"]] = min(r["doc_id"], first.get(r["text"], r["doc_id"]))
    assert sorted(r["doc_id"] for r in exact) == sorted(first.values())
    want = brute([(r["doc_id"], r["text"]) for r in exact], 5, 80)
    assert {r["doc_id"] for r in seen["near_dedup"].collect()} == {i for i, (_, c) in want.items() if i == c}
    pieces = seen["pack"].collect()
    check_places(pieces)
    assert len({(r["doc_id"]) for r in pieces}) == seen["mix"].select("doc_id").distinct().count()
    copies = {r["doc_id"]: r["count"] for r in seen["mix"].groupBy("doc_id").count().collect()}
    assert {r["doc_id"]: sum(p["doc_id"] == r["doc_id"] and p["piece"] == 0 for p in pieces) for r in seen["mix"].select("doc_id").distinct().collect()} == copies


def test_run_and_names(spark, sf):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mix", "pack"]
    assert corpus_pipeline.run(spark, sf).columns == queries.op2_best_fit_pack(spark, sf).columns
    assert all(m for m in (exact_dup, mixing, near_dup, packing))
