"""Decontamination against brute force over word lists, sets too large to broadcast, and what is cut out of texts."""

import hashlib
import re

import pytest

from statkit.llm import leaks, queries

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def expected(docs, items, width):
    grams = {}
    for item, text in items:
        ws = words(text)
        size = min(len(ws), width)
        for i in range(len(ws) - size + 1 if ws else 0):
            grams.setdefault(tuple(ws[i : i + size]), set()).add(item)
    out = []
    for doc_id, text in docs:
        ws, hit, found = words(text), set(), set()
        for size in {len(g) for g in grams}:
            for i in range(len(ws) - size + 1):
                if (g := tuple(ws[i : i + size])) in grams:
                    hit |= set(range(i, i + size))
                    found |= {str(x) for x in grams[g] if x is not None}
        out.append((doc_id, len(ws), len(hit), len(found), ",".join(sorted(found))))
    return sorted(out, key=str)


def result(frame):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], ",".join(r["items"])) for r in frame.collect()), key=str)


DOCS = [
    (1, "The quick, brown FOX jumps over the lazy dog. And more."), (1, "The quick, brown FOX jumps over the lazy dog. And more."), (2, "quick brown"), (3, None), (4, ""), (None, "lazy dog and more"),
    (5, "the quick brown fox jumps over the quick brown fox jumps over"), (6, "one word: École 42 École 42 x École 42 École"), (7, "nothing of the kind"), (8, "so it ends: the lazy dog"),
]
ITEMS = [(10, "quick brown fox jumps over"), (11, "Lazy dog"), (12, "42"), (13, None), (14, "..."), (15, "the quick brown fox"), (15, "brown fox jumps over the lazy"), (None, "of the kind"), (2, "lazy DOG")]


def frames(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").selectExpr("*", "1 AS words", "2 AS gram", "3 AS at", "4 AS hash", "5 AS items", "6 AS runs", "7 AS pieces")
    return docs, spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "1 AS words", "2 AS gram")


def test_query(spark, sf, docs):
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    want = expected([d[:2] for d in docs], items, 10)
    rows = queries.op12_decontaminate(spark, sf).collect()
    digest = lambda items: hashlib.sha256(items.encode()).hexdigest()
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in rows), key=str) == sorted(((*w[:4], digest(w[4]), w[2] > 0) for w in want), key=str)
    assert sum(r["contaminated"] for r in rows) > 0


@pytest.mark.parametrize("bytes_", [1 << 26, 0])
@pytest.mark.parametrize("width", [3, 10])
def test_small_and_large_sets(spark, monkeypatch, width, bytes_):
    """Short items of several sizes, overlapping places, repeated rows; a set over the limit is joined by a shuffle."""
    monkeypatch.setattr(leaks, "SET_BYTES", bytes_)
    docs, items = frames(spark)
    assert result(leaks.find_leaks(docs, items, width)) == expected(DOCS, ITEMS, width)


def test_odd_rows(spark, odd, none):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    items = spark.createDataFrame([(1, "w0 x0 w1 x1 w2 x2 w3 x3 w4 x4 w5"), (2, "two three four five six seven eight"), (3, "it s")], "item_id long, text string")
    listed = [tuple(r) for r in items.collect()]
    assert result(leaks.find_leaks(odd, items)) == expected(rows, listed, 10)
    empty = spark.createDataFrame([], "item_id long, text string")
    assert result(leaks.find_leaks(odd, empty)) == expected(rows, [], 10)
    assert leaks.find_leaks(none, items).count() == 0
    kept = leaks.remove_leaks(odd, items)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert leaks.remove_leaks(none, items).count() == 0 and leaks.remove_leaks(odd, empty).count() == odd.count()


def test_one_document_of_many_places(spark):
    text = " ".join("alpha beta gamma delta".split()[i % 4] for i in range(100_000))
    found = leaks.find_leaks(spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame([(1, "alpha beta gamma delta alpha")], "item_id long, text string"), 5).collect()
    assert found[0]["n_words"] == 100_000 and found[0]["n_hit"] == 99_997


def test_removal(spark):
    docs, items = frames(spark)
    cut = leaks.remove_leaks(docs, items)
    assert cut.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in cut.collect()), key=str)
    want = dict(DOCS) | {1: ". And more.", None: " and more", 5: "", 6: "one word: École École x École École", 7: "nothing", 8: "so it ends: the"}
    assert got == sorted(((i, want[i]) for i, _ in DOCS), key=str)
    whole = leaks.remove_leaks(docs, items, action="documents")
    assert sorted((r["doc_id"] for r in whole.collect()), key=str) == [2, 3, 4]
    some = leaks.remove_leaks(docs, items, action="documents", most=0.5)
    assert sorted((r["doc_id"] for r in some.collect()), key=str) == [2, 3, 4, 6, 8, None]
    with pytest.raises(ValueError, match="spans or documents"):
        leaks.remove_leaks(docs, items, action="other")
