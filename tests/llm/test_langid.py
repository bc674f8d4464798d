import zlib

from pyspark.sql import functions as F

from statkit.llm import langid, queries


def test_held_out_accuracy_and_inputs(spark, sf, docs):
    rows = {r["doc_id"]: r for r in queries.op3_language_id(spark, sf).collect()}
    assert len(rows) == len(docs)
    right = []
    for doc_id, text, lang, _ in docs:
        r = rows[doc_id]
        assert r["held_out"] == (zlib.crc32(str(doc_id).encode()) % 4 == 2) and 0 <= r["score"] <= 1
        if r["held_out"] and lang:
            right.append(r["lang_pred"] == lang)
    assert len(right) > 30 and sum(right) / len(right) >= 0.95


def test_counts_equal_brute_force():
    text = "Ab, bé ab1ab"
    words, want = ["ab", "bé", "ab", "ab"], {}
    for w in words:
        padded = f" {w} "
        grams = [*w, *(padded[i : i + 2] for i in range(len(padded) - 1)), *(padded[i : i + 3] for i in range(len(padded) - 2))]
        for g in grams:
            code = 0
            for c in g:
                code = code * langid.BASE + ord(c)
            want[code] = want.get(code, 0) + 1
    grams, counts = langid.ngram_counts(text)
    assert dict(zip(grams.tolist(), counts.tolist(), strict=True)) == want


def test_odd_rows(spark, odd, none):
    from pyspark.sql import functions as F

    rows = langid.identify_languages(odd, F.col("doc_id") == 7).collect()
    assert len(rows) == odd.count()
    for r, o in zip(rows, odd.collect(), strict=True):
        assert (r["lang_pred"] == langid.UNKNOWN) == (not any(c.isalpha() for c in o["text"] or ""))
        assert r["held_out"] == (o["doc_id"] == 7)
    assert langid.identify_languages(none, F.lit(False)).count() == 0
    alone = langid.identify_languages(odd.filter("doc_id in (6, 7)").withColumn("lang", F.lit(None).cast("string")), F.lit(False)).collect()
    assert {r["lang_pred"] for r in alone} == {langid.UNKNOWN}


def brute_grams(text):
    """Counts of 1- to 3-grams of letters, words padded with a space; none across a break."""
    words, counts = "".join(c if c.isalpha() else " " for c in text.lower()).split(), {}
    for w in words:
        padded = f" {w} "
        for g in [*w, *(padded[i : i + 2] for i in range(len(padded) - 1)), *(padded[i : i + 3] for i in range(len(padded) - 2))]:
            counts[g] = counts.get(g, 0) + 1
    return counts


def brute_profile(counts, most):
    return sorted(counts, key=lambda g: (-counts[g], sum(ord(c) * langid.BASE**i for i, c in enumerate(reversed(g)))))[:most]


def test_predictions_equal_brute_force(spark, docs):
    """Profiles, ranks, out-of-place distances and scores, n-gram by n-gram."""
    from pyspark.sql import functions as F

    rows = [(d[0], (d[1] or "")[:2000] if d[1] is not None else None, d[2]) for d in docs[:60]]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify_languages(frame, F.pmod("doc_id", F.lit(4)) == 2, most=50).collect()}
    sums = {}
    for doc_id, text, lang in rows:
        if lang is not None and text is not None and doc_id % 4 != 2:
            for g, n in brute_grams(text).items():
                sums.setdefault(lang, {})[g] = sums.get(lang, {}).get(g, 0) + n
    profiles = {lang: {g: i for i, g in enumerate(brute_profile(c, 50))} for lang, c in sums.items()}
    for doc_id, text, _ in rows:
        own = brute_profile(brute_grams(text or ""), 50)
        if not own:
            assert got[doc_id][0] == langid.UNKNOWN
            continue
        away = sorted((sum(abs(p[g] - i) if g in p else 50 for i, g in enumerate(own)), lang) for lang, p in profiles.items())
        assert got[doc_id][0] == away[0][1] and abs(got[doc_id][1] - (1 - away[0][0] / max(away[1][0], 1))) < 1e-9


def test_a_column_that_names_no_languages_is_an_error(spark, monkeypatch):
    import pytest

    monkeypatch.setattr(langid, "LANGUAGES", 5)
    frame = spark.createDataFrame([(i, "some words of a text", f"lang{i}") for i in range(6)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="6 values of lang"):
        langid.identify_languages(frame, F.lit(False))
