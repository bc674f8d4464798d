import zlib

import numpy as np
from tokenizers import Tokenizer

from statkit.llm import packing, queries


def expected(texts, most=2048):
    whole, out = Tokenizer.from_file(packing.vocabulary_path()), []
    for doc_id, text in texts:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        out += [(doc_id, k, a, len(ids[a : a + most]), zlib.crc32(ids[a : a + most].tobytes())) for k, a in enumerate(range(0, len(ids), most))]
    return sorted(out, key=str)


def fields(rows):
    return sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows), key=str)


def check_places(rows, most=2048):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= most
    return len(by)


def test_query_equals_whole_tokenizer_and_is_tight(spark, sf, docs):
    rows = queries.op2_best_fit_pack(spark, sf).collect()
    assert fields(rows) == expected([d[:2] for d in docs])
    least = -(-sum(r["length"] for r in rows) // 2048)
    assert check_places(rows) <= least * 1.01 + 1


def test_odd_rows(odd, none):
    rows = packing.pack(odd, capacity=64, rounds=20).collect()
    assert fields(rows) == expected([(r["doc_id"], r["text"]) for r in odd.collect()], 64)
    check_places(rows, 64)
    assert packing.pack(none).count() == 0


def test_odd_characters_equal_whole_tokenizer():
    own, whole = packing.WordTokenizer(packing.vocabulary_path()), Tokenizer.from_file(packing.vocabulary_path())
    texts = ["", " ", "it's I'LL don't 's", "a_b __ -- 1234 3.5e-7", "ªº µ ÿ ẞ ß", "é ́x", "a\x1cb", "x y z\x85w", "日本語 текст Ωσς ΣΑΣ", "<|endoftext|> <| |>", "²³ ¼", "İI ı", "\U0001f600 :-)", "a" * 3000, "\x00\x07 ﻿", "..a..b..", "ǅ ŉ ﬁ"]
    for text in texts:
        assert own(text) == np.array(whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes(), repr(text)


def test_knapsack_is_optimal_on_small_cases():
    rng = np.random.default_rng(1)
    for _ in range(20):
        prices = np.where(rng.random(9) < 0.5, rng.random(9), 0.0)
        best = {0: 0.0}
        for c in range(1, 13):
            best[c] = max([best[c - 1], *(best[c - n] + prices[n - 1] for n in range(1, 10) if n <= c)])
        got = packing.best_configuration(prices, 12)
        assert (got * np.arange(1, 10)).sum() <= 12
        assert abs((got * prices).sum() - best[12]) < 1e-9


def test_runs_place_every_piece_once():
    rng = np.random.default_rng(2)
    for _ in range(10):
        counts = rng.integers(0, 50, 40) * (rng.random(40) < 0.6)
        runs = packing.solve(counts.astype(np.int64), 40, 30)
        placed = np.zeros(40, dtype=int)
        for many, shape in runs:
            assert sum(n * k for n, k in shape) <= 40
            for n, k in shape:
                placed[n - 1] += many * k
        assert (placed == counts).all()


def test_sequences_hold_the_pieces_ids(spark):
    frame = spark.createDataFrame([(i, f"word{i} and more " * (i % 7)) for i in range(40)], "doc_id long, text string")
    rows = packing.pack(frame, capacity=32, rounds=20, with_ids=True)
    whole = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(rows).collect()}
    for r in rows.collect():
        assert whole[r["sequence_id"]][4 * r["offset"] : 4 * (r["offset"] + r["length"])] == bytes(r["ids"])


def test_word_caches_are_bounded(monkeypatch):
    monkeypatch.setattr(packing, "WORDS", 50)
    own, whole = packing.WordTokenizer(packing.vocabulary_path()), Tokenizer.from_file(packing.vocabulary_path())
    text = " ".join(f"w{i}x" for i in range(300)) + " " + " ".join("Ab9" * 4000 + str(i) for i in range(3))
    assert own(text) == np.array(whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
    kept = [*own.young, *own.old]
    assert len(own.old) <= 60 and max(map(len, kept)) <= packing.LONG


def test_one_length_holds_nearly_all_pieces(spark, monkeypatch):
    """Pieces of one length are ranked by tasks of a bounded number of rows, also where rows repeat without an id; full pieces need no rank."""
    monkeypatch.setattr(packing, "SALT_ROWS", 20)
    assert list(packing.salts_of(np.array([0, 1, 20, 21, 4000]))) == [1, 1, 1, 2, 200]
    texts = [(None, "the same text")] * 600 + [(i, "one more text") for i in range(300)] + [(1000 + i, "a long text of many words " * 9) for i in range(5)]
    rows = packing.pack(spark.createDataFrame(texts, "doc_id long, text string"), capacity=16, rounds=20).collect()
    assert fields(rows) == expected(texts, 16)
    assert check_places(rows, 16) <= -(-sum(r["length"] for r in rows) // 16) * 1.4
    full = [r["sequence_id"] for r in rows if r["length"] == 16]
    assert len(full) == len(set(full)) > 0 and not set(full) & {r["sequence_id"] for r in rows if r["length"] < 16}
