import numpy as np
import pytest

from statkit.llm import components, near_dup, queries


def shingles(text, width):
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return {tuple(words[i : i + width]) for i in range(max(len(words) - width, 0) + 1)} if words else set()


def brute(rows, width, percent):
    sets = {i: shingles(t, width) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def result(frame):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in frame.collect()}


def test_query_equals_brute_force(spark, sf, docs):
    found = queries.op5_minhash_near_dedup(spark, sf).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute([d[:2] for d in docs], 3, 85)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


@pytest.mark.parametrize(("seed", "hot_size", "longest"), [(1, 256, 16), (2, 256, 16), (1, 4, 16), (2, 4, 3)])
def test_chains_and_hot_groups(spark, monkeypatch, seed, hot_size, longest):
    """Near copies in chains (neighbours alike, ends not), a large group round one text, and texts that share a band only.

    The same with nearly every bucket cut by rare shingles, their lists compared by pairs or in blocks.
    """
    monkeypatch.setattr(near_dup, "HOT", hot_size)
    monkeypatch.setattr(near_dup, "LIST", longest)
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(5000)]
    rows, base = [], list(rng.choice(vocabulary, 60))
    for i in range(60):  # a chain: a few words more differ at each step
        base = base[2:] + list(rng.choice(vocabulary, 2))
        rows.append(" ".join(base))
    hot = list(rng.choice(vocabulary, 80))
    for i in range(150):
        text = list(hot)
        for j in rng.integers(0, 80, rng.integers(0, 6)):
            text[j] = str(rng.choice(vocabulary))
        rows.append(" ".join(text))
    rows = [(int(i), t) for i, t in zip(rng.permutation(len(rows)), rows, strict=True)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(near_dup.near_duplicates(frame, 3, 85)) == brute(rows, 3, 85)


def test_blocks_of_many_chunks(spark, monkeypatch):
    """Short texts that share one frequent shingle, cut into many chunks; near ones are still found across chunks."""
    monkeypatch.setattr(near_dup, "BLOCK", 2048)
    rng = np.random.default_rng(11)
    rows = [(i, f"a b c {rng.integers(0, 10**6)}") for i in range(150)]
    rows += [(1000 + i, "a b c d e f g h i j k l m n o p q r s t u v w x y z " + " ".join(str(x) for x in rng.integers(0, 3, 2))) for i in range(40)]
    frame = spark.createDataFrame([(int(i), t) for i, t in rows], "doc_id long, text string")
    assert result(near_dup.near_duplicates(frame, 3, 85)) == brute(rows, 3, 85)


def test_linked_sets_share_a_code_of_their_prefixes():
    """Whatever the counters say, at similarities just at the threshold."""
    rng = np.random.default_rng(3)
    for percent in (80, 85, 100):
        for n in (1, 2, 7, 20, 100, 333):
            held = rng.integers(0, 9, 64)
            both = -(-percent * n // 100)
            codes = rng.integers(0, 1 << 63, n + n - both, dtype=np.uint64)
            a, b = np.sort(codes[:n]), np.sort(codes[n - both :])
            if 100 * both >= percent * (2 * n - both):
                assert set(near_dup.prefix(a, held, percent)) & set(near_dup.prefix(b, held, percent))
            small = np.sort(codes[n - both : n])  # a subset of a: similarity both / n
            assert set(near_dup.prefix(a, held, percent)) & set(near_dup.prefix(small, held, percent))


def test_unlike_documents_of_a_template_do_not_meet(spark):
    """20,000 documents in one bucket, a third of each its own: no pair but the planted near copies is compared."""
    rng = np.random.default_rng(4)
    common = " ".join(f"t{i}" for i in range(40))
    rows = [(i, common + " " + " ".join(f"v{x}" for x in rng.integers(0, 10**7, 20))) for i in range(20_000)]
    rows += [(100_000 + i, rows[i][1] + " end") for i in range(50)]
    texts = spark.createDataFrame(rows, "head long, body string")
    members = texts.selectExpr("7L AS band", "head", "58L AS size", "20050L AS n")
    none = spark.createDataFrame([], "node long, root long")
    lists = near_dup._rare_lists(members, none, texts, 3, 85)
    pairs = {(r["a"], r["b"]) for r in near_dup._list_pairs(lists).collect()}
    assert pairs >= {(i, 100_000 + i) for i in range(50)} and len(pairs) < 60
    assert lists.filter("n > 16").count() == 0


def test_odd_rows(odd, none):
    found = near_dup.near_duplicates(odd, 3, 85).collect()
    assert len(found) == odd.count() and near_dup.near_duplicates(none).count() == 0
    want = brute([(r["doc_id"], r["text"]) for r in odd.collect() if r["doc_id"] is not None], 3, 85)
    for r in found:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
    assert near_dup.drop_near_duplicates(odd, 3, 85).columns == odd.columns


def test_circulant_signature_estimates_similarity():
    rng = np.random.default_rng(5)
    for share in (0.2, 0.5, 0.9):
        common = rng.integers(0, 1 << 63, int(3000 * share), dtype=np.uint64)
        a, b = (np.concatenate([common, rng.integers(0, 1 << 63, 3000 - len(common), dtype=np.uint64)]) for _ in range(2))
        same = (near_dup.signature(a, 512) == near_dup.signature(b, 512)).mean()
        true = len(common) / (6000 - len(common))
        assert abs(same - true) < 0.09


def test_components(spark):
    rng = np.random.default_rng(7)
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 60)] + [(int(a), int(b)) for a, b in rng.integers(200, 400, (90, 2))] + [(5, 5)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r["node"]: r["root"] for r in components.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for n in got} and set(got) == {n for a, b in edges if a != b for n in (a, b)}


def test_long_texts_of_one_repeated_line(spark):
    """Their sets are small and their texts long: chunks are bounded by bytes, so that no block is large."""
    line = "the same line of some words again and again . "
    rows = [(i, line * 400 + f"end {i} of text {i % 7}") for i in range(600)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    weight = frame.selectExpr(f"greatest({near_dup.LEAST}, octet_length(text) div 8) AS w").agg({"w": "sum"}).first()[0]
    assert weight / near_dup.BLOCK > 15  # so many chunks if all stay in one bucket; 128 a text would be one
    got = result(near_dup.near_duplicates(frame, 3, 85))
    sets = {i: shingles(t, 3) for i, t in rows[:8]}
    alike = len(sets[0] & sets[1]) / len(sets[0] | sets[1]) >= 0.85
    assert not alike and got[0] == (len(sets[0]), 0) and len(got) == 600


def test_pairs_of_a_bucket_of_two_are_compared_in_full(spark):
    """No test of signatures stands before them: with an impossible one they are still found."""
    rows = [(1, " ".join(f"a{i}" for i in range(200))), (2, " ".join(f"a{i}" for i in range(195)))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {i for _, i in result(near_dup.near_duplicates(frame, 3, 85)).values()} == {1}


def test_word_codes_are_bounded():
    codes = near_dup.Words()
    for i in range(near_dup.Words.MOST + 10):
        codes[b"%d" % i]
    assert len(codes) <= near_dup.Words.MOST
    n = len(codes)
    codes[b"x" * 10_000]
    assert len(codes) == n and b"x" * 10_000 not in codes
