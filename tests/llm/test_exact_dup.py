import hashlib

import pytest

from statkit.llm import exact_dup, queries


def expected(rows, largest):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = (max(known) if largest else min(known)) if known else None
        out += [(i, keep, len(ids), i == keep) for i in ids]
    return sorted(out, key=str)


def result(frame):
    return sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in frame.collect()), key=str)


def test_query(spark, sf, docs):
    rows = queries.op7_exact_dedup(spark, sf)
    assert result(rows) == expected([d[:2] for d in docs], True)
    digests = {d[0]: hashlib.sha256((d[1] or "").encode()).hexdigest() for d in docs}
    assert {r["doc_id"]: r["text_sha256"] for r in rows.collect()} == digests


@pytest.mark.parametrize("bits", [8, 256])
@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_collisions_fail_verification(spark, docs, keep, bits):
    """With 8-bit digests most hits are collisions; the answer stays the same."""
    rows = [d[:2] for d in docs]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(exact_dup.exact_duplicates(frame, keep, bits)) == expected(rows, keep == "largest")


def test_hot_group_is_salted(spark):
    rows = [(i, "the same text" if i % 3 else f"text {i}") for i in range(3000)]
    assert result(exact_dup.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), "smallest")) == expected(rows, False)


def test_odd_rows(odd, none):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert result(exact_dup.exact_duplicates(odd, "largest")) == expected(rows, True)
    assert exact_dup.exact_duplicates(none).count() == 0
    kept = exact_dup.drop_exact_duplicates(odd)
    assert kept.columns == odd.columns
    texts = [r["text"] or "" for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({t or "" for _, t in rows})


def test_index_takes_rows_in_turn(spark):
    """Runs are compacted level by level; a memtable's digests are tested against the runs' filters, and only runs with passing ones are read."""
    index, seen = exact_dup.Index(keep="smallest"), {}
    for turn in range(5):
        rows = [(1000 * turn + i, f"text {i if turn == 3 else (turn, i)}".encode()) for i in range(50)] + [(1000 * turn + 999, b"in every turn")]
        found = exact_dup.add(index, spark.createDataFrame(rows, "doc_id long, digest binary"))
        hits = {bytes(r["digest"]) for r in found.collect()}
        assert hits == {d for _, d in rows if d in seen}
        for i, d in rows:
            seen.setdefault(d, []).append(i)
        sizes = [[r.size for r in level] for level in index.levels]
        assert sum(map(len, sizes)) == bin(turn + 1).count("1")  # as the binary digits of the number of memtables
    assert index.compactions == 3 and len(index.levels) == 3
    assert index.tested == 51 * (1 + 1 + 2 + 1) and index.passed < index.tested / 4 and index.looked_up == 5
    every = spark.createDataFrame([(d,) for d in seen], "digest binary")
    got = {bytes(r["digest"]): (r["keep_id"], r["n"]) for r in exact_dup.resolved(index, every).collect()}
    assert got == {d: (min(ids), len(ids)) for d, ids in seen.items()}


def test_a_run_without_passing_digests_is_not_read(spark):
    index = exact_dup.Index()
    frame = lambda names: spark.createDataFrame([(i, n.encode()) for i, n in enumerate(names)], "doc_id long, digest binary")
    exact_dup.add(index, frame(f"a{i}" for i in range(20)))
    assert not exact_dup.add(index, frame(["b"])).take(1)
    assert (index.tested, index.looked_up, index.compactions) == (1, 0, 1)


def test_dropping_keeps_helper_names_and_repeated_rows(spark):
    rows = [(1, "a", 1), (1, "a", 1), (2, "a", 2), (None, "b", 3), (None, "b", 3), (3, "c", 4), (None, None, 5), (4, "", 6)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, digest int").withColumnsRenamed({}).selectExpr("*", "1 AS bucket", "2 AS bits", "3 AS key", "4 AS n")
    kept = exact_dup.drop_exact_duplicates(frame)
    assert kept.columns == frame.columns
    assert sorted(((r["doc_id"], r["text"], r["digest"]) for r in kept.collect()), key=str) == sorted([(1, "a", 1), (3, "c", 4), (None, "b", 3), (4, "", 6)], key=str)
