"""The manifest against a tree built in plain Python, for sizes around powers of two and for small bands."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from statkit.llm import merkle, queries


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def way(levels, i):
    """(sibling before, sibling after) from leaf i upwards."""
    out = []
    for level in levels[:-1]:
        out.append((level[i - 1] if i % 2 else "", level[i + 1] if not i % 2 and i + 1 < len(level) else ""))
        i //= 2
    return out


def expected(docs, tampered):
    """docs: (doc_id, text, lang, source, n_chars)."""
    fields = lambda d, more=0: (d[0], d[3], d[2], None if d[4] is None else d[4] + more, d[1])
    groups = {}
    for d in docs:
        groups.setdefault(d[2], []).append(d)
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    ranked = {g: sorted(groups[g], key=lambda d: (d[0] is not None, d[0] or 0, leaf(fields(d)))) for g in names}
    trees = [tree([leaf(fields(d)) for d in ranked[g]]) for g in names]
    top = tree([t[-1][0] for t in trees])
    root, out = top[-1][0], []
    for t, g in enumerate(names):
        for i, d in enumerate(ranked[g]):
            path = way(trees[t], i) + way(top, t)
            own = leaf(fields(d, 1)) if tampered(d[0]) else leaf(fields(d))
            for before, after in path:
                own = h(before, own, after)
            out.append((d[0], leaf(fields(d)), trees[t][-1][0], root, h(*[b + a for b, a in path]), own, own == root))
    return sorted(out, key=str)


def tampered(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0


def result(frame):
    return sorted((tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")) for r in frame.collect()), key=str)


def written(spark, rows, path):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.mode("overwrite").parquet(f"{path}/documents.parquet")
    return str(path)


def test_query(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    got = result(queries.op13_merkle_manifest(spark, sf))
    assert got == expected(docs, tampered)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("band", [1, 2, 10])
def test_bands_and_sizes(spark, tmp_path, monkeypatch, band):
    """Trees of 1 to 33 leaves in bands of few levels, so that they take several rounds; seven trees under the root."""
    monkeypatch.setattr(merkle, "BAND", band)
    sizes = {None: 1, "": 2, "a": 3, "b": 8, "c": 9, "d": 17, "é": 33}
    rows = [(1000 * g + i, f"text {i}", name, None if i % 3 else "s", i if i % 5 else None) for g, (name, n) in enumerate(sizes.items()) for i in range(n)]
    assert result(queries.op13_merkle_manifest(spark, written(spark, rows, tmp_path))) == expected(rows, tampered)


def test_odd_rows(spark, odd, none, tmp_path):
    rows = [tuple(r)[:5] for r in odd.collect()]
    assert result(queries.op13_merkle_manifest(spark, written(spark, rows, tmp_path))) == expected(rows, tampered)
    made = merkle.manifest(none)
    assert made.root is None and merkle.proofs(made).count() == 0 and merkle.nodes(made).count() == 0
    clash = odd.selectExpr("*", "1 AS name", "2 AS tree", "3 AS place", "4 AS rank", "5 AS load")
    assert merkle.manifest(clash).root.hex() == expected(rows, tampered)[0][3]


def test_nodes_are_nested_intervals(spark):
    rows = [(i, f"t{i}", "en", "s", i) for i in range(11)]
    made = merkle.manifest(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    found = sorted((r["level"], r["lo"], r["hi"], r["digest"].hex()) for r in merkle.nodes(made).collect())
    levels = tree([leaf((d[0], d[3], d[2], d[4], d[1])) for d in rows])
    assert found == [(k, i << k, min((i + 1) << k, 11), x) for k, level in enumerate(levels) for i, x in enumerate(level)]


def test_a_changed_text_is_not_verified(spark):
    rows = [(i, f"t{i}", "en" if i % 2 else "de", "s", i) for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    made = merkle.manifest(docs)
    rows = merkle.proofs(made).select(merkle.folded(F.col("path"), F.col("digest")).alias("own"), merkle.folded(F.col("path"), merkle.digest(F.lit("other"))).alias("other")).collect()
    assert all(bytes(r["own"]) == made.root and bytes(r["other"]) != made.root for r in rows)
