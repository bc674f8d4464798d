"""Ids that stay, merged profiles and wide stars."""

import itertools
import random
import threading

import pytest
from pyspark.sql import functions as F

from statkit.operators import checks, lookup, registry, sketches


def ids(spark, path):
    rows = registry.entries(spark, path).collect()
    found = {r["key"]: r["id"] for r in rows}
    assert len(found) == len(rows) == len(set(found.values()))
    return found


def test_ids_stay_whatever_comes_later(spark, tmp_path):
    path, rng = str(tmp_path / "r"), random.Random(2)
    frame = lambda keys: spark.createDataFrame([(k,) for k in keys], "k string")
    first = [f"k{i}" for i in range(200)]
    assert registry.enter(frame([*first, *first, None]), path, "k") == 200
    had = ids(spark, path)
    more = [f"k{i}" for i in range(150, 320)]
    rng.shuffle(more)
    assert registry.enter(frame(more), path, "k") == 120 and registry.enter(frame(more[::-1]), path, "k") == 0
    now = ids(spark, path)
    assert len(now) == 320 and all(now[k] == i for k, i in had.items())
    facts = spark.createDataFrame([("k3", 1), ("unknown", 2), (None, 3)], "k string, n int")
    assert {r["n"]: r["id"] for r in registry.with_ids(facts, path, "k").collect()} == {1: now["k3"], 2: None, 3: None}


def test_two_writers_give_a_key_one_id(spark, tmp_path):
    path = str(tmp_path / "r")
    frames = [spark.createDataFrame([(f"k{i}",) for i in range(a, a + 60)], "k string") for a in (0, 30, 60)]
    threads = [threading.Thread(target=registry.enter, args=(f, path, "k")) for f in frames]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(ids(spark, path)) == 120


def test_merged_profiles_equal_that_of_the_union(spark):
    rows = [(i % 700, None if i % 5 == 0 else f"v{i % 31}", float(i), "2024-01-02") for i in range(3000)]
    frame = spark.createDataFrame(rows, "a long, b string, c double, d string")
    parts = [sketches.states(frame.filter(F.col("a") % 3 == r)) for r in range(3)]
    merged = {r["column"]: r.asDict() for r in sketches.shown(sketches.merged(sketches.union_all(parts))).collect()}
    whole = {r["column"]: r.asDict() for r in sketches.shown(sketches.states(frame)).collect()}
    exact = {r["column"]: r["values"] for r in sketches.exact_values(frame).collect()}
    assert exact == {"a": 700, "b": 31, "c": 3000, "d": 1}
    for c, want in whole.items():
        assert abs(merged[c].pop("values") - want.pop("values")) <= 0.01 * exact[c] + 1 and merged[c] == want
    assert [whole[c]["inferred"] for c in "abcd"] == ["integer", "text", "number", "date"]
    top = [(r["place"], r["value"], r["n"]) for r in sketches.frequent(frame, ["b"], most=2).orderBy("place").collect()]
    counts = sorted(((sum(r[1] == v for r in rows), v) for v in {r[1] for r in rows if r[1]}), key=lambda x: (-x[0], x[1]))
    assert top == [(i + 1, v, n) for i, (n, v) in enumerate(counts[:2])]


def test_profile_counts_distinct_values_exactly(spark):
    frame = spark.createDataFrame([(0.0, None), (-0.0, None), (1.5, None)], "x double, y string")
    found = {r["column"]: (r["values"], r["nulls"], r["inferred"]) for r in checks.profile(frame).collect()}
    assert found == {"x": (2, 0, "number"), "y": (0, 3, "empty")}
    none = sketches.shown(sketches.states(frame.limit(0))).collect()
    assert [(r["rows"], r["values"], r["inferred"]) for r in none] == [(0, 0, "empty")] * 2


@pytest.mark.parametrize("most", [20_000, 30, 0])
def test_wide_star_equals_single_joins(spark, monkeypatch, most):
    """Packed as a constant, partly packed, and all joined."""
    monkeypatch.setattr(lookup, "PACKED", most)
    dims = {"s": (spark.createDataFrame([(f"c{i}", f"small {i}") for i in range(20)], "key string, label string"), "key", "label"), "m": (spark.range(300).select("id", (F.col("id") * 2).alias("double")), "id", "double")}
    facts = spark.createDataFrame([(i, f"c{i % 25}" if i % 7 else None, i % 400) for i in range(500)], "i long, a string, b long").withColumns({"d": F.lit("c3"), "l": F.lit(1)})
    got = lookup.star(facts, dims, {"ra": ("a", "s"), "rb": ("b", "m"), "rd": ("d", "s")})
    assert got.columns == [*facts.columns, "ra", "rb", "rd"]
    for r in got.collect():
        assert r["ra"] == (f"small {r['i'] % 25}" if r["i"] % 7 and r["i"] % 25 < 20 else None) and r["rd"] == "small 3"
        assert r["rb"] == (str(2 * (r["i"] % 400)) if r["i"] % 400 < 300 else None)
    joins = got._jdf.queryExecution().optimizedPlan().toString().count("Join")
    assert joins == {20_000: 0, 30: 1, 0: 3}[most]
    twice = {"s": (spark.createDataFrame([("x", "1"), ("x", "2")], "key string, label string"), "key", "label")}
    with pytest.raises(ValueError, match="not unique"):
        lookup.star(facts, twice, {"r": ("a", "s")})
    with pytest.raises(ValueError, match="already"):
        lookup.star(facts, dims, {"a": ("a", "s")})


def test_morton_shards_are_spread(spark):
    shards = [r["shard"] for r in spark.range(2000).select(F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(registry.SHARDS)).alias("shard")).collect()]
    assert max(len(list(g)) for _, g in itertools.groupby(sorted(shards))) < 100


def test_editions_are_profiled_in_one_pass(spark):
    df = spark.range(300).select("id", F.col("id").cast("string").alias("v"), (F.col("id") % 3).alias("year"))
    found = sketches.states(df, ["id", "v"], by=["year"])
    assert found.count() == 6 and found.columns[:2] == ["year", "column"]
    for year in range(3):
        alone = sketches.states(df.filter(F.col("year") == year), ["id", "v"])
        assert sorted(map(tuple, sketches.shown(found.filter(F.col("year") == year)).collect())) == sorted(map(tuple, sketches.shown(alone).collect()))
