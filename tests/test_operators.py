"""Policies, failures and writers that the queries do not reach."""

import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from statkit.operators import checks, indicators, loads, lookup, ranking, rates, reshape, shared
from statkit.sources import editions, files


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_lookup_policies(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "x"), (3, None)], "id int, code string")
    dim = spark.createDataFrame([("a", "Alpha")], "code string, label string")
    assert rows(lookup.lookup(facts, dim, ["code"], {"label": "l"})) == [(1, "a", "Alpha"), (2, "x", None), (3, None, None)]
    assert rows(lookup.lookup(facts, dim, ["code"], {"label": "l"}, "drop")) == [(1, "a", "Alpha")]
    with pytest.raises(lookup.UnmatchedKeys, match="x"):
        lookup.lookup(facts, dim, ["code"], {"label": "l"}, "raise")


def test_a_dimension_of_many_rows_is_not_broadcast(spark, sf, monkeypatch):
    """By its file's size it would be; the driver would hold all its rows."""
    from statkit.plans import loading, registry

    plan = lambda d: d._jdf.queryExecution().optimizedPlan().toString()
    small = registry.QUERIES["staged_load"](spark, sf)
    monkeypatch.setattr(lookup, "SMALL", 10)
    large = registry.QUERIES["staged_load"](spark, sf)
    assert loading and "strategy=merge" not in plan(small) and plan(large).count("strategy=merge") == 3
    assert rows(large) == rows(small)


def test_level_split_fails_on_gaps(spark):
    df = spark.createDataFrame([(1,), (5,)], "a int")
    with pytest.raises(ValueError, match="no level"):
        reshape.split_levels(df, {"low": F.col("a") < 3})
    with pytest.raises(ValueError, match="several"):
        reshape.split_levels(df, {"low": F.col("a") < 9, "high": F.col("a") > 3})


def test_null_sums_and_zero_denominators(spark):
    df = spark.createDataFrame([("a", None, 0), ("b", 2.0, 4)], "k string, v double, n int")
    out = df.groupBy("k").agg(rates.total(F.col("v")).alias("zero"), rates.total(F.col("v"), 1).alias("null"), rates.ratio(F.sum("v"), F.sum("n")).alias("r"))
    assert rows(out) == [("a", 0.0, None, None), ("b", 2.0, 2.0, 0.5)]


def test_upsert_with_null_keys_and_repeated_rows(spark):
    target = spark.createDataFrame([(1, "a", "x"), (None, "n", "y")], "k int, v string, w string")
    new = spark.createDataFrame([(1, "b", "q"), (None, "m", "q"), (2, "c", "q"), (2, "c", "q")], "k int, v string, w string")
    assert rows(loads.upsert(target, new, ["k"])) == sorted([(1, "b", "q"), (None, "m", "q"), (2, "c", "q")], key=str)
    assert rows(loads.upsert(target, new, ["k"], update=["v"])) == sorted([(1, "b", "x"), (None, "m", "y"), (2, "c", "q")], key=str)
    assert rows(loads.insert_ignore(target, new, ["k"])) == sorted([(1, "a", "x"), (None, "n", "y"), (2, "c", "q")], key=str)


def test_rows_to_load_are_dealt_before_they_are_sorted(spark):
    """No sort of whole input splits, no table of keys by hash; one row of a key that nearly all rows have, or that is null."""
    new = spark.range(30_000, numPartitions=8).select(F.when(F.col("id") % 100 == 7, F.col("id")).when(F.col("id") % 100 != 8, 0).alias("k"), (-F.col("id")).alias("v"))
    target = spark.range(0, 1000, 5).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("v"))
    kept = {r["k"]: r["v"] for r in target.collect()}
    came = {k: -k for k in range(7, 30_000, 100)} | {0: -29_999, None: -29_908}
    for load, want in ((loads.upsert, kept | came), (loads.insert_ignore, came | kept)):
        found = load(target, new, ["k"])
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" not in plan
        sorts = [p.split("Range")[0] for p in plan.split(" Sort [")[1:]]
        assert sorts and all(" Exchange " in p for p in sorts)
        assert rows(found) == sorted(want.items(), key=str)


def test_history_over_three_snapshots(spark):
    day = lambda d: F.lit(d).cast("date")
    snap = lambda *r: spark.createDataFrame(list(r), "k int, v string")
    state = loads.first_history(snap((1, "a"), (2, "b")), day("2024-01-01"))
    state = loads.history(state, snap((1, "a"), (2, "c"), (3, None)), ["k"], day("2024-02-01"))
    state = loads.history(state, snap((2, "c"), (3, "z")), ["k"], day("2024-03-01"))
    got = [(r["k"], r["v"], r["version"], r["is_current"]) for r in state.orderBy("k", "version").collect()]
    assert got == [(1, "a", 1, True), (2, "b", 1, False), (2, "c", 2, True), (3, None, 1, False), (3, "z", 2, True)]
    closed = loads.history(state, snap((2, "c"), (3, "z")), ["k"], day("2024-04-01"), close_missing=True)
    assert closed.filter("k = 1 and is_current").count() == 0


def test_overwriting_scopes_and_publishing(spark, tmp_path):
    path = str(tmp_path / "t")
    loads.overwrite_scopes(spark.createDataFrame([(1, 2020), (2, 2021)], "v int, y int"), path, ["y"])
    loads.overwrite_scopes(spark.createDataFrame([(3, 2021)], "v int, y int"), path, ["y"])
    assert rows(spark.read.parquet(path)) == [(1, 2020), (3, 2021)]
    mart = str(tmp_path / "m")
    for n in (1, 2):
        loads.publish(spark.range(n), mart)
    assert loads.current(spark, mart).count() == 2


def test_isolated_loads(spark):
    done = []
    with pytest.raises(ExceptionGroup):
        loads.load_each({"bad": lambda: 1 / 0, "good": lambda: done.append(1)})
    assert done == [1]


def test_checks_fail(spark):
    df = spark.createDataFrame([(1, None), (1, "a")], "k int, v string")
    for bad in ({"columns": ["z"]}, {"not_null": ["v"]}, {"unique": ["k"]}):
        with pytest.raises(checks.CheckFailed):
            checks.require(df, **bad)
    assert checks.require(df, columns=["k"], not_null=["k"]) is df


def test_numbering_is_consecutive(spark):
    df = spark.range(1000).withColumn("k", F.xxhash64("id"))
    got = ranking.numbered(df, ["k"]).orderBy("k").select("id").limit(0).count()
    assert got == 0
    ids = [r[0] for r in ranking.numbered(df.drop("id"), ["k"], "n", 5).orderBy("k").select("n").collect()]
    assert ids == list(range(6, 1006))


def test_ids_are_consecutive_where_bounds_are_sampled(spark):
    """More rows than a range partitioning samples, and columns that the ids do not depend on."""
    rows = spark.range(300_000, numPartitions=24).select(F.xxhash64("id").alias("key"), F.concat(F.lit("row "), "id").alias("text"))
    found = shared.written(ranking.numbered(rows, ["key"], "n"), "numbered")
    got = found.agg(F.count("n"), F.countDistinct("n"), F.min("n"), F.max("n")).first()
    assert tuple(got) == (300_000, 300_000, 1, 300_000)
    assert found.select("key", "n").filter("n <= 100").orderBy("n").collect() == rows.select("key").orderBy("key").limit(100).selectExpr("key", "row_number() OVER (ORDER BY key) n").collect()


@pytest.mark.parametrize("slices", [2, 64])
def test_percentiles_are_exact(spark, slices):
    rng = np.random.default_rng(5)
    groups = {"a": rng.normal(size=4000), None: np.repeat([1.0, 7.0, 7.5], [5, 900, 3]), "one": np.array([4.0]), "wide": np.arange(10) ** 3.0}
    rows = [(k, float(v)) for k, values in groups.items() for v in values] + [("none", None), ("a", None)]
    shares = [0.0, 0.1, 0.25, 0.5, 0.999, 1.0]
    found = rates.percentiles(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", shares, slices)
    got = {r["k"]: r["p"] for r in found.collect()}
    assert got.pop("none") is None and set(got) == set(groups)
    for k, values in groups.items():
        assert got[k] == pytest.approx(np.quantile(values, shares))


def test_encodings_and_line_numbers_of_split_files(spark, tmp_path):
    """A file's encoding and its lines' numbers hold over all blocks that it is read in."""
    lines = [f"línea {i} ñ" for i in range(3000)]
    (tmp_path / "latin.txt").write_bytes("\r\n".join(lines).encode("latin-1"))
    (tmp_path / "utf.txt").write_bytes("\n".join([*lines, "", "€", ""]).encode())
    (tmp_path / "late.txt").write_bytes(b"plain\n" * 4000 + "ñ".encode("latin-1"))
    (tmp_path / "empty.txt").write_bytes(b"")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        found = files.decoded_lines(spark, str(tmp_path)).orderBy("file", "number").collect()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    of = lambda name: [(r["number"], r["line"]) for r in found if r["file"].endswith(name)]
    assert of("latin.txt") == list(enumerate(lines)) and of("utf.txt") == list(enumerate([*lines, "", "€"]))
    assert of("late.txt") == [*enumerate(["plain"] * 4000), (4000, "ñ")] and of("empty.txt") == []


def test_row_limit(spark):
    with pytest.raises(ValueError, match="year"):
        ranking.limited(spark.range(11), 10, ["year"])


def test_catalogue_rules(spark):
    good = dict(id="a", theme="t", unit="u", level="l", source="s", sql="SELECT '1' AS geo_key, 'n' AS geo_name, 'p' AS period, :v AS value, 'c' AS category", parameters={"v": indicators.Parameter("int")})
    one = indicators.Indicator(**good)
    indicators.Catalogue(one).check(spark)
    assert indicators.Catalogue(one).run(spark, "a", v="3").first()["value"] == 3
    assert "sql" not in indicators.Catalogue(one).list()[0]
    for change in ({"sql": "DROP TABLE x"}, {"parameters": {}}, {"sql": "SELECT 1; SELECT 2"}):
        with pytest.raises(indicators.InvalidIndicator):
            indicators.Catalogue(indicators.Indicator(**(good | change)))
    with pytest.raises(indicators.InvalidIndicator):
        indicators.Catalogue(one, one)
    for call in ({"v": "x"}, {"w": 1}):
        with pytest.raises(indicators.InvalidIndicator):
            indicators.Catalogue(one).run(spark, "a", **call)


def test_archive_members(spark, tmp_path):
    for name, member in (("a.zip", "data.csv"), ("b.zip", "other_2020.CSV")):
        with zipfile.ZipFile(tmp_path / name, "w") as archive:
            archive.writestr("readme.txt", "no")
            archive.writestr(member, "h\n1\n2")
    lines = files.member_lines(spark, f"{tmp_path}/*.zip", "data.csv", "*.csv")
    assert sorted(r["line"] for r in lines.collect()) == ["1", "1", "2", "2", "h", "h"]


def test_archive_gives_its_newest_edition(spark, tmp_path):
    """Editions are compared as numbers: 10 is after 9, and a year after any month."""
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        for member in ("data_2023_12.csv", "data_2024_9.csv", "data_2024_10.csv", "note_2030.txt"):
            archive.writestr(member, member)
    assert {r["line"] for r in files.member_lines(spark, f"{tmp_path}/a.zip", "data.csv", "*.csv").collect()} == {"data_2024_10.csv"}


def test_catalogue_lists_without_sql_and_leaves_views_alone(spark):
    spark.range(3).createOrReplaceTempView("orders")
    one = indicators.Indicator("a", "x", "u", "country", "s", "SELECT '0' AS geo_key, 'n' AS geo_name, '1' AS period, count(*) AS value, '' AS category FROM {orders}")
    catalogue = indicators.Catalogue(one)
    frames = {"orders": spark.range(5)}
    catalogue.check(spark, frames)
    assert catalogue.run(spark, "a", frames=frames).first()["value"] == 5 and spark.table("orders").count() == 3
    (listed,) = catalogue.list(theme="x")
    assert "sql" not in listed and catalogue.list(theme="y") == [] and catalogue.list(level="country") == [listed]


def test_landing_needs_a_shared_folder_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from statkit.plans import sourcing

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="checkpoint"):
        sourcing.landing(SimpleNamespace(conf={}, sparkContext=context))


def test_uploads_and_marks(spark):
    manifests = spark.createDataFrame([("f", "complete", 2, [("s", "n2")]), ("f", "complete", 1, [("s", "n1"), ("t", "m")]), ("f", "open", 3, [("s", "n3")])], "folder string, state string, uploaded int, files array<struct<slot:string,name:string>>")
    assert rows(editions.newest_uploads(manifests)) == [("f", 1, "t", "m"), ("f", 2, "s", "n2")]
    register = spark.createDataFrame([(5, "e1")], "modified int, etag string")
    landed = spark.createDataFrame([(6, "e1"), (7, "e2"), (4, "e3")], "modified int, etag string")
    assert rows(editions.unseen(landed, register)) == [("e2", 7)]
    assert rows(files.sheet_rows(spark.createDataFrame([("title", None), ("14039", "x")], "a string, b string"), ["key", "v"])) == [("14039", "x")]
    assert files.union_all(spark.range(1).select("id"), spark.range(2).withColumn("b", F.lit(1))).count() == 3


def test_numbers_leave_columns_of_any_name(spark):
    frame = spark.range(50).selectExpr("id AS k", "-id AS __at", "id % 3 AS __part", "'x' AS __size", "'y' AS __before")
    found = ranking.numbered(frame, ["k"]).collect()
    assert all(r["id"] == r["k"] + 1 and r["__at"] == -r["k"] and r["__part"] == r["k"] % 3 and r["__size"] == "x" and r["__before"] == "y" for r in found) and len(found) == 50
