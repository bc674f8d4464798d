"""Commits under contention, streams whose batches fail, marts that are refreshed, and the load register."""

import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statkit.operators import commits, loads, marts
from statkit.streaming import upserts

SCHEMA = "k long, v long"


def test_two_writers_at_once(spark, tmp_path):
    """Each number is taken once, no change is lost, and readers only go forward."""
    path, seen = str(tmp_path / "t"), []
    commits.replace(spark.createDataFrame([(0, 0)], SCHEMA), path)

    def add(i):
        def make(now):
            return commits.read(spark, path, now).unionByName(spark.createDataFrame([(i, i)], SCHEMA)), {}

        commits.change(spark, path, make)

    def look():
        for _ in range(30):
            seen.append(commits.head(spark, path).number)

    threads = [threading.Thread(target=add, args=(i,)) for i in range(1, 5)] + [threading.Thread(target=look)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    now = commits.head(spark, path)
    assert now.number == 5 and sorted(r["k"] for r in commits.read(spark, path, now).collect()) == [0, 1, 2, 3, 4]
    assert seen == sorted(seen)


def test_a_number_is_put_once(spark, tmp_path):
    file = f"{tmp_path}/c/000000000001.json"
    assert commits.put_if_absent(spark, file, "a") and not commits.put_if_absent(spark, file, "b")
    assert [p.read_text() for p in (tmp_path / "c").iterdir()] == ["a"]
    (tmp_path / "viewed").mkdir()
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.tests.link./in", f"file://{tmp_path}/viewed")
    remote = "viewfs://tests/in/000000000001.json"  # a path that only Hadoop's file systems open
    assert commits.put_if_absent(spark, remote, "a") and not commits.put_if_absent(spark, remote, "b")
    assert (tmp_path / "viewed/000000000001.json").read_text() == "a"


def test_publish_and_current(spark, tmp_path):
    path = str(tmp_path / "mart")
    with pytest.raises(FileNotFoundError):
        loads.current(spark, path)
    for n in (1, 2, 3):
        loads.publish(spark.range(n).toDF("k"), path)
        assert loads.current(spark, path).count() == n


def landed(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def ingest(spark, tmp_path, **more):
    at = lambda name: f"{tmp_path}/{name}"
    return upserts.ingest_upserts(spark, at("in"), T.StructType.fromDDL(SCHEMA), at("table"), at("state"), ["k"], upserts.newest("v"), **more)


def state(spark, tmp_path):
    return sorted((tuple(r) for r in upserts.table(spark, f"{tmp_path}/table").collect()), key=str)


def test_stream_of_single_files_upserts_in_order(spark, tmp_path):
    landed(spark, f"{tmp_path}/in", [(1, 10), (2, 20), (2, 21)])
    assert ingest(spark, tmp_path, files=1) == (1, 0)
    landed(spark, f"{tmp_path}/in", [(2, 5), (3, 30)])
    landed(spark, f"{tmp_path}/in", [(3, 31), (None, 1)])
    assert ingest(spark, tmp_path, files=1) == (2, 0)
    assert sorted(state(spark, tmp_path), key=str) == sorted([(1, 10), (2, 5), (3, 31), (None, 1)], key=str)
    assert ingest(spark, tmp_path, files=1) == (0, 0)


@pytest.mark.parametrize("when", ["before", "after"])
def test_a_batch_that_fails_around_its_commit_is_applied_once(spark, tmp_path, monkeypatch, when):
    """Failing between the version's write and its commit leaves nothing; failing after the commit is told on the replay."""
    landed(spark, f"{tmp_path}/in", [(1, 1)])
    ingest(spark, tmp_path)
    landed(spark, f"{tmp_path}/in", [(1, 2), (2, 2)])
    put, failing = commits._put, [True]

    def broken(*args):
        if when == "after":
            put(*args)
        if failing.pop():
            raise OSError("lost")

    monkeypatch.setattr(commits, "_put", broken)
    with pytest.raises(Exception, match="lost"):
        ingest(spark, tmp_path)
    monkeypatch.setattr(commits, "_put", put)
    assert state(spark, tmp_path) == ([(1, 1)] if when == "before" else [(1, 2), (2, 2)])
    numbers = commits.head(spark, f"{tmp_path}/table").number
    assert ingest(spark, tmp_path) == ((1, 0) if when == "before" else (0, 1))
    assert state(spark, tmp_path) == [(1, 2), (2, 2)]
    assert commits.head(spark, f"{tmp_path}/table").number == 2 == numbers + (when == "before")


def test_marts_follow_their_inputs(spark, tmp_path):
    base, made = {n: f"{tmp_path}/{n}" for n in "xy"}, []
    for n in "xy":
        commits.replace(spark.range(2).toDF("k"), base[n])

    def build(name):
        def run(*frames):
            made.append(name)
            return frames[0].groupBy().agg(F.sum("k").alias("k"))

        return run

    chain = [marts.Mart("top", ["mid", "side"], build("top")), marts.Mart("mid", ["x"], build("mid")), marts.Mart("side", ["y"], build("side"))]
    root = f"{tmp_path}/marts"
    assert marts.refresh(spark, root, chain, base) == {"mid": "first", "side": "first", "top": "first"} and made[-1] == "top"
    made.clear()
    assert set(marts.refresh(spark, root, chain, base).values()) == {"kept"} and not made
    commits.replace(spark.range(4).toDF("k"), base["x"])
    assert marts.refresh(spark, root, chain, base) == {"mid": "changed", "side": "kept", "top": "changed"} and made == ["mid", "top"]
    assert marts.read(spark, root, "top").first()["k"] == 6
    with pytest.raises(ValueError):
        marts.ordered([*chain, chain[0]])
    with pytest.raises(Exception, match="cycle"):
        marts.ordered([marts.Mart("a", ["b"], build("a")), marts.Mart("b", ["a"], build("b"))])
    with pytest.raises(FileNotFoundError):
        marts.refresh(spark, root, [marts.Mart("z", ["nowhere"], build("z"))], {"nowhere": f"{tmp_path}/nowhere"})


def test_register_keeps_a_row_for_each_object(spark, tmp_path):
    register = f"{tmp_path}/register"
    loads.registered(spark, register, "s", "a", lambda: {"rows": 1})
    with pytest.raises(ZeroDivisionError):
        loads.registered(spark, register, "s", "b", lambda: {"rows": 1 // 0})
    loads.registered(spark, register, "s", "a", lambda: {"rows": 2})
    rows = commits.read(spark, register, commits.head(spark, register)).collect()
    got = sorted((r["object"], r["state"], r["counts"], r["error"]) for r in rows)
    assert got[0] == ("a", "loaded", {"rows": 2}, None) and got[1][:3] == ("b", "failed", {}) and "ZeroDivisionError" in got[1][3]


def test_counts_come_from_the_writing_job(spark, tmp_path):
    rows = spark.createDataFrame([("1", "x"), ("z", "y"), (None, " "), (" ", None), ("2", "w")], "n string, t string")
    typed, seen = loads.counted(rows, T.StructType.fromDDL("n long, t string"))
    typed.write.parquet(f"{tmp_path}/out")
    assert seen.get == {"rows": 5, "unreadable_n": 1, "unreadable_t": 0}
    assert sorted((r["n"] for r in spark.read.parquet(f"{tmp_path}/out").collect()), key=str) == [1, 2, None, None, None]


def test_report_of_loads(spark):
    report = loads.tried({"good": lambda: 3, "bad": lambda: 1 // 0})
    assert [tuple(r)[:3] for r in loads.load_report(spark, report).collect()] == [("good", 3, False), ("bad", None, True)]
    with pytest.raises(ExceptionGroup):
        loads.load_each({"bad": lambda: 1 // 0})
