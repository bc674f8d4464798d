"""Members of zip archives: which one is read, what is missing, and lines as they stand in the file."""

import zipfile

import pytest

from statkit.sources import archives


def make(path, members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for name, content in members.items():
            out.writestr(name, content)


def lines(frame):
    return sorted((r["file"].rsplit("/", 1)[1], r["member"], r["number"], r["line"]) for r in frame.collect())


def test_exact_name_then_newest_edition(spark, tmp_path):
    make(tmp_path / "a.zip", {"wanted.csv": "x\ny\n", "data_10.csv": "no\n"})
    make(tmp_path / "b.zip", {"Data_9.CSV": "nine\n", "data_10.csv": "ten\r\nmore", "dir/": ""})
    (tmp_path / "note.txt").write_text("no archive")
    got = lines(archives.archive_lines(spark, str(tmp_path), expected="wanted.csv", pattern="data_*.csv"))
    assert got == [("a.zip", "wanted.csv", 0, "x"), ("a.zip", "wanted.csv", 1, "y"), ("b.zip", "data_10.csv", 0, "ten"), ("b.zip", "data_10.csv", 1, "more")]
    every = lines(archives.archive_lines(spark, f"file:{tmp_path}/b*.zip", pattern="data_*.csv", members="all"))
    assert [x[1] for x in every] == ["Data_9.CSV", "data_10.csv", "data_10.csv"]
    assert archives.archive_lines(spark, str(tmp_path / "b.zip"), pattern="*9*").collect()[0]["line"] == "nine"


def test_missing_members(spark, tmp_path):
    make(tmp_path / "a.zip", {"other.txt": "x"})
    make(tmp_path / "b.zip", {"w.csv": ""})
    make(tmp_path / "c.zip", {"w.csv": "1\n"})
    read = lambda missing: archives.archive_lines(spark, str(tmp_path), expected="w.csv", pattern="w*", missing=missing)
    with pytest.raises(Exception, match="no member w.csv"):
        read("error").collect()
    assert lines(read("skip")) == [("c.zip", "w.csv", 0, "1")]
    assert {tuple(r)[1:] for r in read("row").collect()} == {(None, None, None), ("w.csv", 0, "1")}
    with pytest.raises(Exception, match="error, skip or row"):
        read("other").collect()


def test_partitions_encodings_and_long_members(spark, tmp_path):
    make(tmp_path / "a.zip", {f"m{i}.txt": "".join(f"{i},{j},né\n" for j in range(25_000)).encode("latin-1") for i in range(3)})
    frame = archives.archive_lines(spark, str(tmp_path), pattern="m*", members="all", encoding="latin-1")
    assert frame.rdd.getNumPartitions() == 3
    rows = frame.collect()
    assert len(rows) == 75_000 and all(r["line"] == f"{r['member'][1]},{r['number']},né" for r in rows)


def test_written_archives_are_read_back(spark, tmp_path):
    rows = [(f"z{i % 3}.zip", f"m{i % 2}.csv", i, None if i == 5 else f"line {i}") for i in range(50)]
    frame = spark.createDataFrame(rows, "archive string, member string, number long, line string")
    for _ in range(2):  # a second time replaces the first
        archives.write_archives(frame, str(tmp_path / "out"), "archive", "member", "number", "line")
    got = lines(archives.archive_lines(spark, str(tmp_path / "out"), members="all"))
    want = {}
    for a, m, _, text in sorted(rows, key=lambda r: r[2]):
        want.setdefault((a, m), []).append(text or "")
    assert got == sorted((a, m, i, x) for (a, m), xs in want.items() for i, x in enumerate(xs))
    assert archives.archive_lines(spark, str(tmp_path / "none")).count() == 0
