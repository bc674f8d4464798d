"""Zip archives as a data source: a partition for each (archive, member), its lines streamed.

`spark.read.format("zip_lines").options(...).load()` after `register(spark)`, or `archive_lines`. Only an archive's directory
and the member's own bytes are read, from wherever the file system has them; no archive is held in memory, whatever its
size. A deflated member can't be split, so it is one task.
"""

from __future__ import annotations

import fnmatch
import io
import os
import re
import sys
import zipfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # so that executors need not have the package installed

SCHEMA = "file string, member string, number long, line string"
BATCH = 10_000  #: lines of a batch
LISTERS = 32  #: archives whose directories the driver reads at a time


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if re.match(r"[a-z][a-z0-9+.-]*:", path) else (fs.LocalFileSystem(), os.path.abspath(path))


def edition(name: str) -> tuple[list[int], str]:
    """What orders editions: the numbers in a name, from left to right, compared as numbers; then the name."""
    return ([int(x) for x in re.findall("[0-9]+", name)], name)


def chosen(names: list[str], expected: str, pattern: str, every: bool) -> list[str]:
    """The members to read: the expected one if it is there; else of those that fit the pattern the newest edition, or all (S3)."""
    fitting = sorted((n for n in names if fnmatch.fnmatch(n.lower(), pattern.lower())), key=edition)
    if every:
        return fitting
    return [expected] if expected in names else fitting[-1:]


@dataclass
class Member(InputPartition):
    file: str
    member: str | None
    encoding: str


class ZipLinesReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.expected, self.pattern = options.get("path", ""), options.get("expected", ""), options.get("pattern", "*")
        self.encoding, self.missing, self.every = options.get("encoding", "utf-8"), options.get("missing", "error"), options.get("members", "newest") == "all"
        if self.missing not in ("error", "skip", "row"):
            raise ValueError(f"missing is error, skip or row, not {self.missing}")

    def archives(self) -> list[str]:
        """The archives that the path (a folder, a file or a pattern of file names) stands for, sorted."""
        from pyarrow import fs

        top, name = self.path.rsplit("/", 1) if re.search(r"[*?\[]", self.path) else (self.path.rstrip("/"), "*.zip")
        system, inner = _filesystem(top)
        info = system.get_file_info(inner)
        if info.type == fs.FileType.File:
            return [top]
        found = [f.base_name for f in system.get_file_info(fs.FileSelector(inner, allow_not_found=True)) if f.type == fs.FileType.File]
        return [f"{top}/{n}" for n in sorted(found) if fnmatch.fnmatch(n, name)]

    def members(self, file: str) -> list[Member]:
        system, inner = _filesystem(file)
        with system.open_input_file(inner) as raw, zipfile.ZipFile(raw) as archive:
            names = sorted(n for n in archive.namelist() if not n.endswith("/"))
        found = chosen(names, self.expected, self.pattern, self.every)
        if not found and self.missing == "error":
            raise FileNotFoundError(f"{file}: no member {self.expected} or {self.pattern} in {names}")
        return [Member(file, n, self.encoding) for n in found] or [Member(file, None, self.encoding)] * (self.missing == "row")

    def partitions(self) -> list[Member]:
        with ThreadPoolExecutor(LISTERS) as pool:
            return [m for found in pool.map(self.members, self.archives()) for m in found]

    def read(self, partition: Member | None) -> Iterator[pa.RecordBatch]:
        def batch(lines: list[str | None], first: int | None) -> pa.RecordBatch:
            numbers = [None] * len(lines) if first is None else range(first, first + len(lines))
            columns = [pa.array([partition.file] * len(lines)), pa.array([partition.member] * len(lines), pa.string()), pa.array(numbers, pa.int64()), pa.array(lines, pa.string())]
            return pa.RecordBatch.from_arrays(columns, ["file", "member", "number", "line"])

        if partition is None:  # what Spark asks for where there are no partitions
            return
        if partition.member is None:
            yield batch([None], None)
            return
        system, inner = _filesystem(partition.file)
        with system.open_input_file(inner) as raw, zipfile.ZipFile(raw) as archive, archive.open(partition.member) as stream:
            lines, first = [], 0
            for line in io.TextIOWrapper(stream, partition.encoding, errors="replace", newline="\n"):
                lines.append(line.removesuffix("\n").removesuffix("\r"))
                if len(lines) == BATCH:
                    yield batch(lines, first)
                    lines, first = [], first + BATCH
            if lines:
                yield batch(lines, first)


class ZipLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "zip_lines"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return ZipLinesReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ZipLines)


def archive_lines(spark: SparkSession, path: str, expected: str = "", pattern: str = "*", members: str = "newest", missing: str = "error", encoding: str = "utf-8") -> DataFrame:
    """(file, member, number, line) of members of the zip archives at a path: a folder, a file or a pattern of names.

    members "newest": of each archive the member `expected`, else of those whose names fit `pattern` the newest edition, told
    by the numbers in the names; "all": all that fit. An archive without one is an error, is left out (missing "skip"), or is
    a row with nulls for member, number and line ("row"). Bytes that the encoding lacks become U+FFFD. Empty members give no
    rows. number counts a member's lines from 0.
    """
    register(spark)
    return spark.read.format("zip_lines").options(path=path, expected=expected, pattern=pattern, members=members, missing=missing, encoding=encoding).load()


def write_archives(df: DataFrame, path: str, archive: str, member: str, number: str, line: str) -> None:
    """Writes the lines of df as zip archives below a path: a task has whole archives, whose members it streams in the order of `number`.

    An archive is written under another name and renamed at its end, so a task that runs again replaces what it left.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_archive = open_member = raw = None
        now: tuple = (None, None)
        done: list[str] = []

        def close() -> None:
            if open_archive is not None:
                open_member.close()
                open_archive.close()
                raw.close()
                system.move(f"{inner}/.{now[0]}.part", f"{inner}/{now[0]}")
                done.append(now[0])

        system, inner = _filesystem(path)
        system.create_dir(inner, recursive=True)
        for batch in batches:
            for name, inside, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if name != now[0]:
                    close()
                    raw = system.open_output_stream(f"{inner}/.{name}.part")
                    open_archive = zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED)
                    open_member, now = None, (name, None)
                if inside != now[1]:
                    if open_member is not None:
                        open_member.close()
                    open_member, now = open_archive.open(zipfile.ZipInfo(inside, (1980, 1, 1, 0, 0, 0)), "w", force_zip64=True), (name, inside)
                open_member.write((text or "").encode() + b"\n")
        close()
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], ["archive"])

    rows = df.select(archive, member, number, line).repartition(archive).sortWithinPartitions(archive, member, number).select(archive, member, line)
    rows.mapInArrow(task, "archive string").count()
