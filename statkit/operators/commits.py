"""Numbered commits of a table: a version is seen when its commit file is, and a number is taken by one writer only.

A table is a folder with versions (Parquet folders) and `_commits`, a JSON file for each number from 1: the version's folder
and facts about it (which batches it holds, which inputs it was made from). A writer writes its version first and then puts
the next number; if another has put it, it reads what is there now and tries again. The highest number is current, so what
readers see never goes back, whatever the writers' clocks say.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

TRIES = 20  #: numbers that a writer tries before it gives up


@dataclass(frozen=True)
class Commit:
    number: int
    version: str
    facts: dict = field(default_factory=dict)


def _folder(path: str) -> str:
    return f"{path.rstrip('/')}/_commits"


def _local(path: str) -> str | None:
    scheme = path.split(":", 1)[0] if ":" in path.split("/", 1)[0] else ""
    return {"": path, "file": "/" + path.removeprefix("file:").lstrip("/")}.get(scheme)


def put_if_absent(spark: SparkSession, file: str, text: str) -> bool:
    """Writes a whole file unless there is one: False if another writer was first.

    On a local or mounted file system by a hard link, elsewhere by a rename that does not overwrite; both are atomic there
    (not so on object stores without such a rename).
    """
    folder, name = file.rsplit("/", 1)
    own = f"{folder}/.{name}-{uuid.uuid4().hex}"
    if (local := _local(folder)) is not None and _local(own):
        os.makedirs(local, exist_ok=True)
        with open(_local(own), "w", encoding="utf-8") as out:
            out.write(text)
        try:
            os.link(_local(own), _local(file))
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(_local(own))
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs, context = at(folder).getFileSystem(conf), jvm.org.apache.hadoop.fs.FileContext.getFileContext(at(folder).toUri(), conf)
    out = fs.create(at(own), False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        context.rename(at(own), at(file), spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in str(error.java_exception):
            raise
        fs.delete(at(own), False)
        return False


def head(spark: SparkSession, path: str) -> Commit | None:
    """The current commit; None for a table that has none yet."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(_folder(path))
    fs = folder.getFileSystem(conf)
    if not fs.exists(folder):
        return None
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    names = [n for n in names if n.endswith(".json") and not n.startswith(".")]
    if not names:
        return None
    found = json.loads(spark.read.option("wholetext", True).text(f"{_folder(path)}/{max(names)}").first()[0])
    return Commit(int(max(names).removesuffix(".json")), found["version"], found["facts"])


def _put(spark: SparkSession, path: str, number: int, version: str, facts: dict) -> bool:
    return put_if_absent(spark, f"{_folder(path)}/{number:012d}.json", json.dumps({"version": version, "facts": facts}))


def _write(df: DataFrame, path: str, partition_by: Sequence[str]) -> str:
    version = f"v-{uuid.uuid4().hex}"
    (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(f"{path}/{version}")
    return version


def read(spark: SparkSession, path: str, commit: Commit) -> DataFrame:
    return spark.read.parquet(f"{path}/{commit.version}")


def replace(df: DataFrame, path: str, facts: dict | None = None, partition_by: Sequence[str] = ()) -> Commit:
    """df as the table's next version, whatever was there: written once, then put under the next free number (K6)."""
    spark, version = df.sparkSession, _write(df, path, partition_by)
    for _ in range(TRIES):
        now = head(spark, path)
        number = now.number + 1 if now else 1
        if _put(spark, path, number, version, facts or {}):
            return Commit(number, version, facts or {})
    raise RuntimeError(f"{path}: {TRIES} numbers were taken by other writers")


def change(spark: SparkSession, path: str, make: Callable[[Commit | None], tuple[DataFrame, dict] | None], partition_by: Sequence[str] = ()) -> Commit | None:
    """The version that `make` forms from the current commit, with its facts; formed anew if another writer was first (K2).

    make returns None where there is nothing to do; then the current commit stays and is returned.
    """
    for _ in range(TRIES):
        now = head(spark, path)
        made = make(now)
        if made is None:
            return now
        version, number = _write(made[0], path, partition_by), now.number + 1 if now else 1
        if _put(spark, path, number, version, made[1]):
            return Commit(number, version, made[1])
    raise RuntimeError(f"{path}: {TRIES} numbers were taken by other writers")
