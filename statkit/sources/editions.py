"""Which landed files and editions to read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statkit.operators.ranking import keep_one


def latest(files: DataFrame, by: Sequence[str] = (), modified: str = "modified", name: str = "name") -> DataFrame:
    """The last modified file of each group (all files, without groups); the larger name breaks ties."""
    if by:
        return keep_one(files, by, [F.desc(modified), F.desc(name)])
    return files.orderBy(F.desc(modified), F.desc(name)).limit(1)


def pending(available: DataFrame, loaded: DataFrame, period: Sequence[str], after_last: bool = False) -> DataFrame:
    """Editions not loaded yet; with after_last only those after the last one loaded."""
    out = available.join(loaded.select(*period).distinct(), list(period), "left_anti")
    if not after_last:
        return out
    last = loaded.agg(F.max(F.struct(*period)).alias("__last"))
    return out.crossJoin(F.broadcast(last)).filter(F.col("__last").isNull() | (F.struct(*period) > F.col("__last"))).drop("__last")  # one row


def unseen(files: DataFrame, register: DataFrame, mark: str = "modified", tag: str = "etag") -> DataFrame:
    """Files newer than the register's high-water mark whose content tag it has not seen."""
    high = register.agg(F.max(mark).alias("__high"))
    newer = files.crossJoin(F.broadcast(high)).filter(F.col("__high").isNull() | (F.col(mark) > F.col("__high"))).drop("__high")  # one row
    return newer.join(register.select(tag).distinct(), tag, "left_anti")


def newest_uploads(manifests: DataFrame, states: Sequence[str] = ("complete",)) -> DataFrame:
    """Of manifests (folder, state, uploaded, files: array of (slot, name)): the newest upload of each slot, oldest first."""
    each = manifests.filter(F.col("state").isin(*states)).select("folder", "uploaded", F.inline("files"))
    return keep_one(each, ["folder", "slot"], [F.desc("uploaded"), F.desc("name")]).orderBy("uploaded", "folder", "slot")
