"""A registry of ids that stay: a key keeps its id whatever is loaded later, and in whatever order.

Keys belong to shards by their hash; shard s gives the ids s + 1, s + 1 + SHARDS, s + 1 + 2 * SHARDS and so on. Known keys are
looked up first; new ones are numbered shard by shard after those that the shard has. Nothing is numbered in one task, and a
load writes its new keys only, as one more part that a commit adds to the registry.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statkit.operators import commits
from statkit.operators.shared import written

SHARDS = 64


def entries(spark: SparkSession, path: str, now: commits.Commit | None = None) -> DataFrame:
    """(key, shard, id): all that the registry has; key as text."""
    now = now or commits.head(spark, path)
    if now is None:
        return spark.createDataFrame([], "key string, shard int, id long")
    return spark.read.schema("key string, shard int, id long").parquet(*[f"{path}/{p}" for p in now.facts["parts"]])


def enter(keys: DataFrame, path: str, column: str) -> int:
    """Gives each key of the column that the registry lacks an id; the number of new ones.

    Null is no key. If another writer was first, what is new is found again, so that no key has two ids.
    """
    spark, shard = keys.sparkSession, F.pmod(F.xxhash64("key"), F.lit(SHARDS)).cast("int")
    seen = written(keys.select(F.col(column).cast("string").alias("key")).filter("key IS NOT NULL").distinct(), "keys")
    added = [0]

    def make(now: commits.Commit | None) -> tuple[DataFrame, dict] | None:
        known = entries(spark, path, now) if now else spark.createDataFrame([], "key string, shard int, id long")
        new = written(seen.join(known.select("key"), "key", "left_anti").withColumn("shard", shard), "new-keys")
        added[0] = new.count()
        if not added[0]:
            return None
        has = known.groupBy("shard").agg(F.count(F.lit(1)).alias("has"))  # a row for each shard
        place = F.row_number().over(Window.partitionBy("shard").orderBy("key")) - 1
        rows = new.withColumn("place", place).join(F.broadcast(has), "shard", "left")
        rows = rows.select("key", "shard", ((F.col("place") + F.coalesce("has", F.lit(0))) * SHARDS + F.col("shard") + 1).cast("long").alias("id"))
        return rows, {"parts": list(now.facts["parts"]) if now else []}

    _changed(spark, path, make)
    return added[0]


def _changed(spark: SparkSession, path: str, make) -> None:
    """As commits.change, but the version written is one more part of what the commit names."""
    for _ in range(commits.TRIES):
        now = commits.head(spark, path)
        made = make(now)
        if made is None:
            return
        part = commits._write(made[0], path, ())
        if commits._put(spark, path, now.number + 1 if now else 1, part, {"parts": [*made[1]["parts"], part]}):
            return
    raise RuntimeError(f"{path}: {commits.TRIES} numbers were taken by other writers")


def with_ids(facts: DataFrame, path: str, column: str, name: str = "id") -> DataFrame:
    """facts with the registered id of the column's value; null where it has none."""
    known = entries(facts.sparkSession, path).select(F.col("key").alias("__key"), F.col("id").alias(name))
    return facts.join(known, F.col(column).cast("string") == F.col("__key"), "left").drop("__key")


def catalogue(spark: SparkSession, path: str, seed: Sequence[str], observed: DataFrame, column: str) -> DataFrame:
    """(key, id) of seeded values and of observed ones, entered in this order; ids of earlier loads stay."""
    enter(spark.createDataFrame([(s,) for s in seed], f"`{column}` string"), path, column)
    enter(observed, path, column)
    return entries(spark, path).select("key", "id")
