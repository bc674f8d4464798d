"""Write semantics: upserts, history, scopes and snapshots, as plans over tables; writers swap whole versions.

merge-like operators return the target's next state; `publish` writes it as a new version and commits it last, so
readers see the old version or the new one. Any number of tasks can write; nothing passes through the driver but paths.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statkit.functions.codes import row_hash
from statkit.operators import commits
from statkit.operators.ranking import keep_one, numbered


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str = "__") -> list[Column]:
    return [left[k].eqNullSafe(right[f"{prefix}{k}"]) for k in keys]


def _keys(df: DataFrame, keys: Sequence[str], prefix: str = "__") -> DataFrame:
    return df.select(*[F.col(k).alias(f"{prefix}{k}") for k in keys])


def one_per_key(incoming: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """The first row of each key. Rows are dealt by key and by the task that they come from before they are sorted.

    Spark sorts rows once before and once after they meet by key. Dealt so, the first sort has a shuffle's partitions, which
    adaptive execution sizes, and not whole input splits; a key with very many rows is cut to one row a task before they meet.
    """
    dealt = incoming.repartition(*keys, F.spark_partition_id())
    return keep_one(dealt, list(keys), order or [F.col(c).asc_nulls_last() for c in incoming.columns])


def insert_ignore(target: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """target and those incoming rows whose key it lacks; null keys are equal to each other (K1)."""
    new = one_per_key(incoming, keys, order)
    known = _keys(target, keys)
    return target.unionByName(new.join(known, _same(new, known, keys), "left_anti"))


def upsert(target: DataFrame, incoming: DataFrame, keys: Sequence[str], update: Sequence[str] | None = None, order: Sequence[Column] | None = None) -> DataFrame:
    """target with incoming rows in place of equal keys (K2); with `update`, other columns keep the stored value."""
    new = one_per_key(incoming, keys, order)
    if update is not None:
        stored = target.select(*[F.col(c).alias(f"__{c}") for c in target.columns]).withColumn("__stored", F.lit(True))
        new = new.join(stored, [new[k].eqNullSafe(stored[f"__{k}"]) for k in keys], "left")
        new = new.select(*[F.when(F.col("__stored"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c not in (*update, *keys) else F.col(c) for c in target.columns])
    gone = _keys(new, keys)
    return target.join(gone, _same(target, gone, keys), "left_anti").unionByName(new.select(*target.columns))


def load(target: DataFrame, incoming: DataFrame, keys: Sequence[str], mode: str) -> DataFrame:
    """mode "bootstrap" ignores known keys, "update" replaces them."""
    return {"bootstrap": insert_ignore, "update": upsert}[mode](target, incoming, keys)


def replace_scope(target: DataFrame, incoming: DataFrame, scope: Sequence[str]) -> DataFrame:
    """target without the rows of incoming's scopes (editions, years, cuts), and incoming (K5)."""
    gone = _keys(incoming, scope).distinct()
    return target.join(gone, _same(target, gone, scope), "left_anti").unionByName(incoming)


def skip_loaded(incoming: DataFrame, target: DataFrame, scope: Sequence[str]) -> DataFrame:
    """incoming rows of scopes that the target has none of (K7)."""
    known = _keys(target, scope).distinct()
    return incoming.join(known, _same(incoming, known, scope), "left_anti")


def history(current: DataFrame, snapshot: DataFrame, keys: Sequence[str], when: Column, close_missing: bool = False) -> DataFrame:
    """Slowly changing history (type 2): the next state of a table with version, is_current, valid_from, valid_to (K8, K9).

    current: all versions so far. A snapshot row whose values differ (by hash) closes the current version and opens the
    next; an unchanged row changes nothing; a new key opens version 1. Keys that the snapshot lacks stay current unless
    close_missing.
    """
    values = [c for c in snapshot.columns if c not in keys]
    was = current.filter("is_current").withColumn("__was", row_hash(*map(F.col, values)))
    now = snapshot.select(*[F.col(k).alias(f"__{k}") for k in keys], *[F.col(v).alias(f"__v_{v}") for v in values], row_hash(*map(F.col, values)).alias("__now"), F.lit(True).alias("__there"))
    both = was.join(now, [was[k].eqNullSafe(now[f"__{k}"]) for k in keys], "full")
    changed = F.coalesce(F.col("__was") != F.col("__now"), F.lit(False))
    closed = F.col("is_current") & (changed | (F.col("__there").isNull() if close_missing else F.lit(False)))
    kept = both.filter("is_current").withColumns({"valid_to": F.when(closed, when).otherwise(F.col("valid_to")), "is_current": ~closed})
    opened = both.filter(F.col("__there") & (F.col("is_current").isNull() | changed)).select(
        *[F.col(f"__{k}").alias(k) for k in keys], *[F.col(f"__v_{v}").alias(v) for v in values],
        (F.coalesce(F.col("version"), F.lit(0)) + 1).cast("int").alias("version"), F.lit(True).alias("is_current"), when.alias("valid_from"), F.lit(None).cast("date").alias("valid_to"),
    )
    columns = [*keys, *values, "version", "is_current", "valid_from", "valid_to"]
    past = current.filter("not is_current").select(*columns)
    return past.unionByName(kept.select(*columns)).unionByName(opened.select(*columns))


def first_history(snapshot: DataFrame, when: Column) -> DataFrame:
    return snapshot.withColumns({"version": F.lit(1), "is_current": F.lit(True), "valid_from": when, "valid_to": F.lit(None).cast("date")})


def surrogate_ids(target: DataFrame, incoming: DataFrame, order: Sequence[str], name: str = "id") -> DataFrame:
    """incoming with ids that go on after target's largest one, by a total order."""
    top = target.agg(F.coalesce(F.max(name), F.lit(0)).alias("t")).first()["t"]
    return numbered(incoming, order, name, top)


def seeded_catalogue(seed: Sequence[str], observed: DataFrame, column: str) -> DataFrame:
    """(id, value): seeded values keep their places, observed ones follow in order (U4).

    Ids of observed values depend on what is observed together; operators.registry keeps them.
    """
    spark = observed.sparkSession
    first = spark.createDataFrame(list(enumerate(seed, 1)), "place int, value string")
    rest = observed.select(F.lit(len(seed) + 1).alias("place"), F.col(column).alias("value")).filter(F.col(column).isNotNull()).distinct().join(first.select("value"), "value", "left_anti")
    return numbered(first.unionByName(rest), ["place", "value"]).select(F.col("id").cast("int").alias("id"), "value")


def publish(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Writes df as a new version below `path` and commits it under the next number (K6, K11). Readers use `current`."""
    return f"{path}/{commits.replace(df, path, partition_by=partition_by).version}"


def current(spark: SparkSession, path: str) -> DataFrame:
    """The version with the highest commit number."""
    now = commits.head(spark, path)
    if now is None:
        raise FileNotFoundError(f"{path} has no published version")
    return commits.read(spark, path, now)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    (df.write.partitionBy(*partition_by) if partition_by else df.write).mode("append").parquet(path)


def overwrite_scopes(df: DataFrame, path: str, scope: Sequence[str]) -> None:
    """Replaces only the partitions that df has rows of (K5)."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*scope).parquet(path)


def traced(df: DataFrame, source: str, version: str, processed: str) -> DataFrame:
    """df with its source, version, processing date (yyyy-MM-dd) and the SHA-256 of each row's values as text."""
    content = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns])
    return df.withColumns({"source": F.lit(source), "version": F.lit(version), "processed": F.lit(processed).cast("date"), "content_sha256": F.sha2(content.cast("binary"), 256)})


def load_each(loads: Mapping[str, Callable[[], int | None]]) -> None:
    """Runs independent loads; one that fails does not stop the others, and all errors are raised at the end."""
    failed = {name: error for name, _, error in tried(loads) if error is not None}
    if failed:
        raise ExceptionGroup(f"failed: {', '.join(failed)}", list(failed.values()))


def tried(loads: Mapping[str, Callable[[], int | None]]) -> list[tuple[str, int | None, Exception | None]]:
    """Runs independent loads: for each its name, what it returned (its rows) and its error, if it failed."""
    out: list[tuple[str, int | None, Exception | None]] = []
    for name, run in loads.items():
        try:
            out.append((name, run(), None))
        except Exception as error:  # noqa: BLE001
            out.append((name, None, error))
    return out


def load_report(spark: SparkSession, report: Sequence[tuple[str, int | None, Exception | None]]) -> DataFrame:
    """(name, rows, failed, error): what `tried` tells of each load, as rows."""
    return spark.createDataFrame([(name, rows, error is not None, None if error is None else f"{type(error).__name__}: {error}") for name, rows, error in report], "name string, rows long, failed boolean, error string")


def counted(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, Observation]:
    """df (all columns text) in the modelled types, and an observation of what the job that writes it saw.

    After the write it holds `rows`, and by column `unreadable_<column>`: values that are there but do not read as the type.
    The counts come from the writing job itself; nothing is scanned twice.
    """
    cast = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields}
    lost = [F.count_if(F.col(n).isNotNull() & (F.trim(n) != "") & v.isNull()).alias(f"unreadable_{n}") for n, v in cast.items()]
    seen = Observation(f"load-{uuid.uuid4().hex}")
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *lost).select(*[v.alias(n) for n, v in cast.items()]), seen


def registered(spark: SparkSession, register: str, submission: str, object_: str, run: Callable[[], Mapping[str, int]]) -> Mapping[str, int]:
    """Runs a load and writes its row of the load register: upsert on (submission, object), in one commit.

    run returns the load's counts. A load that fails leaves a row with its error and no counts, and the error is raised. The
    same submission loaded again replaces its row.
    """
    try:
        counts, error = dict(run()), None
    except Exception as failure:  # noqa: BLE001
        counts, error = {}, failure
    shape = "submission string, object string, state string, counts map<string,long>, error string"
    row = spark.createDataFrame([(submission, object_, "failed" if error else "loaded", counts, None if error is None else f"{type(error).__name__}: {error}")], shape)

    def make(now: commits.Commit | None) -> tuple[DataFrame, dict]:
        before = commits.read(spark, register, now) if now else row.limit(0)
        return upsert(before, row, ["submission", "object"], order=[F.col("state")]).coalesce(1), {}

    commits.change(spark, register, make)
    if error is not None:
        raise error
    return counts


def with_bridge(target: DataFrame, parents: DataFrame, bridge: DataFrame, key: str, order: Sequence[str], name: str = "id") -> tuple[DataFrame, DataFrame]:
    """Parents with surrogate ids, and the bridge's rows with the ids in place of natural keys."""
    with_ids = surrogate_ids(target, parents, order, name)
    return with_ids, bridge.join(with_ids.select(key, name), key).drop(key)


def extension(facts: DataFrame, condition: Column, key: str, extras: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """facts without the extra columns, and a 1:1 table of them for rows where they exist."""
    return facts.drop(*extras), facts.filter(condition).select(key, *extras)
