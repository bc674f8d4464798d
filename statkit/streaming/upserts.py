"""An upserting stream, each micro-batch exactly once: the table's commit says which batches it holds."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statkit.operators import commits, loads


def apply_batch(batch: DataFrame, number: int, target: str, stream: str, keys: Sequence[str], order: Sequence[Column]) -> bool:
    """Upserts a micro-batch into the table and notes its number, in one commit; False if the table holds it already.

    order: of several rows of a key the first stays. A key's row is replaced by a later batch's, whatever it holds. A batch
    that failed before its commit left nothing that readers see; one that failed after it is told by its number.
    """
    spark = batch.sparkSession
    rows = loads.one_per_key(batch, keys, order)

    def make(now: commits.Commit | None) -> tuple[DataFrame, dict] | None:
        batches = dict(now.facts.get("batches", {})) if now else {}
        if batches.get(stream, -1) >= number:
            return None
        table = commits.read(spark, target, now) if now else rows.limit(0)
        return loads.upsert(table, rows, keys, order=order), {**(now.facts if now else {}), "batches": batches | {stream: number}}

    before = commits.head(spark, target)
    after = commits.change(spark, target, make)
    return after != before


def ingest_upserts(spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str, keys: Sequence[str], order: Sequence[Column], files: int | None = None, stream: str = "main", transform: Callable[[DataFrame], DataFrame] = lambda df: df) -> tuple[int, int]:
    """Processes what is new below `source` and ends; returns the micro-batches applied and those that were there already (K2).

    files: at most so many files make a micro-batch (all that is new if not given), in the order in which they came; several
    batches may hold rows of one edition. stream: the checkpoint's name in the table's commits, one for each checkpoint.
    """
    applied, known = [], []

    def sink(batch: DataFrame, number: int) -> None:
        (applied if apply_batch(transform(batch), number, target, stream, keys, order) else known).append(number)

    reader = spark.readStream.schema(schema).format("parquet")
    reader = reader.option("maxFilesPerTrigger", files) if files else reader
    query = reader.load(source).writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(sink).start()
    query.awaitTermination()
    return len(applied), len(known)


def table(spark: SparkSession, target: str) -> DataFrame:
    """The table as of its current commit."""
    now = commits.head(spark, target)
    if now is None:
        raise FileNotFoundError(f"{target} has no commit")
    return commits.read(spark, target, now)


def newest(*columns: str) -> list[Column]:
    """The order in which the newest row of a key is first."""
    return [F.col(c).desc_nulls_last() for c in columns]
