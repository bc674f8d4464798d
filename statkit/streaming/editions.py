"""New editions as a file stream: each run processes the files that came since, once, into an idempotent sink."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from statkit.operators.loads import overwrite_scopes


def ingest_editions(spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str, scope: Sequence[str], transform: Callable[[DataFrame], DataFrame] = lambda df: df, format: str = "parquet") -> int:
    """Processes what is new below `source` and ends; returns the number of micro-batches.

    Each micro-batch replaces the scopes (editions) that it has rows of, so a batch that runs twice changes nothing. An
    edition's files must land together or carry a scope of their own. A run has no file limit: all that is new is one
    micro-batch, as a second one would replace the first one's rows of the editions that they share. A batch that failed
    runs again with its own files before newer ones.
    """
    done = []

    def sink(batch: DataFrame, number: int) -> None:
        overwrite_scopes(transform(batch), target, scope)
        done.append(number)

    stream = spark.readStream.schema(schema).format(format).load(source)
    query = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(sink).start()
    query.awaitTermination()
    return len(done)
