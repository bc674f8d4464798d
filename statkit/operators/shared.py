"""The folder that driver and executors share, and tables written there on the way."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir or the context's checkpoint folder; in local mode a temporary one of our own where both are unset."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (found or _own()).rstrip("/")


@functools.cache
def _own() -> str:
    return tempfile.mkdtemp(prefix="spark-landing-")


def written(df: DataFrame, name: str) -> DataFrame:
    """df written once as Parquet in the shared folder and read again: every use of it sees the same rows."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """df for a join that never broadcasts it: size estimates leave out what `explode` adds, so cells of a small table seem small."""
    return df.hint("merge")
