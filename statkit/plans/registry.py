"""The registry that the query modules fill."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of (t, spark), t(name) being a table, under its name, with the SQL that gives the same rows."""

    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark)

        QUERIES[function.__name__] = run
        if sql:
            ORACLE[function.__name__] = sql.strip()
        return function

    return register
