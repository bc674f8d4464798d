"""Column profiles as mergeable states: one pass for each edition, stored, and merged over editions without reading them again."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_K = 14  #: registers of a sketch, as a power of 2: a standard error of about 0.8 %


def states(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """A row per column: column, rows, nulls, sketch (of distinct values), low, high (as text), integers, numbers, dates (values that read so).

    One aggregation, whatever the columns; no row is repeated for a column. An empty table gives rows with counts of 0.
    by: columns that tell editions apart; each edition then has rows of its own, after `by`, from the same single pass.
    """
    parts = []
    for c in columns or [c for c in df.columns if c not in by]:
        text = F.col(f"`{c}`").cast("string")
        reads = lambda kind, text=text: F.count_if(text.try_cast(kind).isNotNull())
        parts.append(F.struct(
            F.lit(c).alias("column"), F.count(F.lit(1)).alias("rows"), F.count_if(text.isNull()).alias("nulls"), F.hll_sketch_agg(text, F.lit(LOG_K)).alias("sketch"),
            F.min(text).alias("low"), F.max(text).alias("high"), reads("bigint").alias("integers"), reads("double").alias("numbers"), reads("date").alias("dates"),
        ))
    return df.groupBy(*by).agg(F.array(*parts).alias("p")).select(*by, F.inline("p"))


def merged(states: DataFrame) -> DataFrame:
    """The states of a union of tables from the states of each; columns that some lack are merged over those that have them."""
    total = [F.sum(c).alias(c) for c in ("rows", "nulls")]
    return states.groupBy("column").agg(*total, F.hll_union_agg("sketch").alias("sketch"), F.min("low").alias("low"), F.max("high").alias("high"), *[F.sum(c).alias(c) for c in ("integers", "numbers", "dates")])


def shown(states: DataFrame) -> DataFrame:
    """A row per column: column, rows, nulls, null_share, values (estimated), low, high, inferred (empty, integer, number, date or text)."""
    there = F.col("rows") - F.col("nulls")
    inferred = F.when(there == 0, "empty").when(F.col("integers") == there, "integer").when(F.col("numbers") == there, "number").when(F.col("dates") == there, "date").otherwise("text")
    share = F.round(F.try_divide(F.col("nulls").cast("double"), F.col("rows")), 6)
    return states.select("column", "rows", "nulls", share.alias("null_share"), F.hll_sketch_estimate("sketch").alias("values"), "low", "high", inferred.alias("inferred"))


def _long(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    """(column, value) rows of the values that are not null, as text; zeros have no sign."""
    kinds = dict(df.dtypes)
    value = lambda c: (F.col(f"`{c}`") + F.lit(0.0) if kinds[c] in ("float", "double") else F.col(f"`{c}`")).cast("string")
    rows = F.array(*[F.struct(F.lit(c).alias("column"), value(c).alias("value")) for c in columns or df.columns])
    return df.select(F.inline(rows)).filter("value IS NOT NULL")


def exact_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, values): exact numbers of distinct values, counted on two levels, so that no task holds a column's values."""
    return _long(df, columns).groupBy("column", "value").agg(F.lit(1).alias("one")).groupBy("column").agg(F.count(F.lit(1)).alias("values"))


def frequent(df: DataFrame, columns: Sequence[str] | None = None, most: int = 5) -> DataFrame:
    """(column, place, value, n): each column's most frequent values, ties by value; counted exactly, with partial sums before the shuffle.

    Of a column's counts each task keeps `most`, and only these meet.
    """
    from pyspark.sql import Window

    counts = _long(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    salted = counts.withColumn("salt", F.pmod(F.xxhash64("value"), F.lit(256)))
    order = [F.desc("n"), F.asc("value")]
    first = salted.withColumn("place", F.row_number().over(Window.partitionBy("column", "salt").orderBy(*order))).filter(F.col("place") <= most)
    return first.withColumn("place", F.row_number().over(Window.partitionBy("column").orderBy(*order))).filter(F.col("place") <= most).select("column", "place", "value", "n")


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, parts)


def close(estimate: Column, exact: Column, share: float = 0.05) -> Column:
    """Whether an estimate is within a share of the exact number."""
    return F.abs(estimate - exact) <= F.lit(share) * exact
