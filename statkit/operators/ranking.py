"""Order-dependent operators. Each takes the order it depends on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statkit.operators.shared import written


def keep_one(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__place", place).filter("__place = 1").drop("__place")


def ranks(df: DataFrame, unit: Sequence[str], measure: str, category: str) -> DataFrame:
    """place (1 is the largest; ties by category), rank_up, rank_down and whether it dominates its unit."""
    down = Window.partitionBy(*unit).orderBy(F.desc(measure), category)
    return df.withColumns({
        "place": F.row_number().over(down),
        "rank_down": F.rank().over(Window.partitionBy(*unit).orderBy(F.desc(measure))),
        "rank_up": F.rank().over(Window.partitionBy(*unit).orderBy(measure)),
    }).withColumn("dominant", F.col("place") == 1)


def top_and_rest(ranked: DataFrame, unit: Sequence[str], measure: str, category: str) -> DataFrame:
    """The dominant and the second category, and the rest's total and sorted names, a row per unit."""
    rest = F.col("place") > 2
    return ranked.groupBy(*unit).agg(
        F.max(F.when(F.col("place") == 1, F.col(category))).alias("first"),
        F.max(F.when(F.col("place") == 2, F.col(category))).alias("second"),
        F.coalesce(F.sum(F.when(rest, F.col(measure))), F.lit(0)).alias("rest"),
        F.array_join(F.array_sort(F.collect_list(F.when(rest, F.col(category)))), ", ").alias("others"),
    )


def fill_forward(df: DataFrame, within: Sequence[str], order: Sequence[str], columns: Sequence[str], when: Column | None = None) -> DataFrame:
    """Nulls take the last value before them, only where `when` holds if given."""
    past = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    filled = {c: F.last(c, ignorenulls=True).over(past) for c in columns}
    return df.withColumns({c: f if when is None else F.when(when, f).otherwise(F.col(c)) for c, f in filled.items()})


def counter(df: DataFrame, within: Sequence[str], order: Sequence[str | Column], name: str = "n") -> DataFrame:
    """Running number in each group."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*within).orderBy(*order)))


def numbered(df: DataFrame, order: Sequence[str], name: str = "id", start: int = 0) -> DataFrame:
    """Consecutive ids by a total order, without sorting in one task.

    Rows are range-partitioned by the order, sorted and written once with their partition and their place in it; the first
    id of a partition is the number of rows before it. Written, since two reads of one range partitioning may sample
    different bounds. The partitions' sizes are a row each, so they are broadcast.
    """
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at, part, size, before = (f"{'_' * max(map(len, df.columns))}{c}" for c in ("at", "part", "size", "before"))  # longer than df's names
    place = F.monotonically_increasing_id()  # the partition in the upper 31 bits, the row in the lower 33
    parts = written(df.repartitionByRange(width, *order).sortWithinPartitions(*order).withColumn(at, place), "numbered")
    sizes = parts.groupBy(F.shiftright(at, 33).alias(part)).agg(F.count(F.lit(1)).alias(size))
    earlier = F.coalesce(F.sum(size).over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    found = parts.withColumn(part, F.shiftright(at, 33)).join(F.broadcast(sizes.select(part, earlier.alias(before))), part)
    return found.withColumn(name, F.col(before) + F.col(at) % (1 << 33) + 1 + start).drop(part, at, before)


def limited(df: DataFrame, most: int, narrow: Sequence[str] = ()) -> DataFrame:
    """df, unless it has more than `most` rows: then an error that names the parameters to narrow it by (O2)."""
    if df.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows; narrow the query by {', '.join(narrow) or 'a filter'}")
    return df
