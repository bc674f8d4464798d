"""Reshaping wide, nested and listed inputs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unpivot_months(df: DataFrame, ids: Sequence[str], months: Mapping[str, int], name: str = "month", value: str = "n", drop_zero: bool = True) -> DataFrame:
    """Wide months to rows; null (and zero) counts dropped (R1). One pass, no shuffle."""
    pairs = F.array(*[F.struct(F.lit(i).alias(name), F.col(c).alias(value)) for c, i in months.items()])
    long = df.select(*ids, F.inline(pairs))
    return long.filter(F.col(value) != 0) if drop_zero else long.filter(F.col(value).isNotNull())


def melt(df: DataFrame, ids: Sequence[str], measures: Mapping[str, object], name: str = "measure", value: str = "value") -> DataFrame:
    """Measure columns to rows, each named by its id (R2)."""
    return df.select(*ids, F.inline(F.array(*[F.struct(F.lit(i).alias(name), F.col(c).cast("double").alias(value)) for c, i in measures.items()])))


def tidy_years(df: DataFrame, ids: Sequence[str], measures: Sequence[str], years: Sequence[int], pattern: str = "{measure}_{year}") -> DataFrame:
    """Columns such as {measure}_{year} to a row per year with a column per measure."""
    rows = [F.struct(F.lit(y).alias("year"), *[F.col(pattern.format(measure=m, year=y)).alias(m) for m in measures]) for y in years]
    return df.select(*ids, F.inline(F.array(*rows)))


def pivot_first(df: DataFrame, ids: Sequence[str], column: str, values: Sequence, value: str) -> DataFrame:
    """A column per value with its first non-null entry (R4): by the smallest, so that reruns agree."""
    return df.groupBy(*ids).agg(*[F.min(F.when(F.col(column) == v, F.col(value))).alias(str(v)) for v in values])


def split_levels(df: DataFrame, levels: Mapping[str, Column], check: bool = True) -> DataFrame:
    """A `level` column; fails if a row meets no level's condition or several."""
    met = sum((F.coalesce(c.cast("int"), F.lit(0)) for c in levels.values()), F.lit(0))
    level = F
    for name, condition in levels.items():
        level = level.when(condition, name)
    out = df.withColumn("level", level)
    if check:
        bad = df.filter(met != 1).limit(3).collect()
        if bad:
            raise ValueError(f"rows of no level or of several: {bad}")
    return out


def outline(df: DataFrame, cells: Sequence[str], order: str, within: Sequence[str] = ()) -> DataFrame:
    """An indented outline to rows (R7): level (1 from the left), code, label (the next cell) and parent (last code a level up).

    The hierarchy follows the indentation, not the code's prefix. `within` partitions independent outlines.
    """
    first = F.array_position(F.transform(F.array(*cells), lambda c: c.isNotNull() & (F.trim(c) != "")), True).cast("int")
    rows = df.withColumn("level", first).filter("level > 0")
    rows = rows.withColumns({"code": F.element_at(F.array(*cells), F.col("level")), "label": F.try_element_at(F.array(*cells), F.col("level") + 1)})
    past = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    last = [F.last(F.when(F.col("level") == i, F.col("code")), ignorenulls=True).over(past) for i in range(1, len(cells))]
    parent = F
    for i, c in enumerate(last, 2):
        parent = parent.when(F.col("level") == i, c)
    return rows.select(*within, order, "level", "code", "label", parent.alias("parent"))


def list_bridge(df: DataFrame, key: str, column: str, name: str, sep: str = ",") -> DataFrame:
    """Distinct (key, item) rows of a delimited list of numbers; other items are dropped."""
    items = df.select(key, F.explode(F.split(column, sep)).alias("__item")).select(key, F.trim("__item").try_cast("int").alias(name))
    return items.filter(F.col(name).isNotNull()).distinct()


def expand_ranges(df: DataFrame, column: str, name: str) -> DataFrame:
    """Rows "2 - 3" to a row for each number; a single number is one row."""
    low = F.regexp_extract(column, "^\\s*([0-9]+)", 1).try_cast("int")
    high = F.coalesce(F.regexp_extract(column, "-\\s*([0-9]+)\\s*$", 1).try_cast("int"), low)
    return df.withColumn(name, F.explode(F.when(low <= high, F.sequence(low, high))))
