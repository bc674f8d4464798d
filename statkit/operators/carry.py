"""Carry scans: what rows hand on along one long order, without groups and without a task that holds all rows.

Rows are range-partitioned by the order and written once; each partition's summary (its last values, its count) is one row,
a prefix over these few rows gives what comes into each partition, and the rest is local to it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statkit.operators.shared import written

PART_BYTES = 64 << 20  #: a range partition holds about so many bytes by the plan's estimate


def parts_for(df: DataFrame, least: int = 1) -> int:
    """Range partitions for df: by its estimated size, and at least `least`."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return int(min(max(-(-size // PART_BYTES), least), 1 << 16))


def _names(df: DataFrame, *names: str) -> list[str]:
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def laid_out(df: DataFrame, order: Sequence[str], parts: int | None = None) -> tuple[DataFrame, str, str]:
    """df written in range partitions by a total order, and the names of two columns: the partition, and the place in it."""
    part, at = _names(df, "part", "at")
    parts = parts or parts_for(df, df.sparkSession.sparkContext.defaultParallelism)
    place = F.monotonically_increasing_id()  # the partition in the upper 31 bits, the row in the lower 33
    rows = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn(at, place)
    rows = written(rows, "carry")
    return rows.withColumns({part: F.shiftright(at, 33), at: F.col(at) % (1 << 33)}), part, at


def _before(part: str) -> Window:
    return Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # over a row for each partition


def fill_down(df: DataFrame, order: Sequence[str], columns: Sequence[str], when: Column | None = None, parts: int | None = None) -> DataFrame:
    """Nulls take the last value before them along a total order; only where `when` holds if given.

    Values before the first one stay null. All columns of df, whatever their names; an empty table gives no rows.
    """
    rows, part, at = laid_out(df, order, parts)
    last = rows.groupBy(part).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(at))).alias(c) for c in columns])
    (there,) = _names(rows, "there")
    came = last.select(F.col(part).alias(there), F.struct(*[F.last(c, ignorenulls=True).over(_before(part)).alias(c) for c in columns]).alias(f"{there}_c"))
    out = rows.join(F.broadcast(came), F.col(part) == F.col(there))  # a row for each partition
    here = Window.partitionBy(part).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    filled = {c: F.coalesce(F.last(c, ignorenulls=True).over(here), F.col(f"{there}_c")[c]) for c in columns}
    out = out.withColumns({c: f if when is None else F.when(when, f).otherwise(F.col(c)) for c, f in filled.items()})
    return out.select(*[F.col(f"`{c}`") for c in df.columns])


def count_on(df: DataFrame, order: Sequence[str], starts: Column | None = None, number: str = "n", block: str = "block", parts: int | None = None) -> DataFrame:
    """df with a running number along a total order, from 1, and the number of its block.

    starts: rows that begin a new block, where the number begins again; without it there is one block. Rows before the first
    start are block 0. A null counts as no start.
    """
    (first,) = _names(df, "first")
    rows, part, at = laid_out(df.withColumn(first, F.coalesce(starts, F.lit(False)) if starts is not None else F.lit(False)), order, parts)
    sums = rows.groupBy(part).agg(F.count(F.lit(1)).alias("rows"), F.count_if(first).alias("blocks"), F.max(F.when(F.col(first), F.col(at))).alias("last"))
    prefix = _before(part)
    # rows since the last start that lies before the partition: all rows before it less those up to that start
    total = F.coalesce(F.sum("rows").over(prefix), F.lit(0))
    sums = sums.withColumn("total", total)
    sums = sums.withColumn("began", F.col("total") + F.col("last"))
    (there,) = _names(rows, "there")
    came = sums.select(F.col(part).alias(there), F.struct((F.col("total") - F.coalesce(F.max("began").over(prefix), F.lit(0))).alias("rows"), F.coalesce(F.sum("blocks").over(prefix), F.lit(0)).alias("blocks")).alias(f"{there}_c"))
    out = rows.join(F.broadcast(came), F.col(part) == F.col(there))
    here = Window.partitionBy(part).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    since = F.max(F.when(F.col(first), F.col(at))).over(here)
    n = F.when(since.isNull(), F.col(f"{there}_c")["rows"] + F.col(at) + 1).otherwise(F.col(at) - since + 1)
    blocks = F.col(f"{there}_c")["blocks"] + F.count_if(first).over(here)
    return out.select(*[F.col(f"`{c}`") for c in df.columns], n.alias(number), blocks.alias(block))


def outline(df: DataFrame, order: Sequence[str], levels: Mapping[str, Column], parts: int | None = None) -> DataFrame:
    """df with each level's heading that a row stands under, along a total order.

    levels: name of the new column and its value on rows that are a heading of that level (else null), from the highest
    down. A heading ends those of lower levels: a row under a new chapter has no section until one comes.
    """
    (pos,) = _names(df, "pos")
    numbered = count_on(df, order, number=pos, block=f"{pos}_b", parts=parts).drop(f"{pos}_b")
    marks = {f"{pos}_{i}": F.when(v.isNotNull(), F.struct(F.col(pos).alias("at"), v.alias("value"))) for i, v in enumerate(levels.values())}
    rows = fill_down(numbered.withColumns(marks), [pos], list(marks), parts=parts)
    shown, above = {}, F.lit(0).cast("long")
    for name, mark in zip(levels, marks, strict=True):
        shown[name] = F.when(F.col(mark)["at"] > above, F.col(mark)["value"])
        above = F.greatest(above, F.coalesce(F.col(mark)["at"], F.lit(0)))
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], *[v.alias(n) for n, v in shown.items()])
