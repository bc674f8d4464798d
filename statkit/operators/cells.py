"""Areal operators over cell tables: layers are sets of square grid cells, so overlays are equi-joins.

Exact for rectangles on the grid; for others the error is bounded by the cells on the outline.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statkit.operators.rates import ratio
from statkit.operators.shared import shuffled


TASK_CELLS = 1 << 20  #: about so many cells are made in one task


def cover(boxes: DataFrame, keys: Sequence[str], x0: str, y0: str, x1: str, y1: str, size: float = 1.0) -> DataFrame:
    """(keys, cx, cy): the cells of each half-open box (G1).

    Boxes are dealt to tasks by the number of cells they give, since a small file of boxes is read by few tasks.
    """
    cells = lambda a, b: F.sequence(F.floor(F.col(a) / size), F.ceil(F.col(b) / size) - 1)
    valid = boxes.filter((F.col(x1) > F.col(x0)) & (F.col(y1) > F.col(y0)))
    side = lambda a, b: (F.ceil(F.col(b) / size) - F.floor(F.col(a) / size)).cast("double")
    tasks = int((valid.agg(F.sum(side(x0, x1) * side(y0, y1)).alias("n")).first()["n"] or 0) // TASK_CELLS) + 1
    if tasks > 1:
        valid = valid.select(*dict.fromkeys((*keys, x0, y0, x1, y1))).repartition(tasks)
    return valid.withColumn("cx", F.explode(cells(x0, x1))).withColumn("cy", F.explode(cells(y0, y1))).select(*keys, "cx", "cy")


def candidates(left: DataFrame, right: DataFrame, a: str, b: str) -> DataFrame:
    """Pairs that share a cell (G1)."""
    return left.join(shuffled(right), ["cx", "cy"]).select(a, b).distinct()


def overlay(left: DataFrame, right: DataFrame, a: str, b: str, size: float = 1.0) -> DataFrame:
    """Area of each pair's intersection, and its share of either side in percent."""
    area = lambda d, k, n: d.groupBy(k).agg((F.count(F.lit(1)) * F.lit(size * size)).alias(n))
    both = left.join(shuffled(right), ["cx", "cy"]).groupBy(a, b).agg((F.count(F.lit(1)) * F.lit(size * size)).alias("area"))
    both = both.join(shuffled(area(left, a, "area_a")), a).join(shuffled(area(right, b, "area_b")), b)
    return both.select(a, b, "area", ratio(F.col("area"), F.col("area_a"), 100, 6).alias("share_a"), ratio(F.col("area"), F.col("area_b"), 100, 6).alias("share_b"))


def dissolve(cells: DataFrame, key: str, size: float = 1.0) -> DataFrame:
    """Area of each key's union."""
    return cells.select(key, "cx", "cy").distinct().groupBy(key).agg((F.count(F.lit(1)) * F.lit(size * size)).alias("area"))


def masks(left: DataFrame, right: DataFrame, size: float = 1.0) -> DataFrame:
    """One row: areas of the union, the intersection and both differences of two layers."""
    side = lambda d, n: d.select("cx", "cy").distinct().withColumn(n, F.lit(True))
    both = side(left, "l").join(shuffled(side(right, "r")), ["cx", "cy"], "full")
    area = lambda c: F.count_if(c) * F.lit(size * size)
    l, r = F.col("l").isNotNull(), F.col("r").isNotNull()  # noqa: E741
    return both.agg(area(l | r).alias("union_area"), area(l & r).alias("both_area"), area(l & ~r).alias("left_only"), area(~l & r).alias("right_only"))


def clip(cells: DataFrame, mask: DataFrame) -> DataFrame:
    """Cells inside a mask."""
    return cells.join(shuffled(mask.select("cx", "cy").distinct()), ["cx", "cy"], "left_semi")


def self_overlaps(cells: DataFrame, key: str, size: float = 1.0) -> DataFrame:
    """Cells that several keys claim, as one row: cells and area."""
    # two keys at least if the smallest is not the largest; counting them would keep each key of a cell
    shared = cells.groupBy("cx", "cy").agg(F.min(key).alias("low"), F.max(key).alias("high")).filter("low < high")
    return shared.agg(F.count(F.lit(1)).alias("cells"), (F.count(F.lit(1)) * F.lit(size * size)).alias("area"))


def point(x: Column, y: Column, west: float, south: float, east: float, north: float) -> Column:
    """A point, or null outside the envelope; the row stays."""
    return F.when(x.between(west, east) & y.between(south, north), F.struct(x.alias("x"), y.alias("y")))
