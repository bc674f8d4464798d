"""Areas as quadtree cells: a layer's inner cells are large, only its outline is fine, so rows grow with outlines, not areas.

A cell is (level, code): its side is 2 ** level unit cells, and code is the Morton code of its place among cells of its
level, so an ancestor's code is a prefix of its descendants': the code without its last 2 bits for each level. Two cells
share area only if one is a prefix of the other; then they share the smaller one. An overlay therefore joins cells with
equal prefixes, at the levels that the other layer has.

Layers of boxes need no fine cells: `tiles` keeps each box's edges in the few cells of its own size, which meet likewise.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statkit.operators.rates import ratio
from statkit.operators.shared import shuffled, written

BITS = 24  #: unit cells on a side of the root: 2 ** BITS; the middle is the origin
#: (shift, mask) of the steps that put a zero between each two bits
SPREAD = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))


def _spread(x: Column) -> Column:
    return functools.reduce(lambda v, s: v.bitwiseOR(F.shiftleft(v, s[0])).bitwiseAND(F.lit(s[1])), SPREAD, x.cast("long"))


def morton(x: Column, y: Column) -> Column:
    """The bits of x and y in turn, x the lower ones."""
    return _spread(x).bitwiseOR(F.shiftleft(_spread(y), 1))


def quads(boxes: DataFrame, keys: Sequence[str], x0: str, y0: str, x1: str, y1: str, size: float = 1.0) -> DataFrame:
    """(keys, level, code): each half-open box as its largest cells, on a grid of side `size`; a box off the grid is widened to it (G1).

    At each level a box holds the cells of a rectangle, and all but a frame of it are children of the level above; so a box
    gives at most about 8 rows a unit of its outline. Empty boxes and those with a null edge give none.
    """
    off = 1 << (BITS - 1)
    edge = lambda c, up: ((F.ceil if up else F.floor)(F.col(c) / size) + off).cast("long")
    valid = boxes.filter((F.col(x1) > F.col(x0)) & (F.col(y1) > F.col(y0)))
    rows = valid.select(*keys, F.struct(edge(x0, False).alias("ax"), edge(y0, False).alias("ay"), edge(x1, True).alias("bx"), edge(y1, True).alias("by")).alias("__box"))
    rows = rows.withColumn("__level", F.explode(F.sequence(F.lit(0), F.lit(BITS))))

    def at(level: Column) -> list[Column]:
        side = F.call_function("shiftleft", F.lit(1).cast("long"), level)
        return [F.ceil(F.col("__box.ax") / side), F.floor(F.col("__box.bx") / side), F.ceil(F.col("__box.ay") / side), F.floor(F.col("__box.by") / side)]

    here, above = at(F.col("__level")), at(F.col("__level") + 1)
    rows = rows.select(*keys, "__level", *[c.cast("long").alias(n) for c, n in zip(here, ("__l", "__r", "__b", "__t"), strict=True)], *[(2 * c).cast("long").alias(n) for c, n in zip(above, ("__il", "__ir", "__ib", "__it"), strict=True)])
    rows = rows.filter("__l < __r AND __b < __t")
    strip = lambda l, r, b, t: F.struct(F.col(l).alias("l"), F.col(r).alias("r"), F.col(b).alias("b"), F.col(t).alias("t"))  # noqa: E731, E741
    whole = F.array(strip("__l", "__r", "__b", "__t"))
    frame = F.array(strip("__l", "__il", "__b", "__t"), strip("__ir", "__r", "__b", "__t"), strip("__il", "__ir", "__b", "__ib"), strip("__il", "__ir", "__it", "__t"))
    rows = rows.select(*keys, "__level", F.explode(F.when(F.expr("__il < __ir AND __ib < __it"), frame).otherwise(whole)).alias("s")).filter("s.l < s.r AND s.b < s.t")
    rows = rows.withColumn("__x", F.explode(F.sequence(F.col("s.l"), F.col("s.r") - 1))).withColumn("__y", F.explode(F.sequence(F.col("s.b"), F.col("s.t") - 1)))
    return rows.select(*keys, F.col("__level").alias("level"), morton(F.col("__x"), F.col("__y")).alias("code"))


def tiles(boxes: DataFrame, keys: Sequence[str], x0: str, y0: str, x1: str, y1: str, size: float = 1.0) -> DataFrame:
    """(keys, level, code, ax, ay, bx, by): each half-open box as its parts in the cells of its own size, at most four (G1).

    Edges are whole numbers on a grid of side `size`; a box off the grid is widened to it. So rows grow with the number of
    boxes, not with their outlines. Empty boxes and those with a null edge give none.
    """
    off = 1 << (BITS - 1)
    edge = lambda c, up: ((F.ceil if up else F.floor)(F.col(c) / size) + off).cast("long")
    valid = boxes.filter((F.col(x1) > F.col(x0)) & (F.col(y1) > F.col(y0)))
    rows = valid.select(*keys, F.struct(edge(x0, False).alias("ax"), edge(y0, False).alias("ay"), edge(x1, True).alias("bx"), edge(y1, True).alias("by")).alias("__box"))
    longest = F.greatest(F.col("__box.bx") - F.col("__box.ax"), F.col("__box.by") - F.col("__box.ay"))
    rows = rows.withColumn("level", F.when(longest > 1, F.length(F.bin(longest - 1))).otherwise(0))  # the first power of 2 that is no less
    cell = lambda c: F.call_function("shiftright", c, F.col("level"))
    edge_of = lambda c: F.call_function("shiftleft", c, F.col("level"))
    for at, low, high in (("__x", "ax", "bx"), ("__y", "ay", "by")):
        rows = rows.withColumn(at, F.explode(F.sequence(cell(F.col(f"__box.{low}")), cell(F.col(f"__box.{high}") - 1))))
    part = [(F.greatest(F.col(f"__box.a{c}"), edge_of(F.col(f"__{c}"))).alias(f"a{c}"), F.least(F.col(f"__box.b{c}"), edge_of(F.col(f"__{c}") + 1)).alias(f"b{c}")) for c in "xy"]
    return rows.select(*keys, "level", morton(F.col("__x"), F.col("__y")).alias("code"), part[0][0], part[1][0], part[0][1], part[1][1])


def from_cells(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, level, code) of unit cells (keys, cx, cy), four siblings merged into their parent, level by level (G1).

    A level's rows are those that merged below it, so each round has at most a quarter of the rows before.
    """
    off = 1 << (BITS - 1)
    now = written(cells.select(*keys, morton(F.col("cx") + off, F.col("cy") + off).alias("code")).distinct(), "cells")
    done, level = None, 0
    while True:
        parents = now.groupBy(*keys, F.shiftright("code", 2).alias("__up")).agg(F.count(F.lit(1)).alias("__n"), F.collect_list("code").alias("__codes"))  # at most four
        parents = written(parents, "quads")
        rest = parents.filter("__n < 4").select(*keys, F.lit(level).alias("level"), F.explode("__codes").alias("code"))
        done = rest if done is None else done.unionByName(rest)
        now, level = parents.filter("__n = 4").select(*keys, F.col("__up").alias("code")), level + 1
        if not now.take(1):
            return done


def _area(level: Column, size: float) -> Column:
    return F.pow(F.lit(4.0), level) * F.lit(size * size)


def _levels(quads: DataFrame) -> list[int]:
    return sorted(r["level"] for r in quads.select("level").distinct().collect())  # at most BITS + 1


def _prefixes(quads: DataFrame, levels: Sequence[int], strict: bool) -> DataFrame:
    """quads (level, code) with each ancestor (or itself, unless strict) at one of the levels, as up_level and up_code."""
    # each row's own levels only: those it has not would be rows to no use
    wanted = F.filter(F.array(*[F.lit(n) for n in levels]), lambda n: n > F.col("level") if strict else n >= F.col("level"))
    rows = quads.withColumn("up_level", F.explode(wanted))
    return rows.withColumn("up_code", F.call_function("shiftright", "code", ((F.col("up_level") - F.col("level")) * 2).cast("int")))


def dissolved(quads: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The cells of each key's union: none twice, and none inside another of its key.

    For exact areas where a key has several boxes that overlap; its result is disjoint, which `overlay` and `areas` need.
    """
    once = written(quads.select(*keys, "level", "code").distinct(), "quads")
    inside = _prefixes(once, _levels(once), strict=True)
    up = once.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("level").alias("__level"), F.col("code").alias("__code"))
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys] + [F.col("up_level") == F.col("__level"), F.col("up_code") == F.col("__code")]
    every = (*keys, "level", "code")
    lost = inside.join(up, functools.reduce(Column.__and__, same), "left_semi").select(*[F.col(c).alias(f"__{c}") for c in every]).distinct()
    return once.join(lost, functools.reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in every]), "left_anti")


def areas(quads: DataFrame, keys: Sequence[str], size: float = 1.0) -> DataFrame:
    """Area of each key's cells, which must be disjoint."""
    return quads.groupBy(*keys).agg(F.sum(_area(F.col("level"), size)).alias("area"))


def shared(left: DataFrame, right: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b, level, code): the cells that both layers have, with their keys; names and codes of either side's smaller cell."""
    l = left.select(F.col(a).alias("__a"), "level", "code")  # noqa: E741
    r = right.select(F.col(b).alias("__b"), "level", "code")
    ends = lambda d, k: d.select(k, F.col("level").alias("up_level"), F.col("code").alias("up_code"))
    small_left = _prefixes(l, _levels(r), strict=False).join(shuffled(ends(r, "__b")), ["up_level", "up_code"])
    small_right = _prefixes(r, _levels(l), strict=True).join(shuffled(ends(l, "__a")), ["up_level", "up_code"])
    out = [d.select(F.col("__a").alias(a), F.col("__b").alias(b), "level", "code") for d in (small_left, small_right)]
    return out[0].unionByName(out[1])


def overlay(left: DataFrame, right: DataFrame, a: str, b: str, size: float = 1.0) -> DataFrame:
    """Area of each pair's intersection, and its share of either side in percent (G2). Each key's cells must be disjoint."""
    both = shared(left, right, a, b).groupBy(a, b).agg(F.sum(_area(F.col("level"), size)).alias("area"))
    return _shares(both, areas(left, [a], size), areas(right, [b], size), a, b)


def _shares(both: DataFrame, of_a: DataFrame, of_b: DataFrame, a: str, b: str) -> DataFrame:
    both = both.join(shuffled(of_a.withColumnRenamed("area", "area_a")), a).join(shuffled(of_b.withColumnRenamed("area", "area_b")), b)
    return both.select(a, b, "area", ratio(F.col("area"), F.col("area_a"), 100, 6).alias("share_a"), ratio(F.col("area"), F.col("area_b"), 100, 6).alias("share_b"))


def tile_areas(tiles: DataFrame, keys: Sequence[str], size: float = 1.0) -> DataFrame:
    """Area of each key's boxes, which must be disjoint."""
    return tiles.groupBy(*keys).agg((F.sum((F.col("bx") - F.col("ax")) * (F.col("by") - F.col("ay"))) * F.lit(size * size)).alias("area"))


def shared_tiles(left: DataFrame, right: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b, ax, ay, bx, by): what the boxes of two layers of tiles share, by prefix joins of their cells."""
    edges = ("ax", "ay", "bx", "by")
    l = left.select(F.col(a).alias("__a"), "level", "code", *edges)  # noqa: E741
    r = right.select(F.col(b).alias("__b"), "level", "code", *edges)
    ends = lambda d, k: d.select(k, F.col("level").alias("up_level"), F.col("code").alias("up_code"), *[F.col(c).alias(f"__{c}") for c in edges])
    small_left = _prefixes(l, _levels(r), strict=False).join(shuffled(ends(r, "__b")), ["up_level", "up_code"])
    small_right = _prefixes(r, _levels(l), strict=True).join(shuffled(ends(l, "__a")), ["up_level", "up_code"])
    inner = [(F.greatest if c[0] == "a" else F.least)(c, f"__{c}").alias(c) for c in edges]
    out = [d.select(F.col("__a").alias(a), F.col("__b").alias(b), *inner).filter("ax < bx AND ay < by") for d in (small_left, small_right)]
    return out[0].unionByName(out[1])


def overlay_tiles(left: DataFrame, right: DataFrame, a: str, b: str, size: float = 1.0) -> DataFrame:
    """`overlay` of two layers of tiles. Each key's boxes must be disjoint."""
    return _shares(tile_areas(shared_tiles(left, right, a, b), [a, b], size), tile_areas(left, [a], size), tile_areas(right, [b], size), a, b)


def united_areas(boxes: DataFrame, keys: Sequence[str], size: float = 1.0) -> DataFrame:
    """Area of the union of each key's boxes (ax, ay, bx, by), which may overlap.

    Along each row of the grid, of the boxes that begin at one place the longest counts; so the rows that meet are bounded
    by the grid, however many boxes lie there.
    """
    once = boxes.select(*keys, "ax", "ay", "bx", "by").distinct()
    rows = once.withColumn("__y", F.explode(F.sequence(F.col("ay"), F.col("by") - 1)))
    longest = rows.groupBy(*keys, "__y", "ax").agg(F.max("bx").alias("bx"))
    before = F.max("bx").over(Window.partitionBy(*keys, "__y").orderBy("ax").rowsBetween(Window.unboundedPreceding, -1))
    new = longest.withColumn("__new", F.greatest(F.lit(0).cast("long"), F.col("bx") - F.greatest("ax", before)))  # greatest passes over nulls
    return new.groupBy(*keys).agg((F.sum("__new") * F.lit(size * size)).alias("area"))


def masks(left: DataFrame, right: DataFrame, size: float = 1.0) -> DataFrame:
    """One row: areas of the union, the intersection and both differences of two layers."""
    one = lambda d, k: written(dissolved(d.select(F.lit(1).alias(k), "level", "code"), [k]), "mask")
    l, r = one(left, "__l"), one(right, "__r")  # noqa: E741
    total = lambda d, n: d.agg(F.coalesce(F.sum(_area(F.col("level"), size)), F.lit(0.0)).alias(n))
    parts = F.broadcast(total(r, "r")).crossJoin(F.broadcast(total(shared(l, r, "__l", "__r"), "both_area")))  # one row each
    parts = total(l, "l").crossJoin(parts)
    return parts.select((F.col("l") + F.col("r") - F.col("both_area")).alias("union_area"), "both_area", (F.col("l") - F.col("both_area")).alias("left_only"), (F.col("r") - F.col("both_area")).alias("right_only"))
