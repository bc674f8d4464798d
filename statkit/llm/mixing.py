"""Mixing sources to target weights by Pareto order sampling.

A source's target is its share by weight of a budget, capped at a multiple of its size (water filling). Each document
first gets as many certain whole copies as its source's target holds whole source sizes. For what is left (the quota), a
document's inclusion probability p is proportional to the square root of its size, so that long documents are likelier;
those whose p would reach 1 are certain: they are taken, and the others' p is formed from the quota that is left to them.
The others are ranked by random odds over inclusion odds, (U / (1 - U)) / (p / (1 - p)), and taken in that order until
the source's words are reached. U is a hash of the document, so that reruns agree.

The order of a source is never sorted in one task: ranks are cut into GRID slices whose words are summed, and only the
slice where the sum passes the quota is sorted. A document's copies then follow from its own rank and its source's cut, so
that no text is shuffled.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statkit.operators.ranking import numbered

from .common import broadcast_if, own_columns, stored, unit_hash, whole_text

GRID = 1 << 14  #: slices of the ranks of a source
SALTS = 256  #: parts that equal rows are dealt into for numbering


def row_key() -> Column:
    """A number by which rows that agree in doc_id, source and text are found; others may share it."""
    return F.xxhash64("doc_id", "source", whole_text())


def second_key() -> Column:
    """Another 64 bits of the text, which tell rows apart that only share a key."""
    return F.xxhash64(F.lit(2), whole_text())


def word_count(text: Column) -> Column:
    """Number of runs of characters other than space and tab to carriage return; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: list[float], share: float, most: float) -> DataFrame:
    """Per source: source_size and target. sizes: (source, size) rows.

    Sources by code point, null last, weigh as in weights, repeated. Their targets share `share` of all sizes; a target
    stops at `most` times its source's size and the excess goes to the others by weight. With the water level L a target is
    min(most * size, weight * L). L rises in rounds: what is over the caps at one level is dealt to those below theirs,
    until no further source reaches its cap; a round is one aggregation over the sources, which may be very many.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = per.select(F.col("source").isNull().alias("last"), "source", "source_size")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    per = numbered(per, ["last", "source"], "place", start=-1).withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    per = stored(per.select("source", "source_size", "weight", "cap"), "sources")
    whole = per.agg(F.sum("source_size").alias("size"), F.sum("cap").alias("cap"), F.sum("weight").alias("weight")).first()
    budget = min(float(share) * (whole["size"] or 0), whole["cap"] or 0.0)
    level, n = budget / whole["weight"] if whole["weight"] else 0.0, 0
    while True:
        full = F.col("cap") <= F.col("weight") * F.lit(level)
        now = per.agg(F.count_if(full).alias("n"), F.sum(F.when(full, F.col("cap"))).alias("cap"), F.sum(F.when(~full, F.col("weight"))).alias("weight")).first()
        if now["n"] == n or not now["weight"]:  # nothing more is full, or everything is
            break
        level, n = (budget - (now["cap"] or 0.0)) / now["weight"], now["n"]
    return per.select("source", "source_size", F.least("cap", F.col("weight") * F.lit(level)).alias("target"))


def _certain(rows: DataFrame, per: DataFrame) -> DataFrame:
    """Per source: scale and least. Documents of at least `least` words are certain, the others' p is scale * sqrt(size).

    From a source's histogram of sizes, by falling size: a size is certain if the quota that the larger ones leave would
    give it a p of 1 or more.
    """
    sizes = rows.filter("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.join(per.select(F.col("source").alias("s2"), "quota"), F.col("source").eqNullSafe(F.col("s2"))).drop("s2")
    by = Window.partitionBy("source")
    larger = by.orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    others = by.orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    root = F.sqrt(F.col("size").cast("double"))
    sizes = sizes.withColumn("left", F.col("quota") - F.coalesce(F.sum(F.col("n") * F.col("size")).over(larger), F.lit(0)))
    sizes = sizes.withColumn("rest", F.sum(F.col("n") * F.col("size") * root).over(others)).withColumn("scale", F.col("left") / F.col("rest"))
    sure = F.col("scale") * root >= 1
    return sizes.groupBy("source").agg(F.min(F.when(sure, F.col("size"))).alias("least"), F.max_by(F.when(sure, F.lit(0.0)).otherwise(F.col("scale")), F.when(~sure, F.col("size"))).alias("scale"))


def _plan(docs: DataFrame, weights: list[float], share: float, most: float, seed: int) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """(rows, per source, per source's cut, number of sources). rows: doc_id, source, size, h (of doc_id, source and text), n, nth, row."""
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), row_key().alias("h"), second_key().alias("h2"), F.monotonically_increasing_id().alias("row"))
    rows = stored(rows, "sizes")
    # rows that agree in doc_id, source and text are numbered, so that each has a U of its own; equal ones are as many tasks as salts
    equal = rows.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    equal = stored(equal, "equal")
    some = equal.count()
    if some:
        again = rows.join(broadcast_if(equal, some), "h").withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)))
        parts = again.groupBy("h", "salt").agg(F.count(F.lit(1)).alias("here"))
        before = F.coalesce(F.sum("here").over(Window.partitionBy("h").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        again = again.withColumn("nth", F.row_number().over(Window.partitionBy("h", "salt").orderBy("row"))).join(parts.select("h", "salt", before.alias("before")), ["h", "salt"])
        again = again.select("doc_id", "source", "size", "h", "h2", "row", "n", (F.col("nth") + F.col("before")).alias("nth"))
        single = rows.join(broadcast_if(equal.select("h"), some), "h", "left_anti")
        rows = stored(single.select("doc_id", "source", "size", "h", "h2", "row", F.lit(1).cast("long").alias("n"), F.lit(1).cast("long").alias("nth")).unionByName(again), "sizes")
    else:
        rows = rows.withColumns({"n": F.lit(1).cast("long"), "nth": F.lit(1).cast("long")})

    per = source_targets(rows, weights, share, most)
    per = per.withColumn("whole", F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size")) + F.lit(1e-12)), F.lit(0)).cast("long"))
    per = per.withColumn("quota", F.greatest(F.round(F.col("target") - F.col("whole") * F.col("source_size")), F.lit(0.0)).cast("long"))
    sure = _certain(rows, per)
    per = stored(per.join(sure.withColumnRenamed("source", "s2"), F.col("source").eqNullSafe(F.col("s2")), "left").drop("s2"), "targets")
    sources = per.count()

    ranked = _ranked(rows, per, sources, seed).filter("slice is not null")
    slices = ranked.groupBy("source", "slice").agg(F.sum("size").alias("words"), F.max("quota").alias("quota"))
    upto = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("before", F.coalesce(F.sum("words").over(upto), F.lit(0)))
    edge = slices.filter((F.col("before") < F.col("quota")) & (F.col("before") + F.col("words") >= F.col("quota"))).select(F.col("source").alias("s2"), F.col("slice").alias("edge"), "before")
    inside = ranked.join(broadcast_if(edge, sources), F.col("source").eqNullSafe(F.col("s2")) & (F.col("slice") == F.col("edge")))
    order = Window.partitionBy("source").orderBy("odds", "h", "nth")
    inside = inside.withColumn("room", F.col("quota") - F.col("before") - F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    cut = inside.filter((F.col("room") > 0) & (F.col("room") <= F.col("size")))  # the document at which the quota is reached
    return rows, per, cut.select("source", F.struct("odds", "h", "nth").alias("cut"), "room"), sources


def _ranked(rows: DataFrame, per: DataFrame, sources: int, seed: int) -> DataFrame:
    """rows (source, size, h, nth) with their source's columns, odds (0: certain) and slice; both are null without words or quota.

    odds come from multiplications, divisions and square roots only, so that every machine has the same.
    """
    ranked = rows.join(broadcast_if(per.withColumnRenamed("source", "s2"), sources), F.col("source").eqNullSafe(F.col("s2"))).drop("s2")
    p = F.col("scale") * F.sqrt(F.col("size").cast("double"))
    u = unit_hash(seed, F.col("h"), F.col("nth"))
    odds = F.when(F.col("size") >= F.col("least"), F.lit(0.0)).otherwise((u * (1 - p)) / ((1 - u) * p))
    ranked = ranked.withColumn("odds", F.when((F.col("size") > 0) & (F.col("quota") > 0), odds))
    return ranked.withColumn("slice", F.floor((1 - 1 / (1 + F.col("odds"))) * (GRID - 1)).cast("int"))


def pareto_mix(docs: DataFrame, weights: list[float], share: float = 1.5, most: float = 2.0, seed: int = 41, partial: bool = True) -> DataFrame:
    """A row per row of docs: doc_id, source, size, source_size, target, copies (whole ones), part (words of one more), taken.

    docs needs doc_id, source and text. partial: the document where a source's target is passed gives only its first
    words, so that the source's words equal its target; else it is taken whole if that comes nearer. taken = copies * size
    + part, never above ceil(most) * size.

    Null text has size 0 and is never taken. Null source is a source of its own, after all others. Null doc_id and
    repeated rows are rows like any other, each with a U of its own (of rows that agree in doc_id, source and text, which
    has which makes no difference). A source without words has target 0. An empty table gives no rows.
    """
    rows, per, cut, sources = _plan(docs, weights, share, most, seed)
    return _taken(rows, per, cut, sources, seed, partial).select("doc_id", "source", "size", "source_size", "target", "copies", "part", (F.col("copies") * F.col("size") + F.col("part")).alias("taken"))


def _taken(rows: DataFrame, per: DataFrame, cut: DataFrame, sources: int, seed: int, partial: bool) -> DataFrame:
    """rows with source_size, target, copies and part; no shuffle unless sources are very many."""
    found = _ranked(rows, per, sources, seed).join(broadcast_if(cut.withColumnRenamed("source", "s2"), sources), F.col("source").eqNullSafe(F.col("s2")), "left")
    here = F.struct("odds", "h", "nth")
    filled = (F.col("room") == F.col("size")) if partial else (F.col("room") * 2 >= F.col("size"))
    more = F.when(F.col("odds").isNull(), 0).when(here < F.col("cut"), 1).when(here == F.col("cut"), filled.cast("int")).otherwise(0)
    part = F.when(F.lit(partial) & F.col("odds").isNotNull() & (here == F.col("cut")) & ~filled, F.col("room")).otherwise(0)
    copies = F.when(F.col("size") > 0, F.col("whole") + more).otherwise(0)
    return found.select(*rows.columns, "source_size", "target", copies.cast("long").alias("copies"), part.cast("long").alias("part"))


def mixed_documents(docs: DataFrame, weights: list[float], share: float = 1.5, most: float = 2.0, seed: int = 41) -> DataFrame:
    """docs with each row repeated as often as the mix takes it (whole documents only); rows that it does not take go.

    A row's copies follow from its own key and its source's cut, in one pass over docs; only rows that agree with another
    in doc_id, source and text are joined: their copies are added up and given to one of them.
    """
    rows, per, cut, sources = _plan(docs, weights, share, most, seed)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    (box,) = own_columns(docs, "box")
    keyed = docs.select(F.struct(*columns).alias(box), "doc_id", "source", word_count(F.col("text")).alias("size"), row_key().alias("h"), second_key().alias("h2"), F.lit(1).cast("long").alias("nth"))
    equal = rows.filter("n > 1")
    if equal.take(1):
        same = ["h", "h2", "doc_id", "source"]  # unlike documents that share h are told apart, each keeps its own copies
        sums = stored(_taken(equal, per, cut, sources, seed, False).groupBy(*same).agg(F.sum("copies").alias("total")), "copies")
        some = sums.count()
        alike = functools.reduce(Column.__and__, [F.col(f"k.{c}").eqNullSafe(F.col(f"t.{c}")) for c in same])
        one = keyed.alias("k").join(broadcast_if(sums, some).alias("t"), alike).select(box, *[f"k.{c}" for c in same], "total")
        one = one.groupBy(*same).agg(F.first(box).alias(box), F.max("total").alias("copies")).select(box, "copies")
        keyed = keyed.join(broadcast_if(sums.select("h").distinct(), some), "h", "left_anti")
    else:
        one = None
    out = _taken(keyed, per, cut, sources, seed, False).select(box, "copies")
    out = out if one is None else out.unionByName(one)
    return out.filter("copies > 0").select(F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"), box).select(*[F.col(f"{box}.`{c}`").alias(c) for c in docs.columns])
