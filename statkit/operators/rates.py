"""Aggregates and rates. All of a table's measures are made in one aggregation."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def total(c: Column, min_count: int = 0) -> Column:
    """Sum: 0 for an all-null group, or null with min_count=1 (A2, A3)."""
    return F.sum(c) if min_count else F.coalesce(F.sum(c), F.lit(0))


def ratio(top: Column, bottom: Column, per: float = 1.0, digits: int | None = None) -> Column:
    """top * per / bottom; null for a null or zero denominator."""
    out = F.try_divide(top.cast("double") * F.lit(float(per)), bottom.cast("double"))
    return out if digits is None else F.round(out, digits)


def weighted(weight: Column, conditions: Mapping[str, Column], groups: Mapping[str, Column] | None = None) -> list[Column]:
    """Sums of weights where a condition holds, for all rows and for each group: {condition}[_{group}] (A5)."""
    out = [F.sum(F.when(c, weight).otherwise(0)).alias(n) for n, c in conditions.items()]
    return out + [F.sum(F.when(c & g, weight).otherwise(0)).alias(f"{n}_{m}") for m, g in (groups or {}).items() for n, c in conditions.items()]


def counts_if(conditions: Mapping[str, Column]) -> list[Column]:
    return [F.count_if(c).alias(n) for n, c in conditions.items()]


def per_population(facts: DataFrame, population: DataFrame, on: Sequence[str], count: str, people: str, per: int = 100_000, digits: int = 2, rate: str = "rate") -> DataFrame:
    """Rate for each `per` inhabitants; null where the population is unknown or zero."""
    return facts.join(population, list(on), "left").withColumn(rate, ratio(F.col(count), F.col(people), per, digits))


def deflated(facts: DataFrame, index: DataFrame, year: str, level: str, value: str, base: int, name: str = "real_value") -> DataFrame:
    """value * (base year's index / the year's index) (A10, A11, J10). index: a row per year."""
    of_base = index.filter(F.col(year) == base).select(F.col(level).alias("__base"))
    joined = facts.join(index, year, "left").crossJoin(F.broadcast(of_base))  # one row
    return joined.withColumn(name, ratio(F.col(value) * F.col("__base"), F.col(level))).drop("__base")


def with_totals(facts: DataFrame, keys: Sequence[str], parts: str, measure: str) -> DataFrame:
    """Totals and their parts under a `level` tag: one grouping-sets aggregation."""
    sets = facts.groupingSets([[*map(F.col, keys)], [*map(F.col, keys), F.col(parts)]], *map(F.col, keys), F.col(parts))
    return sets.agg(F.when(F.grouping(parts) == 1, "total").otherwise("part").alias("level"), F.sum(measure).alias(measure))


def thresholds(c: Column, limits: Mapping[str, float], weight: Column | None = None) -> list[Column]:
    """Count, share and weight of rows under each limit."""
    out = []
    for name, limit in limits.items():
        out += [F.count_if(c < limit).alias(f"n_{name}"), ratio(F.count_if(c < limit), F.count(c), 1, 6).alias(f"share_{name}")]
        if weight is not None:
            out.append(F.sum(F.when(c < limit, weight).otherwise(0)).alias(f"weight_{name}"))
    return out


def percentiles(df: DataFrame, keys: Sequence[str], column: str, shares: Sequence[float], slices: int = 64) -> DataFrame:
    """keys and p: the exact percentiles of a group's values at the shares, interpolated; null in a group without values.

    Approximate bounds cut a group's values into slices of about equal size. Slices are counted, and only those that hold
    a wanted rank are put in order, by distinct values: no group's values meet in one task.
    """
    fractions = F.array(*[F.lit(i / slices) for i in range(1, slices)])
    groups = df.groupBy(*keys).agg(F.percentile_approx(F.col(column).cast("double"), fractions).alias("bounds"), F.count(column).alias("size"))
    values = df.filter(F.col(column).isNotNull()).groupBy(*keys, F.col(column).cast("double").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    same = lambda right: functools.reduce(Column.__and__, [F.col(k).eqNullSafe(right[f"__{k}"]) for k in keys])
    named = lambda d, *rest: d.select(*[F.col(k).alias(f"__{k}") for k in keys], *rest)
    bounds = named(groups, "bounds")
    values = values.join(bounds, same(bounds)).select(*keys, "value", "n", F.size(F.filter("bounds", lambda b: b < F.col("value"))).alias("slice"))

    by = Window.partitionBy(*keys)
    earlier = by.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    counted = values.groupBy(*keys, "slice").agg(F.sum("n").alias("inside")).withColumns({"before": F.coalesce(F.sum("inside").over(earlier), F.lit(0)), "size": F.sum("inside").over(by)})
    ranks = [(F.floor((F.col("size") - 1) * F.lit(float(s))), F.ceil((F.col("size") - 1) * F.lit(float(s)))) for s in shares]
    within = lambda rank, first, n: (rank >= first) & (rank < first + n)
    holds = functools.reduce(Column.__or__, [within(r, F.col("before"), F.col("inside")) for pair in ranks for r in pair])
    held = named(counted.filter(holds), F.col("slice").alias("__slice"), "before", "size")
    found = values.join(held, same(held) & (F.col("slice") == F.col("__slice")))
    lower = Window.partitionBy(*keys, "slice").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumn("first", F.col("before") + F.coalesce(F.sum("n").over(lower), F.lit(0)))
    at = lambda rank: F.max(F.when(within(rank, F.col("first"), F.col("n")), F.col("value")))
    ends = found.groupBy(*keys, "size").agg(*[at(r).alias(f"{end}{i}") for i, pair in enumerate(ranks) for end, r in zip(("low", "high"), pair, strict=True)])
    between = [F.col(f"low{i}") + (F.col(f"high{i}") - F.col(f"low{i}")) * ((F.col("size") - 1) * F.lit(float(s)) - ranks[i][0]) for i, s in enumerate(shares)]
    ends = named(ends, F.array(*between).alias("p"))
    return groups.select(*keys).join(ends, same(ends), "left").select(*keys, "p")


def lacking(have: Column, all_: Column) -> Column:
    """Percentage without: (n - with) / n * 100."""
    return ratio(all_ - have, all_, 100, 2)
