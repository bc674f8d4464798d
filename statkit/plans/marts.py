"""Parameterised mart builders: the shapes that most published views share."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statkit.functions.periods import months_between
from statkit.operators import lookup, ranking, rates


def rate_mart(facts: DataFrame, units: DataFrame, people: DataFrame, unit: str, date: str, counts: Mapping[str, Column], rate_of: str, per: int = 100_000, digits: int = 2) -> DataFrame:
    """Every unit in every month from the first fact to the last: conditional counts with zeros, and a rate for the population.

    facts: (unit, date, ...) rows; units: a row per unit, with its labels; people: (unit, people).
    """
    dated = facts.withColumn("period", F.trunc(date, "MM"))
    found = dated.groupBy(unit, "period").agg(*[F.count_if(c).alias(n) for n, c in counts.items()])
    span = facts.agg(F.min(date).alias("a"), F.max(date).alias("b"))
    full = lookup.grid(units, months_between(span, "a", "b"), found, [unit, "period"], dict.fromkeys(counts, 0))
    return rates.per_population(full, people, [unit], rate_of, "people", per, digits).drop("people")


def composition_mart(facts: DataFrame, unit: Sequence[str], category: str, measure: Column, name: str = "n") -> DataFrame:
    """Each unit's categories with their share of the unit in percent, their place and whether they dominate."""
    by = facts.groupBy(*unit, category).agg(measure.alias(name))
    total = by.groupBy(*unit).agg(F.sum(name).alias("__total"))
    out = ranking.ranks(by, unit, name, category).join(total, list(unit))
    return out.withColumn("share", rates.ratio(F.col(name), F.col("__total"), 100, 4)).drop("__total", "rank_up", "rank_down")


def yearly_change(facts: DataFrame, unit: Sequence[str], year: Column, measure: Column, name: str = "value") -> DataFrame:
    """A measure per unit and year beside the year before's, and the change in percent, by an equi-join on the next year."""
    now = facts.groupBy(*unit, year.alias("year")).agg(measure.alias(name))
    before = now.select(*unit, (F.col("year") + 1).alias("year"), F.col(name).alias("before"))
    joined = now.join(before, [*unit, "year"], "left")
    return joined.withColumn("change", rates.ratio(F.col(name) - F.col("before"), F.col("before"), 100, 4))
