"""Lookups: natural keys to ids and labels, with explicit policies for keys without a match.

Joins carry no broadcast hint: Spark broadcasts a side by its measured size, and shuffles (with skew handling) beyond it.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statkit.functions.text import match_key
from statkit.operators.ranking import numbered
from statkit.operators.shared import shuffled


PACKED = 20_000  #: entries of all dimensions that are packed into a plan's constant
SMALL = 2_000_000  #: rows of a dimension that may be broadcast


class UnmatchedKeys(ValueError):
    """Keys that a lookup has no entry for, under the policy "raise"."""


def lookup(facts: DataFrame, dim: DataFrame, on: Sequence[str], take: Mapping[str, str], unmatched: str = "keep", show: int = 20) -> DataFrame:
    """facts with the dimension's columns take = {dimension column: new name}, joined on equal keys.

    unmatched: "keep" leaves nulls, "drop" drops the rows, "raise" fails naming up to `show` keys. Null keys match nothing.
    With an edition among the keys a code is resolved inside its own edition.
    """
    right = dim.select(*[F.col(k).alias(f"__{k}") for k in on], *[F.col(c).alias(new) for c, new in take.items()])
    same = [facts[k] == right[f"__{k}"] for k in on]
    if unmatched == "raise":
        missing = facts.join(right, same, "left_anti").select(*on).distinct().limit(show).collect()
        if missing:
            raise UnmatchedKeys(f"no entry for {[tuple(r) for r in missing]}")
    return facts.join(right, same, "inner" if unmatched == "drop" else "left").drop(*[f"__{k}" for k in on])


def counted(dim: DataFrame) -> DataFrame:
    """dim for a join that may broadcast it only up to SMALL rows: by its file's size a table of many short rows seems small."""
    return dim if dim.limit(SMALL + 1).count() <= SMALL else shuffled(dim)


def unmatched_counts(facts: DataFrame, dim: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys of facts without an entry, with their rows."""
    return facts.join(dim.select(*on).distinct(), list(on), "left_anti").groupBy(*on).agg(F.count(F.lit(1)).alias("rows"))


def name_lookup(facts: DataFrame, dim: DataFrame, name: str, dim_name: str, take: Mapping[str, str], scope: Sequence[tuple[str, str]] = (), aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Lookup by normalised name, inside a scope such as a state, after aliases are redirected."""
    key = match_key(F.col(name))
    for alias, known in (aliases or {}).items():
        key = F.when(key == alias, known).otherwise(key)
    left = facts.withColumn("__name", key)
    right = dim.select(match_key(F.col(dim_name)).alias("__dim_name"), *[F.col(b).alias(f"__s{i}") for i, (_, b) in enumerate(scope)], *[F.col(c).alias(new) for c, new in take.items()])
    same = [left["__name"] == right["__dim_name"], *[left[a] == right[f"__s{i}"] for i, (a, _) in enumerate(scope)]]
    return left.join(right, same, "left").drop("__name", "__dim_name", *[f"__s{i}" for i in range(len(scope))])


def roles(facts: DataFrame, dim: DataFrame, key: str, label: str, columns: Mapping[str, str]) -> DataFrame:
    """One dimension resolved for several columns: columns = {fact column: label's name}."""
    for column, new in columns.items():
        facts = lookup(facts.withColumn("__role", F.col(column)), dim.withColumnRenamed(key, "__role"), ["__role"], {label: new}).drop("__role")
    return facts


def denormalised(facts: DataFrame, *steps: tuple[DataFrame, str, str, Mapping[str, str]]) -> DataFrame:
    """A star or a hierarchy chain: each step (dimension, fact column, dimension key, columns to take) joins in turn."""
    for dim, column, key, take in steps:
        facts = lookup(facts.withColumn("__step", F.col(column)), dim.withColumnRenamed(key, "__step"), ["__step"], take).drop("__step")
    return facts


def star(facts: DataFrame, dims: Mapping[str, tuple[DataFrame, str, str]], roles: Mapping[str, tuple[str, str]]) -> DataFrame:
    """facts with the labels of many roles: roles = {new name: (fact column, dimension)}, dims = {name: (table, key, label)}.

    Dimensions are measured first. Those of up to PACKED entries together, smallest first, are packed into one hashed table
    of (dimension, code), a constant of the plan in which a role is an expression; larger ones are joined, each role in turn.
    A null or unknown code gives null. Keys are compared as text; a key that a dimension has twice is an error.
    """
    clash = [new for new in roles if new in facts.columns]
    if clash:
        raise ValueError(f"facts have columns {clash} already")
    sizes = {}
    for name in sorted({d for _, d in roles.values()}):
        dim, key, _ = dims[name]
        n, keys = dim.agg(F.count(key), F.countDistinct(key)).first()
        if keys < n:
            raise ValueError(f"{key} is not unique in {name}")
        sizes[name] = n
    packed, total = [], 0
    for name in sorted(sizes, key=lambda d: (sizes[d], d)):
        if total + sizes[name] <= PACKED:
            packed.append(name)
            total += sizes[name]
    buckets = [[] for _ in range(1 << max(total - 1, 1).bit_length())]
    out = facts
    if packed:
        rows = [dims[name][0].select(F.lit(name).alias("dim"), F.col(dims[name][1]).cast("string").alias("code"), F.col(dims[name][2]).cast("string").alias("label")).filter("code IS NOT NULL") for name in packed]
        place = F.pmod(F.xxhash64("dim", "code"), F.lit(len(buckets))).cast("int").alias("place")
        for r in functools.reduce(DataFrame.unionByName, rows).select("dim", "code", "label", place).collect():  # at most PACKED
            buckets[r["place"]].append({"d": r["dim"], "c": r["code"], "l": r["label"]})
        table = F.from_json(F.lit(json.dumps(buckets)), "array<array<struct<d:string,c:string,l:string>>>")  # folded once

        def label(column: str, name: str) -> Column:
            code = F.col(column).cast("string")
            bucket = F.get(table, F.pmod(F.xxhash64(F.lit(name), code), F.lit(len(buckets))).cast("int"))
            return F.get(F.filter(bucket, lambda e: (e["d"] == name) & (e["c"] == code)), F.lit(0))["l"]

        out = out.withColumns({new: label(column, name) for new, (column, name) in roles.items() if name in packed})
    for new, (column, name) in roles.items():
        if name not in packed:
            dim, key, shown = dims[name]
            right = dim.select(F.col(key).cast("string").alias("__role"), F.col(shown).cast("string").alias(new))
            out = out.join(right, F.col(column).cast("string") == F.col("__role"), "left").drop("__role")
    return out.select(*[F.col(f"`{c}`") for c in facts.columns], *roles)


def null_foreign_keys(facts: DataFrame, dim: DataFrame, column: str, key: str) -> DataFrame:
    """A foreign key that the dimension does not have becomes null."""
    known = dim.select(F.col(key).alias("__known")).distinct()
    return facts.join(known, facts[column] == known["__known"], "left").withColumn(column, F.col("__known")).drop("__known")


def get_or_create(facts: DataFrame, dim: DataFrame, key: str, id_column: str, label: str, placeholder: str = "NOT DESCRIBED") -> DataFrame:
    """The dimension with an entry for each key of facts that it lacks: next ids by key order, a placeholder label.

    Where ids must not depend on what is loaded together, use operators.registry.
    """
    new = facts.select(key).filter(F.col(key).isNotNull()).distinct().join(dim, key, "left_anti")
    top = dim.agg(F.coalesce(F.max(id_column), F.lit(0))).first()[0]
    made = numbered(new.select(key), [key], id_column, top).select(F.col(id_column).cast(dict(dim.dtypes)[id_column]), key, F.lit(placeholder).alias(label))
    return dim.select(id_column, key, label).unionByName(made)


def merged(left: DataFrame, right: DataFrame, candidates: Iterable[str], how: str = "left") -> DataFrame:
    """Join on those candidate keys that both tables have."""
    return left.join(right, [k for k in candidates if k in left.columns and k in right.columns], how)


def grid(units: DataFrame, periods: DataFrame, facts: DataFrame, keys: Sequence[str], fill: Mapping[str, object]) -> DataFrame:
    """Every unit in every period, with the facts where there are any and `fill` elsewhere.

    units x periods is the result's own size; facts are joined by equal keys.
    """
    return units.crossJoin(periods).join(facts, list(keys), "left").fillna(dict(fill))


def ordered_list(details: DataFrame, by: Sequence[str], item: Column, name: str, sep: str = ", ") -> DataFrame:
    """An ordered, joined list of distinct items for each key."""
    return details.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_set(item)), sep).alias(name))
