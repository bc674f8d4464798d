"""Data-quality checks: as tables of findings, or failing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statkit.functions.text import match_key
from statkit.operators.sketches import exact_values


class CheckFailed(ValueError):
    pass


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def require(df: DataFrame, columns: Sequence[str] = (), not_null: Sequence[str] = (), unique: Sequence[str] = ()) -> DataFrame:
    """df, or CheckFailed: columns that must exist, that must not be null, a key that must be unique (Q1, Q2, Q3)."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise CheckFailed(f"missing columns: {missing}")
    if not_null:
        found = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in not_null]).first().asDict()
        if any(found.values()):
            raise CheckFailed(f"nulls: { {c: n for c, n in found.items() if n} }")
    if unique:
        found = repeated_keys(df, unique).limit(5).collect()
        if found:
            raise CheckFailed(f"repeated keys: {[tuple(r) for r in found]}")
    return df


def name_conflicts(catalogues: DataFrame, key: str, name: str) -> DataFrame:
    """Ids with several names and names with several ids, names compared normalised (Q5)."""
    rows = catalogues.select(F.col(key).cast("string").alias("k"), match_key(F.col(name)).alias("n"))
    by_id = rows.groupBy("k").agg(F.countDistinct("n").alias("variants")).filter("variants > 1").select(F.lit("id").alias("kind"), F.col("k").alias("value"), "variants")
    by_name = rows.groupBy("n").agg(F.countDistinct("k").alias("variants")).filter("variants > 1").select(F.lit("name").alias("kind"), F.col("n").alias("value"), "variants")
    return by_id.unionByName(by_name)


def battery(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """A row per check: its name and the rows that violate it, from one pass (Q6, Q9)."""
    found = df.agg(*[F.count_if(~F.coalesce(c, F.lit(False))).alias(n) for n, c in conditions.items()])
    return found.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("violations")) for n in conditions])))


def version_collisions(df: DataFrame, version: str, digest: str) -> DataFrame:
    """Versions published with different contents (Q7)."""
    return df.groupBy(version).agg(F.countDistinct(digest).alias("contents")).filter("contents > 1")


def verify_counts(written: DataFrame, expected: DataFrame, scope: Sequence[str]) -> DataFrame:
    """Scopes whose written rows differ from the expected (Q8)."""
    count = lambda d, n: d.groupBy(*scope).agg(F.count(F.lit(1)).alias(n))
    both = count(written, "written").join(count(expected, "expected"), list(scope), "full").fillna(0, ["written", "expected"])
    return both.filter("written <> expected")


def stale_codes(facts: DataFrame, dim: DataFrame, code: str, name: str, dim_code: str, dim_name: str) -> DataFrame:
    """facts with `code` as the name says; stale tells rows whose shipped code disagreed (Q11)."""
    right = dim.select(match_key(F.col(dim_name)).alias("__n"), F.col(dim_code).alias("__c"))
    joined = facts.withColumn("__k", match_key(F.col(name))).join(right, F.col("__k") == F.col("__n"), "left")
    return joined.withColumn("stale", F.coalesce(F.col("__c") != F.col(code), F.lit(False))).withColumn(code, F.coalesce("__c", code)).drop("__k", "__n", "__c")


def unreadable(df: DataFrame, schema: T.StructType) -> DataFrame:
    """A row per column of schema: how many values df's text column gives, and how many of them the type can't hold (Q10)."""
    parts = []
    for f in schema.fields:
        lost = F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
        parts.append(F.struct(F.lit(f.name).alias("column"), F.count(f.name).alias("given"), F.count_if(lost).alias("unreadable")))
    return df.agg(F.array(*parts).alias("p")).select(F.inline("p"))


def profile(df: DataFrame, distinct: bool = True) -> DataFrame:
    """A row per column: nulls, share of nulls, distinct values, smallest and largest as text, a sample value, the narrowest type.

    The sample is the value whose MD5 is smallest. inferred: integer, number or date if all values are such, else text.
    """
    parts = []
    for c in df.columns:
        text = F.col(c).cast("string")
        parts.append(F.struct(
            F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("nulls"),
            F.round(F.try_divide(F.count_if(F.col(c).isNull()).cast("double"), F.count(F.lit(1))), 6).alias("null_share"),
            (F.lit(0).cast("long") if distinct else F.approx_count_distinct(c)).alias("values"),
            F.min(text).alias("low"), F.max(text).alias("high"),
            (F.count_if(text.try_cast("double").isNotNull()) == F.count(c)).alias("numeric"),
            F.min_by(text, F.md5(text)).alias("sample"),
            F.when(F.count(c) == 0, "empty").when(F.count_if(text.try_cast("bigint").isNotNull()) == F.count(c), "integer").when(F.count_if(text.try_cast("double").isNotNull()) == F.count(c), "number").when(F.count_if(text.try_cast("date").isNotNull()) == F.count(c), "date").otherwise("text").alias("inferred"),
        ))
    found = df.agg(F.array(*parts).alias("p")).select(F.inline("p"))
    if not distinct:
        return found
    # counted beside, on two levels; countDistinct would repeat each row for each column
    exact = exact_values(df).select("column", F.col("values").alias("__values"))
    return found.join(exact, "column", "left").withColumn("values", F.coalesce("__values", F.lit(0))).drop("__values")


def coverage(parts: DataFrame, whole: DataFrame, unit: str, part: str, size: str, tolerance: float = 0.0) -> DataFrame:
    """Covered against total for each unit, with flags for more than all of it."""
    got = parts.groupBy(unit).agg(F.sum(part).alias("covered"))
    out = whole.select(unit, F.col(size).alias("total")).join(got, unit, "left").fillna(0, ["covered"])
    return out.withColumn("share", F.round(F.try_divide(F.col("covered").cast("double"), F.col("total")), 6)).withColumn("over", F.col("covered") > F.col("total") * (1 + tolerance))
