"""Marts that declare their inputs, refreshed in order of dependency and only where an input changed."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession

from statkit.operators import commits


@dataclass(frozen=True)
class Mart:
    """A mart's name, the tables and marts that it is made from, and how; build gets them in the order of `inputs`."""

    name: str
    inputs: Sequence[str]
    build: Callable[..., DataFrame]
    partition_by: Sequence[str] = ()


def ordered(marts: Sequence[Mart]) -> list[Mart]:
    """The marts, each after the marts among its inputs; a cycle or a name given twice is an error."""
    by = {m.name: m for m in marts}
    if len(by) < len(marts):
        raise ValueError("a mart's name is given twice")
    order = TopologicalSorter({m.name: [i for i in m.inputs if i in by] for m in marts})
    return [by[name] for name in order.static_order()]


def refresh(spark: SparkSession, root: str, marts: Sequence[Mart], tables: Mapping[str, str] | None = None) -> dict[str, str]:
    """Brings marts below `root` up to date; what was done by mart: "first", "changed" or "kept" (K11, K12).

    tables: paths of the base tables, which are committed tables like the marts (operators.commits). A mart is built anew if
    the commit of one of its inputs is not the one that it was last made from, or if its inputs' names changed; else it
    stays. The inputs' commits are read once, so that a mart is made from one state of each.
    """
    done, at = {}, {}
    paths = dict(tables or {}) | {m.name: f"{root}/{m.name}" for m in marts}

    def now(name: str) -> commits.Commit:
        if name not in at:
            found = commits.head(spark, paths[name])
            if found is None:
                raise FileNotFoundError(f"{name} has no commit at {paths[name]}")
            at[name] = found
        return at[name]

    for mart in ordered(marts):
        used = {i: now(i).number for i in mart.inputs}
        last = commits.head(spark, paths[mart.name])
        if last and last.facts.get("inputs") == used:
            done[mart.name] = "kept"
            at[mart.name] = last
            continue
        frame = mart.build(*[commits.read(spark, paths[i], now(i)) for i in mart.inputs])
        at[mart.name] = commits.replace(frame, paths[mart.name], {"inputs": used}, mart.partition_by)
        done[mart.name] = "changed" if last else "first"
    return done


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A mart as of its current commit."""
    return commits.read(spark, f"{root}/{name}", commits.head(spark, f"{root}/{name}"))
