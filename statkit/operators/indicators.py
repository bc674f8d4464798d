"""The indicator catalogue: parameterised SQL over views with one output shape."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statkit.operators.ranking import limited

SHAPE = ("geo_key", "geo_name", "period", "value", "category")
KINDS = {"int": int, "float": float, "str": str, "bool": bool}


class InvalidIndicator(ValueError):
    pass


@dataclass(frozen=True)
class Parameter:
    """A named parameter; an optional one that is not given binds NULL."""

    kind: str = "str"
    required: bool = False


@dataclass(frozen=True)
class Indicator:
    id: str
    theme: str
    unit: str
    level: str
    source: str
    sql: str
    parameters: Mapping[str, Parameter] = field(default_factory=dict)


class Catalogue:
    """Validated indicators: unique ids, queries only, parameters that agree with the SQL, the same output columns."""

    def __init__(self, *indicators: Indicator, shape: Sequence[str] = SHAPE):
        self._by_id: dict[str, Indicator] = {}
        self.shape = tuple(shape)
        for one in indicators:
            if one.id in self._by_id:
                raise InvalidIndicator(f"{one.id}: id used twice")
            if not re.match(r"(?is)\s*(select|with)\b", one.sql) or ";" in one.sql:
                raise InvalidIndicator(f"{one.id}: not a single query")
            used = set(re.findall(r"(?<!:):([a-z_]+)", one.sql))
            if used != set(one.parameters):
                raise InvalidIndicator(f"{one.id}: parameters {sorted(used ^ set(one.parameters))}")
            self._by_id[one.id] = one

    def __getitem__(self, id: str) -> Indicator:
        return self._by_id[id]

    def check(self, spark: SparkSession, frames: Mapping[str, DataFrame] | None = None) -> None:
        """Analyses every query: its columns must be those of the catalogue's shape, in order. frames: tables that a query names in braces."""
        for one in self._by_id.values():
            found = tuple(spark.sql(one.sql, args=dict.fromkeys(one.parameters), **(frames or {})).columns)
            if found != self.shape:
                raise InvalidIndicator(f"{one.id}: columns {found}")

    def list(self, theme: str | None = None, level: str | None = None) -> list[dict]:
        """Descriptions without the SQL."""
        return [{k: v for k, v in vars(i).items() if k != "sql"} for i in self._by_id.values() if theme in (None, i.theme) and level in (None, i.level)]

    def run(self, spark: SparkSession, id: str, most: int | None = 5000, frames: Mapping[str, DataFrame] | None = None, **given) -> DataFrame:
        """The indicator's rows for typed parameters; more than `most` is an error (I4)."""
        if id not in self._by_id:
            raise InvalidIndicator(f"unknown indicator {id}")
        one = self._by_id[id]
        if extra := set(given) - set(one.parameters):
            raise InvalidIndicator(f"{id}: unknown parameters {sorted(extra)}")
        bound = {}
        for name, p in one.parameters.items():
            value = given.get(name)
            if value is None and p.required:
                raise InvalidIndicator(f"{id}: {name} is required")
            try:
                bound[name] = None if value is None else KINDS[p.kind](value)
            except (TypeError, ValueError) as error:
                raise InvalidIndicator(f"{id}: {name} must be {p.kind}") from error
        rows = spark.sql(one.sql, args=bound, **(frames or {})).select(*[F.col(c) for c in self.shape])
        return rows if most is None else limited(rows, most, list(one.parameters))
