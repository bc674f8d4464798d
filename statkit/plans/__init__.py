"""Registered queries over the test tables, each with DuckDB SQL where that can express it."""

from statkit.plans import carried, cleaning, indicators, joins, landing, loading, measures, shapes, sourcing
from statkit.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "carried", "cleaning", "indicators", "joins", "landing", "loading", "measures", "shapes", "sourcing"]
