"""Operators over tables: lookups, reshaping, rates, ranking, checks, loads, cells and indicators."""
