"""Codes, keys and numbers as column expressions."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_int(c: Column) -> Column:
    """Whole number from text that may read "23.0"; null where it is none."""
    return c.try_cast("double").try_cast("bigint")


def or_zero(c: Column) -> Column:
    """As to_int; 0 where it is none."""
    return F.coalesce(to_int(c), F.lit(0).cast("bigint"))


def unless(c: Column, *sentinels) -> Column:
    """Null where the value is one of the sentinels."""
    return F.when(~c.isin(*sentinels), c)


def of_length(c: Column, n: int) -> Column:
    return F.when(F.length(c) == n, c)


def domain(c: Column, values: Iterable[int]) -> Column:
    """A coded answer kept as its code; null outside the code book."""
    code = to_int(c).cast("int")
    return F.when(code.isin(*values), code)


def packed(c: Column, unit: int = 1000, sentinel: int | None = None) -> tuple[Column, Column]:
    """(unit, amount) of a packed code such as 4023; a sentinel amount is null, its unit stays."""
    amount = c % unit
    return F.floor(c / unit).cast("int"), (F.when(amount != sentinel, amount) if sentinel is not None else amount).cast("int")


def split_domain(c: Column, most: int) -> tuple[Column, Column]:
    """One code column as two: codes up to `most`, and the others."""
    return F.when(c <= most, c), F.when(c > most, c)


def text_key(c: Column) -> Column:
    """Without leading zeros; "0" where nothing is left."""
    cut = F.regexp_replace(F.trim(c), "^0+", "")
    return F.when(cut == "", "0").otherwise(cut)


def padded(c: Column, width: int) -> Column:
    """Zero-padded; empty stays empty, longer text stays whole."""
    text = c.cast("string")
    return F.when((text == "") | (F.length(text) >= width), text).otherwise(F.lpad(text, width, "0"))


def area_key(state: Column, unit: Column) -> Column:
    """Five-digit text key of a municipality: state * 1000 + municipality (P25)."""
    return padded(state.cast("int") * 1000 + unit.cast("int"), 5)


def locality_key(state: Column, unit: Column, place: Column) -> Column:
    return F.concat(padded(state, 2), padded(unit, 3), padded(place, 4))


#: two-digit prefixes that share a sector; fixed values
MERGED_SECTORS = {"31": "31-33", "32": "31-33", "33": "31-33", "48": "48-49", "49": "48-49"}


def sector_of(code: Column) -> Column:
    """The sector of an activity code: its first two digits, with merged ranges."""
    two = F.substring(code, 1, 2)
    out = F
    for k, v in MERGED_SECTORS.items():
        out = out.when(two == k, v)
    return out.otherwise(two)


def ancestors(code: Column) -> dict[str, Column]:
    """Sector, subsector, branch, sub-branch and class of a six-digit code."""
    return {"sector": sector_of(code)} | {name: F.substring(code, 1, n) for name, n in (("subsector", 3), ("branch", 4), ("subbranch", 5), ("class", 6))}


def row_hash(*columns: Column) -> Column:
    """SHA-256 of the values joined by a bar, null as empty: null and missing columns must not shift."""
    return F.sha2(natural_key("|", *columns), 256)


def natural_key(sep: str, *columns: Column) -> Column:
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])


def flag(condition: Column) -> Column:
    """False, not null, where the condition is unknown."""
    return F.coalesce(condition, F.lit(False))


def within(c: Column, low: float, high: float) -> Column:
    return F.when(c.between(low, high), c)


def utm_to_degrees(x: Column, y: Column, zone: int = 13) -> tuple[Column, Column]:
    """(longitude, latitude) of northern UTM metres on GRS80 by the transverse Mercator series.

    Only pairs that look projected (|x| > 180 or |y| > 90) are converted; others are returned as they are.
    """
    a, f, k0, e0 = 6378137.0, 1 / 298.257222101, 0.9996, 500000.0
    n = f / (2 - f)
    big = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = (n / 2 - 2 / 3 * n**2 + 37 / 96 * n**3, n**2 / 48 + n**3 / 15, 17 / 480 * n**3)
    delta = (2 * n - 2 / 3 * n**2 - 2 * n**3, 7 / 3 * n**2 - 8 / 5 * n**3, 56 / 15 * n**3)
    xi, eta = y / (k0 * big), (x - e0) / (k0 * big)
    xi1, eta1 = xi, eta
    for j, b in enumerate(beta, 1):
        xi1 = xi1 - F.lit(b) * F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j))
        eta1 = eta1 - F.lit(b) * F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j))
    chi = F.asin(F.sin(xi1) / F.cosh(eta1))
    lat = chi
    for j, d in enumerate(delta, 1):
        lat = lat + F.lit(d) * F.sin(chi * (2 * j))
    lon = F.lit(math.radians(6 * zone - 183)) + F.atan2(F.sinh(eta1), F.cos(xi1))
    projected = (F.abs(x) > 180) | (F.abs(y) > 90)
    return F.when(projected, F.degrees(lon)).otherwise(x), F.when(projected, F.degrees(lat)).otherwise(y)
