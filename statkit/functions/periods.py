"""Periods, partial dates and times as column expressions. A period is the first day of its month, quarter or year."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")  #: 0 is Sunday
MONTHS = {m: i for i, m in enumerate(("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"), 1)}


def month_start(year: Column, month: Column) -> Column:
    """First day of a month from numbers or text; null where they make no date."""
    y, m = year.try_cast("double").try_cast("int"), month.try_cast("double").try_cast("int")
    return F.when(m.between(1, 12) & y.between(1, 9999), F.make_date(y, m, F.lit(1)))


def quarter_start(year: Column, quarter: Column) -> Column:
    q = quarter.try_cast("double").try_cast("int")
    return F.when(q.between(1, 4), month_start(year, (q - 1) * 3 + 1))


def date_of_parts(year: Column, month: Column, day: Column, no_year: int = 9999, no_part: int = 99) -> dict[str, Column]:
    """year, month, day without their sentinels, and the date if all three are known and possible."""
    y, m, d = F.when(year != no_year, year), F.when(month != no_part, month), F.when(day != no_part, day)
    return {"year": y, "month": m, "day": d, "date": F.try_to_date(F.format_string("%04d-%02d-%02d", y, m, d), "yyyy-MM-dd")}


def clock(hour: Column, minute: Column) -> Column:
    """HH:mm; null where either is out of range or 99 (P20)."""
    return F.when(hour.between(0, 23) & minute.between(0, 59), F.format_string("%02d:%02d", hour, minute))


def clock_text(c: Column) -> Column:
    """A valid HH:MM text, else null (P20)."""
    return F.when(c.rlike("^([01][0-9]|2[0-3]):[0-5][0-9]$"), c)


def minutes(c: Column) -> Column:
    """Minutes of an H:MM duration; null where the minutes are 60 or more."""
    ok = c.rlike("^[0-9]{1,3}:[0-5][0-9]$")
    part = lambda i: F.regexp_extract(c, "^([0-9]{1,3}):([0-9]{2})$", i).try_cast("int")
    return F.when(ok, part(1) * 60 + part(2))


def partial_date(c: Column, months: Mapping[str, int] = MONTHS) -> Column:
    """Date of "MM/YYYY", "YYYY", "dd/mm/yyyy", "dd-mmm-yy" or ISO text; missing parts are the first."""
    t = F.lower(F.trim(c))
    get = lambda p, i: F.regexp_extract(t, p, i)
    named = "^([0-9]{1,2})[-/ ]([a-z]{3})[a-z]*[-/ ]([0-9]{2,4})$"
    number = F
    for name, i in months.items():
        number = number.when(get(named, 2) == name, i)
    year = F.when(F.length(get(named, 3)) == 2, F.concat(F.lit("20"), get(named, 3))).otherwise(get(named, 3))
    return (
        F.when(t.rlike("^[0-9]{4}$"), F.try_to_date(F.concat(t, F.lit("-01-01")), "yyyy-MM-dd"))
        .when(t.rlike("^[0-9]{1,2}/[0-9]{4}$"), F.try_to_date(F.concat(F.lit("01/"), F.lpad(t, 7, "0")), "dd/MM/yyyy"))
        .when(t.rlike("^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"), F.try_to_date(t, "d/M/yyyy"))
        .when(t.rlike(named), F.try_to_date(F.format_string("%s-%02d-%s", year, number, F.lpad(get(named, 1), 2, "0")), "yyyy-MM-dd"))
        .when(t.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.try_to_date(F.substring(t, 1, 10), "yyyy-MM-dd"))
    )


def weekday(c: Column) -> Column:
    """Name of the weekday."""
    return F.element_at(F.array(*[F.lit(d) for d in DAYS]), F.dayofweek(c))


def hour_band(hour: Column) -> Column:
    """night, morning, afternoon, evening or unknown."""
    return F.when(hour.between(0, 5), "night").when(hour.between(6, 11), "morning").when(hour.between(12, 17), "afternoon").when(hour.between(18, 23), "evening").otherwise("unknown")


def months_between(df: DataFrame, start: str, end: str, name: str = "period") -> DataFrame:
    """A row per month from a one-row table's start to its end."""
    return df.select(F.explode(F.sequence(F.trunc(start, "MM"), F.trunc(end, "MM"), F.expr("interval 1 month"))).alias(name))


def calendar(spark: SparkSession, start: str, end: str, step: str = "1 month", name: str = "period") -> DataFrame:
    """A row per step from one ISO date to another."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr(f"interval {step}"))).alias(name))
