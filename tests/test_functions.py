"""Literals in, literals out."""

import datetime

import pytest
from pyspark.sql import functions as F

from statkit.functions import codes, periods, text


@pytest.fixture(scope="module")
def value(spark):
    one = spark.range(1)

    def run(column):
        return one.select(column.alias("v")).first()["v"]

    return run


@pytest.mark.parametrize(("raw", "want"), [("  Año  Base ", "ano_base"), ("MATRÍCULA", "matricula"), (" Nombre-Localidad", "nombre_localidad")])
def test_headers(raw, want):
    assert text.header(raw) == want


@pytest.mark.parametrize(("raw", "want"), [(' "a​  b" ', "a b"), ("N/A", None), (" nan ", None), ("", None), ("x y", "x y"), (None, None)])
def test_null_tokens(value, raw, want):
    assert value(text.null_tokens(F.lit(raw).cast("string"))) == want


def test_text_functions(value):
    lit = F.lit
    assert value(text.accent_fold(lit("ÁÉÍñü ça é"))) == "AEInu ca e"
    assert value(text.ascii_key(lit(" Año Nuevo… "))) == "ano_nuevo"
    assert value(text.match_key(lit("  San  JOSÉ "))) == "san jose"
    assert value(text.title_with_particles(lit("DE la SECRETARÍA DE salud imss"), ["de", "la"], {"imss": "IMSS"})) == "De la Secretaría de Salud IMSS"
    assert value(text.sentence_case(lit("ENFERMEDAD POR VIH"), ["VIH"])) == "Enfermedad por VIH"
    assert value(text.restore_acronyms(lit("dgis de srl"), ["DGIS"])) == "DGIS de SRL"
    assert value(text.restore_accents(lit("Region norte"), {"region": "región"})) == "Región norte"
    assert [value(text.yes_no(lit(x))) for x in ("sí", "N", "tal vez")] == [True, False, None]
    assert [value(text.number_text(lit(x))) for x in ("S/N", "12.0", " 7-A")] == [None, "12", "7-A"]


def test_codes(value):
    lit = F.lit
    assert [value(codes.to_int(lit(x))) for x in ("23.0", "x", "7")] == [23, None, 7]
    assert value(codes.or_zero(lit("x"))) == 0
    unit, amount = codes.packed(lit(4999), 1000, 999)
    assert (value(unit), value(amount)) == (4, None)
    assert value(codes.area_key(lit(14), lit(39))) == "14039" and value(codes.locality_key(lit(1), lit(2), lit(3))) == "010020003"
    assert [value(codes.padded(lit(x), 3)) for x in ("7", "", "12345")] == ["007", "", "12345"]
    assert [value(codes.text_key(lit(x))) for x in ("007", "000", "")] == ["7", "0", "0"]
    assert [value(codes.sector_of(lit(x))) for x in ("311111", "461110", "488411")] == ["31-33", "46", "48-49"]
    assert value(codes.row_hash(lit("a"), lit(None).cast("string"), lit(1))) != value(codes.row_hash(lit("a"), lit(1), lit(None).cast("string")))
    assert value(codes.flag(lit(None).cast("boolean"))) is False


@pytest.mark.parametrize(("x", "y", "lon", "lat"), [(500000.0, 0.0, -105.0, 0.0), (672000.0, 2288000.0, -103.35, 20.68), (-103.3, 20.6, -103.3, 20.6)])
def test_projection(value, x, y, lon, lat):
    a, b = codes.utm_to_degrees(F.lit(x), F.lit(y))
    assert abs(value(a) - lon) < 1e-2 and abs(value(b) - lat) < 2e-2


@pytest.mark.parametrize(("raw", "want"), [("03/2021", (2021, 3, 1)), ("2020", (2020, 1, 1)), ("5/11/2019", (2019, 11, 5)), ("07-feb-21", (2021, 2, 7)), ("2020-02-30", None), ("31/02/2020", None), ("?", None), ("2021-05-06 10:00", (2021, 5, 6))])
def test_partial_dates(value, raw, want):
    assert value(periods.partial_date(F.lit(raw))) == (datetime.date(*want) if want else None)


def test_periods(value):
    lit = F.lit
    assert value(periods.month_start(lit("2020"), lit("\t01".strip()))) == datetime.date(2020, 1, 1)
    assert value(periods.month_start(lit(2020), lit(13))) is None
    assert value(periods.quarter_start(lit("2020"), lit("3"))) == datetime.date(2020, 7, 1)
    parts = periods.date_of_parts(lit(2019), lit(99), lit(31))
    assert [value(parts[k]) for k in ("year", "month", "day", "date")] == [2019, None, 31, None]
    assert [value(periods.clock(lit(a), lit(b))) for a, b in ((7, 5), (99, 5), (7, 60))] == ["07:05", None, None]
    assert [value(periods.minutes(lit(x))) for x in ("1:30", "0:75", "99:99")] == [90, None, None]
    assert value(periods.weekday(lit("2024-01-07").cast("date"))) == "Sunday"


def test_calendar(spark):
    assert periods.calendar(spark, "2020-01-01", "2021-01-01", "3 month").count() == 5
