"""The indicator bank: one shape, parameters that narrow the whole series, limits and errors."""

import pytest

from statkit.operators.indicators import InvalidIndicator
from statkit.plans import indicators as bank


@pytest.fixture(scope="module")
def frames(spark, sf):
    return {name: mart(lambda table: spark.read.parquet(f"{sf}/{table}.parquet")).cache() for name, mart in bank.MARTS.items()}


def rows(spark, frames, id, **given):
    return [tuple(r) for r in bank.BANK.run(spark, id, most=None, frames=frames, **given).collect()]


def test_all_give_the_same_columns(spark, frames):
    bank.BANK.check(spark, frames)
    assert len(bank.BANK.list()) == 14 and {i["theme"] for i in bank.BANK.list(level="estatal")} == {"empleo"}
    assert len(bank.BANK.list("pobreza")) == 4 and len(bank.BANK.list("medio_ambiente")) == 2


@pytest.mark.parametrize("id", ["pobreza_municipal", "ocupacion_informal_municipal", "homicidio_doloso_municipal", "incidencia_delictiva_municipal"])
def test_parameters_select_from_the_whole_series(spark, frames, id):
    whole = rows(spark, frames, id)
    assert whole == sorted(whole, key=lambda r: (r[0], r[2], r[4] or "")) and whole
    one = whole[len(whole) // 2]
    assert rows(spark, frames, id, cve_geo=one[0]) == [r for r in whole if r[0] == one[0]]
    assert rows(spark, frames, id, anio_min="1999") == [r for r in whole if r[2][:4] >= "1999"]
    assert rows(spark, frames, id, cve_geo="99999") == []


def test_crimes_by_type(spark, frames):
    whole = rows(spark, frames, "incidencia_delictiva_municipal")
    women = rows(spark, frames, "feminicidio_municipal")
    assert [r[:4] for r in whole if r[4] == "Feminicidio"] == [r[:4] for r in women] and all(r[3] > 0 for r in whole)
    assert rows(spark, frames, "incidencia_delictiva_municipal", tipo_delito="Robo") == [r for r in whole if r[4] == "Robo"]


def test_soils_need_a_delimitation_and_never_mix_two(spark, frames):
    with pytest.raises(InvalidIndicator, match="fuente_limite"):
        rows(spark, frames, "superficie_grupo_edafologico_municipal")
    areas = {s: rows(spark, frames, "superficie_grupo_edafologico_municipal", fuente_limite=s) for s in bank.BOUNDS}
    assert areas["iieg"] and areas["inegi"] and areas["iieg"] != areas["inegi"]
    assert rows(spark, frames, "superficie_grupo_edafologico_municipal", fuente_limite="other") == []


def test_row_limit_names_the_parameters(spark, frames):
    with pytest.raises(ValueError, match="tipo_delito"):
        bank.BANK.run(spark, "incidencia_delictiva_municipal", most=10, frames=frames)


def test_soils_broadcast_no_table_that_grows(spark, sf):
    found = bank.soils(lambda table: spark.read.parquet(f"{sf}/{table}.parquet"))
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
