"""The indicator bank: fourteen series on poverty, work, crime and soils, each parameterised SQL over one mart."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from statkit.operators import cells, labour, reshape
from statkit.operators.indicators import Catalogue, Indicator, Parameter
from statkit.operators.shared import shuffled
from statkit.plans.measures import survey_rows
from statkit.plans.registry import ORACLE, query
from statkit.plans.shapes import BOXES, MONTH_COLUMNS, _layers

#: Output columns, and each indicator's id; theme; unit; level; mart; value (a column of the mart).
SHAPE = ("cve_geo", "nombre_geo", "periodo", "valor", "categoria")
LISTED = """
pobreza_municipal; pobreza; porcentaje; municipal; deprivation; pobreza
pobreza_extrema_municipal; pobreza; porcentaje; municipal; deprivation; pobreza_ext
rezago_educativo_municipal; pobreza; porcentaje; municipal; deprivation; rez_edu
carencia_acceso_salud_municipal; pobreza; porcentaje; municipal; deprivation; car_salud
tasa_desocupacion_municipal; empleo; porcentaje; municipal; market; desocupados
ocupacion_informal_municipal; empleo; porcentaje; municipal; market; informales
tasa_desocupacion_jalisco; empleo; porcentaje; estatal; quarters; td
tasa_informalidad_laboral_jalisco; empleo; porcentaje; estatal; quarters; til1
tasa_subocupacion_jalisco; empleo; porcentaje; estatal; quarters; tsub
incidencia_delictiva_municipal; seguridad; carpetas de investigación; municipal; crimes; all
feminicidio_municipal; seguridad; carpetas de investigación; municipal; crimes; tipo = 'Feminicidio'
homicidio_doloso_municipal; seguridad; carpetas de investigación; municipal; crimes; subtipo = 'Homicidio doloso'
superficie_grupo_edafologico_municipal; medio_ambiente; hectáreas; municipal; soils; sum(superficie_ha)
porcentaje_grupo_edafologico_municipal; medio_ambiente; porcentaje; municipal; soils; sum(superficie_ha) * 100D / max(superficie_municipio)
"""
CRIMES = {"1-URGENT": "Feminicidio", "2-HIGH": "Homicidio", "3-MEDIUM": "Robo", "4-NOT SPECIFIED": "Lesiones", "5-LOW": "Fraude"}
KILLINGS = {"F": "Homicidio doloso", "O": "Homicidio culposo", "P": "Tentativa de homicidio doloso"}
BOUNDS = {"iieg": 0, "inegi": 3}  #: a delimitation's shift to the east, in cells

OPTIONAL = {"cve_geo": ("cve_geo = :cve_geo", "str"), "anio_min": ("anio >= :anio_min", "int"), "tipo_delito": ("tipo = :tipo_delito", "str")}


def _indicator(id: str, theme: str, unit: str, level: str, mart: str, value: str) -> Indicator:
    """The parts that differ by mart: period, measure, category, optional parameters; the rest is the same for all."""
    period, category, optional, rules, grouped = "cast(anio AS string)", "cast(NULL AS string)", ["cve_geo", "anio_min"], ["true"], ""
    if mart == "quarters":
        period, optional = "concat(anio, '-Q', trimestre)", ["anio_min"]
    if mart == "crimes":
        rules, grouped = ["true" if value == "all" else value], "GROUP BY ALL"
        period, value = "concat(anio, '-', lpad(mes, 2, '0'))", "sum(conteo)"
        if rules == ["true"]:
            category, optional = "tipo", [*optional, "tipo_delito"]
    if mart == "soils":
        period, category, optional, rules, grouped = "'2021'", "concat(clave, ' — ', grupo)", ["cve_geo"], ["fuente = :fuente_limite"], "GROUP BY ALL"
    rules += [f"(:{p} IS NULL OR {OPTIONAL[p][0]})" for p in optional]
    sql = f"""SELECT cve_geo, nombre_geo, {period} AS periodo, {value} AS valor, {category} AS categoria
      FROM {{{mart}}} WHERE {" AND ".join(rules)} {grouped} ORDER BY cve_geo, periodo, categoria"""
    given = {p: Parameter(OPTIONAL[p][1]) for p in optional} | ({"fuente_limite": Parameter("str", True)} if mart == "soils" else {})
    return Indicator(id, theme, unit, level, mart, sql, given)


BANK = Catalogue(*[_indicator(*map(str.strip, line.split(";"))) for line in LISTED.strip().split("\n")], shape=SHAPE)


def _place(key: str):
    return (F.col(key) + 14000).cast("string").alias("cve_geo"), F.col("n_name").alias("nombre_geo")


def _orders(t):
    return t("orders").join(t("customer"), F.col("c_custkey") == F.col("o_custkey")).join(t("nation"), F.col("n_nationkey") == F.col("c_nationkey")).select(*_place("c_nationkey"), F.year("o_orderdate").alias("anio"), "o_orderdate", "o_totalprice", "o_orderpriority", "o_orderstatus")


def deprivation(t):
    """Shares of four conditions in each unit's rows of a year: one aggregation."""
    price, shared = F.col("o_totalprice"), {"rez_edu": F.col("o_orderpriority") == "5-LOW", "car_salud": F.col("o_orderstatus") == "P"}
    met = {"pobreza": price < 150_000, "pobreza_ext": price < 50_000} | shared
    return _orders(t).groupBy("cve_geo", "nombre_geo", "anio").agg(*[(F.count_if(c) * F.lit(100.0) / F.count(F.lit(1))).alias(n) for n, c in met.items()])


def market(t):
    """Estimates of a yearly survey by unit; idle is what is left of the occupied. Lines are counted by supplier before they meet its nation."""
    found = t("lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("anio")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_discount") > 0.03).alias("busy"), F.count_if(F.col("l_linestatus") == "F").alias("casual"))
    named = found.join(t("supplier"), F.col("s_suppkey") == F.col("l_suppkey")).join(t("nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    share = lambda c: F.sum(c) * F.lit(100.0) / F.sum("n")
    return named.groupBy(*_place("s_nationkey"), "anio").agg((F.lit(100.0) - share("busy")).alias("desocupados"), share("casual").alias("informales"))


def quarters(t):
    """A state's quarterly labour rates."""
    found = labour.labour_rates(labour.in_universe(survey_rows(t)), ["anio", "trimestre"])
    return found.select(F.lit("14").alias("cve_geo"), F.lit("Jalisco").alias("nombre_geo"), "*")


def crimes(t):
    """Case files by unit, year, month, type and subtype: wide months to rows, zeros dropped."""
    case = lambda c, names: F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[F.col(c)]
    kind = case("o_orderpriority", CRIMES)
    rows = _orders(t).select("cve_geo", "nombre_geo", "anio", "o_orderdate", F.when((kind == "Feminicidio") & (F.col("o_orderstatus") == "P"), "Tentativa de feminicidio").otherwise(kind).alias("tipo"), F.when(kind == "Homicidio", case("o_orderstatus", KILLINGS)).otherwise(kind).alias("subtipo"))
    ids = ["cve_geo", "nombre_geo", "anio", "tipo", "subtipo"]
    wide = rows.groupBy(*ids).agg(*[F.count_if(F.month("o_orderdate") == i).alias(c) for c, i in MONTH_COLUMNS.items()])
    return reshape.unpivot_months(wide, ids, MONTH_COLUMNS, "mes", "conteo")


def soils(t):
    """Area of each group of polygons in each unit, under each delimitation, beside the unit's own area."""
    polygons, units = _layers(t)
    groups = t("part").select(F.col("p_partkey").alias("a"), F.col("p_type").alias("grupo"), F.substring("p_type", 1, 2).alias("clave"))
    parts = []
    for source, shift in BOUNDS.items():
        moved = units.withColumn("cx", F.col("cx") + shift)
        area = cells.dissolve(moved, "b").withColumnRenamed("area", "superficie_municipio")
        parts.append(cells.overlay(polygons, moved, "a", "b").join(shuffled(groups), "a").join(shuffled(area), "b").withColumn("fuente", F.lit(source)))
    found = parts[0].unionByName(parts[1])
    return found.select((F.col("b") + 14000).cast("string").alias("cve_geo"), F.concat(F.lit("Unit "), "b").alias("nombre_geo"), "fuente", "grupo", "clave", F.col("area").alias("superficie_ha"), "superficie_municipio")


MARTS = {m.__name__: m for m in (deprivation, market, quarters, crimes, soils)}

_PLACED = "(14000 + c_nationkey)::VARCHAR AS cve_geo, n_name AS nombre_geo, year(o_orderdate)::INTEGER AS anio"
_JOINED = "FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey"
_CONDITIONS = {"pobreza": "o_totalprice < 150000", "pobreza_ext": "o_totalprice < 50000", "rez_edu": "o_orderpriority = '5-LOW'", "car_salud": "o_orderstatus = 'P'"}
_MONTHLY = """WITH f AS (
  SELECT %s, strftime(o_orderdate, '%%Y-%%m') AS periodo, CASE o_orderpriority WHEN '1-URGENT' THEN CASE WHEN o_orderstatus = 'P' THEN 'Tentativa de feminicidio' ELSE 'Feminicidio' END
    WHEN '2-HIGH' THEN 'Homicidio' WHEN '3-MEDIUM' THEN 'Robo' WHEN '4-NOT SPECIFIED' THEN 'Lesiones' WHEN '5-LOW' THEN 'Fraude' END AS tipo, o_orderpriority = '2-HIGH' AND o_orderstatus = 'F' AS doloso %s)
SELECT cve_geo, nombre_geo, periodo, count(*) AS valor, %s AS categoria FROM f WHERE %s GROUP BY ALL"""


def _sql(id: str, mart: str, value: str) -> str:
    """What DuckDB finds for an indicator without its optional parameters."""
    if mart == "deprivation":
        return f"SELECT {_PLACED.replace(' AS anio', '::VARCHAR AS periodo')}, count(*) FILTER ({_CONDITIONS[value]}) * 100.0::DOUBLE / count(*) AS valor, NULL::VARCHAR AS categoria {_JOINED} GROUP BY ALL"
    if mart == "market":
        shown = "100.0::DOUBLE - count(*) FILTER (l_discount > 0.03) * 100.0::DOUBLE / count(*)" if value == "desocupados" else "count(*) FILTER (l_linestatus = 'F') * 100.0::DOUBLE / count(*)"
        return f"SELECT (14000 + s_nationkey)::VARCHAR AS cve_geo, n_name AS nombre_geo, year(l_shipdate)::VARCHAR AS periodo, {shown} AS valor, NULL::VARCHAR AS categoria FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY ALL"
    if mart == "quarters":
        return f"SELECT '14' AS cve_geo, 'Jalisco' AS nombre_geo, anio || '-Q' || trimestre AS periodo, {value} AS valor, NULL::VARCHAR AS categoria FROM ({ORACLE['labour_rates']})"
    if mart == "crimes":
        rule = {"all": "true", "tipo = 'Feminicidio'": "tipo = 'Feminicidio'"}.get(value, "doloso")
        return _MONTHLY % (_PLACED, _JOINED, "tipo" if value == "all" else "NULL::VARCHAR", rule)
    shown = "sum(area)::DOUBLE" if value == "sum(superficie_ha)" else "sum(area) * 100.0::DOUBLE / 144"
    return BOXES.rstrip() + f""", j AS (SELECT b, p_type AS g, (least(a.x0 + a.w, b.x0 + b.w) - greatest(a.x0, b.x0)) * (least(a.y0 + a.h, b.y0 + b.h) - greatest(a.y0, b.y0)) AS area
  FROM a JOIN part ON p_partkey = a JOIN b ON a.x0 < b.x0 + b.w AND b.x0 < a.x0 + a.w AND a.y0 < b.y0 + b.h AND b.y0 < a.y0 + a.h)
SELECT (14000 + b)::VARCHAR AS cve_geo, 'Unit ' || b AS nombre_geo, '2021' AS periodo, {shown} AS valor, left(g, 2) || ' — ' || g AS categoria FROM j GROUP BY b, g"""


def _register(one: Indicator, value: str) -> None:
    given = {"fuente_limite": "iieg"} if "fuente_limite" in one.parameters else {}

    def indicator(t, spark):  # the whole series; the row limit is for interactive use
        return BANK.run(spark, one.id, most=None, frames={one.source: MARTS[one.source](t)}, **given)

    functools.update_wrapper(indicator, MARTS[one.source])
    indicator.__name__ = f"indicator_{one.id}"
    query(_sql(one.id, one.source, value))(indicator)


for _line in LISTED.strip().split("\n"):
    _fields = [part.strip() for part in _line.split(";")]
    _register(BANK[_fields[0]], _fields[-1])
