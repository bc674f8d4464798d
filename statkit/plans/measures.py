"""Rates, shares, roll-ups and rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from statkit.operators import checks, labour, rates
from statkit.operators.ranking import keep_one, ranks, top_and_rest
from statkit.plans import marts
from statkit.plans.registry import query

GRID = """
WITH n AS (SELECT n_nationkey, n_name FROM nation),
p AS (SELECT c_nationkey AS n_nationkey, count(*) AS people FROM customer GROUP BY 1),
m AS (SELECT unnest(generate_series((SELECT date_trunc('month', min(o_orderdate)) FROM orders)::TIMESTAMP, (SELECT date_trunc('month', max(o_orderdate)) FROM orders)::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS period),
f AS (
  SELECT c_nationkey AS n_nationkey, date_trunc('month', o_orderdate)::DATE AS period, count(*) AS n,
    count(*) FILTER (o_orderpriority IN ('1-URGENT', '2-HIGH')) AS urgent
  FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2)
SELECT n.n_nationkey AS nation, n_name AS name, m.period, coalesce(f.n, 0)::BIGINT AS n, coalesce(urgent, 0)::BIGINT AS urgent,
  CASE WHEN people > 0 THEN round(coalesce(f.n, 0) * 100000.0::DOUBLE / people, 2) END AS rate
FROM n CROSS JOIN m LEFT JOIN f ON f.n_nationkey = n.n_nationkey AND f.period = m.period LEFT JOIN p ON p.n_nationkey = n.n_nationkey"""


@query(GRID)
def month_rate_grid(t, spark):
    """Every nation in every month, counts with zeros, rate per 100,000 customers."""
    facts = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_nationkey").alias("nation"), "o_orderdate", "o_orderpriority")
    units = t("nation").select(F.col("n_nationkey").alias("nation"), F.col("n_name").alias("name"))
    people = t("customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("people"))
    return marts.rate_mart(facts, units, people, "nation", "o_orderdate", {"n": F.lit(True), "urgent": F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")}, "n")


@query("""
SELECT l_returnflag AS flag, sum(l_quantity)::BIGINT AS people, sum(CASE WHEN l_discount > 0.05 THEN l_quantity ELSE 0 END)::BIGINT AS active,
  sum(CASE WHEN l_discount > 0.05 AND l_tax > 0.04 THEN l_quantity ELSE 0 END)::BIGINT AS idle,
  sum(CASE WHEN l_discount > 0.05 AND l_linestatus = 'F' THEN l_quantity ELSE 0 END)::BIGINT AS active_f,
  sum(CASE WHEN l_discount > 0.05 AND l_linestatus = 'O' THEN l_quantity ELSE 0 END)::BIGINT AS active_o,
  round(sum(CASE WHEN l_discount > 0.05 THEN l_quantity ELSE 0 END) * 100.0 / nullif(sum(l_quantity), 0), 2)::DOUBLE AS participation,
  round(sum(CASE WHEN l_discount > 0.05 AND l_tax > 0.04 THEN l_quantity ELSE 0 END) * 100.0 / nullif(sum(CASE WHEN l_discount > 0.05 THEN l_quantity ELSE 0 END), 0), 2)::DOUBLE AS unemployment
FROM lineitem GROUP BY 1""")
def weighted_rates(t, spark):
    """Survey-weighted sums by condition and sex, and rates of them."""
    active = F.col("l_discount") > 0.05
    sums = rates.weighted(F.col("l_quantity"), {"active": active, "idle": active & (F.col("l_tax") > 0.04)})
    by_sex = rates.weighted(F.col("l_quantity"), {"active": active}, {"f": F.col("l_linestatus") == "F", "o": F.col("l_linestatus") == "O"})[1:]
    out = t("lineitem").groupBy(F.col("l_returnflag").alias("flag")).agg(F.sum("l_quantity").alias("people"), *sums, *by_sex)
    whole = {c: F.col(c).cast("bigint") for c in ("people", "active", "idle", "active_f", "active_o")}
    return out.withColumns({"participation": rates.ratio(F.col("active"), F.col("people"), 100, 2), "unemployment": rates.ratio(F.col("idle"), F.col("active"), 100, 2)}).withColumns(whole)


@query("""
SELECT user_id, count(*) AS n, count(*) FILTER (event_type = 'purchase') AS purchases, round(avg(value) FILTER (event_type = 'purchase'), 6) AS mean_purchase,
  round(sum(value), 4) AS weight, bool_or(event_type = 'error') AS any_error, count(*) FILTER (value > 50)::BIGINT AS large
FROM events GROUP BY 1""")
def mixed_indicator(t, spark):
    """Weighted and unweighted measures, conditional averages and boolean sums in one pass."""
    bought = F.col("event_type") == "purchase"
    return t("events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(bought).alias("purchases"), F.round(F.avg(F.when(bought, F.col("value"))), 6).alias("mean_purchase"),
        F.round(F.sum("value"), 4).alias("weight"), F.bool_or(F.col("event_type") == "error").alias("any_error"), F.sum((F.col("value") > 50).cast("bigint")).alias("large"),
    )


@query("""
WITH c AS (SELECT *, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'high' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE 'low' END AS class FROM orders)
SELECT class, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o,
  max(o_totalprice) FILTER (o_orderstatus = 'F') AS top_f, round(sum(o_totalprice) FILTER (o_orderstatus = 'O'), 2) AS sum_o
FROM c GROUP BY 1""")
def conditional_pivot_total(t, spark):
    """Classes made before grouping (null kept), conditional counts, a total beside a detail."""
    level = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "high").when(F.col("o_orderpriority") != "4-NOT SPECIFIED", "low")
    f, o = F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "O"
    return t("orders").groupBy(level.alias("class")).agg(
        F.count(F.lit(1)).alias("n"), *rates.counts_if({"f": f, "o": o}),
        F.max(F.when(f, F.col("o_totalprice"))).alias("top_f"), F.round(F.sum(F.when(o, F.col("o_totalprice"))), 2).alias("sum_o"),
    )


@query("""
WITH i AS (SELECT year(o_orderdate)::INTEGER AS year, avg(o_totalprice) AS level FROM orders GROUP BY 1),
v AS (SELECT year(o_orderdate)::INTEGER AS year, o_orderstatus AS status, sum(o_totalprice) AS value FROM orders GROUP BY 1, 2)
SELECT v.year, status, round(value, 2) AS value, round(value * (SELECT level FROM i WHERE year = 1998) / level, 2) AS real_value FROM v LEFT JOIN i ON i.year = v.year""")
def deflated_values(t, spark):
    """Values at a base year's prices."""
    dated = t("orders").withColumn("year", F.year("o_orderdate"))
    index = dated.groupBy("year").agg(F.avg("o_totalprice").alias("level"))
    facts = dated.groupBy("year", F.col("o_orderstatus").alias("status")).agg(F.sum("o_totalprice").alias("value"))
    out = rates.deflated(facts, index, "year", "level", "value", 1998)
    return out.select("year", "status", F.round("value", 2).alias("value"), F.round("real_value", 2).alias("real_value"))


@query("""
SELECT p_brand AS brand, round(sum(l_extendedprice) FILTER (p_type IN ('PROMO', 'ECONOMY')) * 100 / nullif(sum(l_extendedprice), 0), 4) AS share, count(*) AS n
FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1""")
def share_of_total(t, spark):
    """Share of several concepts in a total."""
    joined = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    some = F.sum(F.when(F.col("p_type").isin("PROMO", "ECONOMY"), F.col("l_extendedprice")))
    return joined.groupBy(F.col("p_brand").alias("brand")).agg(rates.ratio(some, F.sum("l_extendedprice"), 100, 4).alias("share"), F.count(F.lit(1)).alias("n"))


@query("""
WITH g AS (
  SELECT l_linestatus AS status, sum(l_extendedprice) FILTER (l_returnflag = 'A') / nullif(sum(l_quantity) FILTER (l_returnflag = 'A'), 0) AS a,
    sum(l_extendedprice) FILTER (l_returnflag = 'R') / nullif(sum(l_quantity) FILTER (l_returnflag = 'R'), 0) AS r
  FROM lineitem GROUP BY 1)
SELECT status, round(a, 4) AS a, round(r, 4) AS r, round((a - r) * 100 / nullif(a, 0), 4) AS gap FROM g""")
def relative_gap(t, spark):
    """Ratio of sums per group, then their relative difference."""
    def mean(flag):
        of = F.col("l_returnflag") == flag
        return rates.ratio(F.sum(F.when(of, F.col("l_extendedprice"))), F.sum(F.when(of, F.col("l_quantity"))))

    out = t("lineitem").groupBy(F.col("l_linestatus").alias("status")).agg(mean("A").alias("a"), mean("R").alias("r"))
    return out.select("status", F.round("a", 4).alias("a"), F.round("r", 4).alias("r"), rates.ratio(F.col("a") - F.col("r"), F.col("a"), 100, 4).alias("gap"))


@query("""
WITH d AS (SELECT l_suppkey, CASE WHEN l_quantity > 25 THEN l_quantity END AS q, CASE WHEN l_suppkey > 5 THEN l_extendedprice END AS x FROM lineitem)
SELECT l_suppkey AS supplier, coalesce(sum(q), 0) AS zero_sum, round(sum(x), 2) AS null_sum, round(sum(x) / nullif(coalesce(sum(q), 0), 0), 4) AS price FROM d GROUP BY 1""")
def ratio_after_sum(t, spark):
    """A2, A3: all-null groups as 0 and as null, a ratio recomputed after summing."""
    d = t("lineitem").select(F.col("l_suppkey").alias("supplier"), F.when(F.col("l_quantity") > 25, F.col("l_quantity")).alias("q"), F.when(F.col("l_suppkey") > 5, F.col("l_extendedprice")).alias("x"))
    out = d.groupBy("supplier").agg(rates.total(F.col("q")).alias("zero_sum"), rates.total(F.col("x"), 1).alias("x"))
    return out.select("supplier", "zero_sum", F.round("x", 2).alias("null_sum"), rates.ratio(F.col("x"), F.col("zero_sum"), 1, 4).alias("price"))


@query("""
WITH b AS (SELECT p_brand, sum(p_size) FILTER (p_size BETWEEN 1 AND 14) AS young, sum(p_size) FILTER (p_size BETWEEN 15 AND 49) AS adult FROM part GROUP BY 1),
f AS (SELECT p_brand, count(*) AS births, count(*) FILTER (p_size < 20) AS early FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1)
SELECT b.p_brand AS brand, young::BIGINT AS young, adult::BIGINT AS adult, births, round(births * 1000.0::DOUBLE / nullif(adult, 0), 2) AS fertility, round(early * 100.0::DOUBLE / nullif(births, 0), 2) AS early_share
FROM b LEFT JOIN f ON f.p_brand = b.p_brand""")
def age_band_denominator(t, spark):
    """Denominators summed over bands, rates and shares over them."""
    size = F.col("p_size")
    bands = t("part").groupBy(F.col("p_brand").alias("brand")).agg(F.sum(F.when(size.between(1, 14), size)).alias("young"), F.sum(F.when(size.between(15, 49), size)).alias("adult"))
    facts = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("p_brand").alias("brand")).agg(F.count(F.lit(1)).alias("births"), F.count_if(size < 20).alias("early"))
    out = bands.join(facts, "brand", "left")
    return out.select("brand", "young", "adult", "births", rates.ratio(F.col("births"), F.col("adult"), 1000, 2).alias("fertility"), rates.ratio(F.col("early"), F.col("births"), 100, 2).alias("early_share"))


@query("""
WITH cut AS (SELECT max(date_trunc('month', o_orderdate)) AS m FROM orders)
SELECT date_trunc('month', o_orderdate)::DATE AS cut, o_orderstatus AS status, count(*) AS n, count(DISTINCT o_custkey) AS customers, round(sum(o_totalprice), 2) AS value
FROM orders, cut WHERE date_trunc('month', o_orderdate) = m GROUP BY 1, 2""")
def latest_cut_summary(t, spark):
    """Only the last snapshot is summarised."""
    orders = t("orders").withColumn("cut", F.trunc("o_orderdate", "MM"))
    last = orders.agg(F.max("cut").alias("last"))
    here = orders.join(last, F.col("cut") == F.col("last"))
    return here.groupBy("cut", F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("o_custkey").alias("customers"), F.round(F.sum("o_totalprice"), 2).alias("value"))


@query("""
SELECT p_brand AS brand, CASE WHEN grouping(p_type) = 1 THEN NULL ELSE p_type END AS type, CASE WHEN grouping(p_type) = 1 THEN 'total' ELSE 'part' END AS level, sum(p_size)::BIGINT AS size
FROM part GROUP BY GROUPING SETS ((p_brand), (p_brand, p_type))""")
def level_totals(t, spark):
    """Totals and their parts under a level tag."""
    parts = t("part").select(F.col("p_brand").alias("brand"), F.col("p_type").alias("type"), F.col("p_size").cast("bigint").alias("size"))
    return rates.with_totals(parts, ["brand"], "type", "size").select("brand", "type", "level", "size")


RANKED = """
WITH s AS (SELECT l_suppkey AS supplier, l_returnflag || l_linestatus AS class, count(*) AS n FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY supplier ORDER BY n DESC, class)::INTEGER AS place, rank() OVER (PARTITION BY supplier ORDER BY n DESC)::INTEGER AS rank_down, rank() OVER (PARTITION BY supplier ORDER BY n)::INTEGER AS rank_up FROM s)
"""


def _classes(t):
    return t("lineitem").groupBy(F.col("l_suppkey").alias("supplier"), F.concat("l_returnflag", "l_linestatus").alias("class")).agg(F.count(F.lit(1)).alias("n"))


@query(RANKED + "SELECT *, place = 1 AS dominant FROM r")
def rank_categories(t, spark):
    """Ranks inside a unit, and the dominant category."""
    return ranks(_classes(t), ["supplier"], "n", "class")


@query(RANKED + """SELECT supplier, max(class) FILTER (place = 1) AS first, max(class) FILTER (place = 2) AS second, coalesce(sum(n) FILTER (place > 2), 0)::BIGINT AS rest,
  coalesce(string_agg(class, ', ' ORDER BY class) FILTER (place > 2), '') AS others FROM r GROUP BY 1""")
def rank_dominant_rest(t, spark):
    """Dominant, second and the rest as one row."""
    return top_and_rest(ranks(_classes(t), ["supplier"], "n", "class"), ["supplier"], "n", "class")


@query("""SELECT event_id, user_id, event_type, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) AS r FROM events) WHERE r = 1""")
def canonical_row(t, spark):
    """The last row of each key."""
    return keep_one(t("events"), ["user_id", "event_type"], [F.desc("ts"), F.asc("event_id")]).select("event_id", "user_id", "event_type", "ts")


@query("""
WITH f AS (SELECT c_nationkey AS nation, count(*) AS orders FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1),
g AS (SELECT s_nationkey AS nation, count(*) AS items FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1)
SELECT f.nation, orders, items, round(items * 1000.0::DOUBLE / nullif(orders, 0), 2) AS rate FROM f LEFT JOIN g ON g.nation = f.nation""")
def fact_to_fact_rate(t, spark):
    """Both facts are aggregated before they are joined."""
    f = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("orders"))
    g = t("lineitem").join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).groupBy(F.col("s_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("items"))
    return f.join(g, "nation", "left").withColumn("rate", rates.ratio(F.col("items"), F.col("orders"), 1000, 2))


@query("""
SELECT l_returnflag AS flag, count(*) FILTER (l_discount < 0.03) AS n_low, round(count(*) FILTER (l_discount < 0.03) * 1.0::DOUBLE / count(*), 6) AS share_low, sum(CASE WHEN l_discount < 0.03 THEN l_quantity ELSE 0 END) AS weight_low,
  quantile_cont(l_quantity, 0.25) AS p25, quantile_cont(l_quantity, 0.5) AS p50, quantile_cont(l_quantity, 1.0) AS p100
FROM lineitem GROUP BY 1""")
def threshold_profile(t, spark):
    """Distribution under thresholds, with percentiles."""
    rows = t("lineitem").withColumnRenamed("l_returnflag", "flag")
    under = rows.groupBy("flag").agg(*rates.thresholds(F.col("l_discount"), {"low": 0.03}, F.col("l_quantity")))
    out = under.join(rates.percentiles(rows, ["flag"], "l_quantity", [0.25, 0.5, 1.0]), "flag")
    return out.withColumns({"p25": F.col("p")[0], "p50": F.col("p")[1], "p100": F.col("p")[2]}).drop("p")


@query("""
WITH g AS (SELECT l_orderkey, round(sum(l_extendedprice), 2) AS covered FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1)
SELECT o_orderkey, o_totalprice AS total, coalesce(covered, 0) AS covered, round(coalesce(covered, 0) / nullif(o_totalprice, 0), 6) AS share, coalesce(covered, 0) > o_totalprice AS over
FROM orders LEFT JOIN g ON l_orderkey = o_orderkey""")
def coverage_closure(t, spark):
    """Covered against total per unit."""
    parts = t("lineitem").filter("l_linestatus = 'F'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.round(F.sum("l_extendedprice"), 2).alias("part"))
    return checks.coverage(parts, t("orders"), "o_orderkey", "part", "o_totalprice")


@query("""SELECT c_mktsegment AS segment, count(*) AS n, count(*) FILTER (c_acctbal > 0) AS have, round((count(*) - count(*) FILTER (c_acctbal > 0)) * 100.0::DOUBLE / nullif(count(*), 0), 2) AS lacking FROM customer GROUP BY 1""")
def share_lacking(t, spark):
    """Complement of a share."""
    out = t("customer").groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("c_acctbal") > 0).alias("have"))
    return out.withColumn("lacking", rates.lacking(F.col("have"), F.col("n")))


@query("""
WITH g AS (SELECT c_nationkey AS nation, o_orderpriority AS priority, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2)
SELECT *, row_number() OVER (PARTITION BY nation ORDER BY n DESC, priority)::INTEGER AS place, row_number() OVER (PARTITION BY nation ORDER BY n DESC, priority) = 1 AS dominant, round(n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY nation), 4) AS share FROM g""")
def composition(t, spark):
    """Each unit's categories with share, place and dominance."""
    facts = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_nationkey").alias("nation"), F.col("o_orderpriority").alias("priority"))
    return marts.composition_mart(facts, ["nation"], "priority", F.count(F.lit(1)))


@query("""
WITH g AS (SELECT o_orderstatus AS status, year(o_orderdate)::INTEGER AS year, count(*) AS value FROM orders GROUP BY 1, 2)
SELECT a.status, a.year, a.value, b.value AS before, round((a.value - b.value) * 100.0::DOUBLE / b.value, 4) AS change FROM g a LEFT JOIN g b ON b.status = a.status AND b.year = a.year - 1""")
def yearly_change(t, spark):
    """A measure beside the year before's."""
    return marts.yearly_change(t("orders").withColumnRenamed("o_orderstatus", "status"), ["status"], F.year("o_orderdate"), F.count(F.lit(1)))


def _survey_sql() -> str:
    sums, out = [], []
    for s, sex in (("", "true"), ("_h", "sex = 1"), ("_m", "sex = 2")):
        for name, rules in labour.POPULATIONS.items():
            met = [f"{c} <> 1" if a == "not 1" else f"{c} IN ({', '.join(map(str, a))})" for c, a in rules]
            sums.append(f"sum(CASE WHEN {' AND '.join([*met, sex])} THEN fac ELSE 0 END)::BIGINT AS {name}{s}")
        out += [f"{n}{s}" for n in labour.SHOWN]
        out += [f"round(({' + '.join(n + s for n in top)}) * 100.0::DOUBLE / nullif({below}{s}, 0), 2) AS {rate}{s}" for rate, (top, below) in labour.RATES.items()]
    return f"""
WITH b AS (
  SELECT year(l_shipdate)::INTEGER AS anio, quarter(l_shipdate)::INTEGER AS trimestre, l_quantity::BIGINT AS fac, (1 + l_partkey % 2)::INTEGER AS sex, (l_suppkey % 3)::INTEGER AS r_def, (1 + l_partkey % 3)::INTEGER AS c_res, (l_partkey % 100)::INTEGER AS eda,
    (1 + l_partkey % 2 * (l_linenumber % 2))::INTEGER AS clase1, (1 + l_linenumber % 3)::INTEGER AS clase2, CASE WHEN l_linenumber < 6 THEN (l_partkey % 4)::INTEGER END AS ambito1, (l_suppkey % 5)::INTEGER AS dur9c, (l_partkey % 6)::INTEGER AS tpg_p8a,
    (l_partkey % 3)::INTEGER AS remune2c, (l_suppkey % 2)::INTEGER AS sub_o, (l_partkey % 5)::INTEGER AS tcco, (l_partkey % 7)::INTEGER AS tue2, (l_suppkey % 4)::INTEGER AS emp_ppal FROM lineitem),
a AS (SELECT anio, trimestre, {', '.join(sums)} FROM b WHERE r_def = 0 AND c_res IN (1, 3) AND eda BETWEEN 15 AND 98 GROUP BY 1, 2)
SELECT anio, trimestre, {', '.join(out)} FROM a"""


def survey_rows(t):
    """Survey microdata derived from lineitem, under the survey's column names."""
    part, supp, line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    micro = {
        "anio": F.year("l_shipdate"), "trimestre": F.quarter("l_shipdate"), "fac": F.col("l_quantity").cast("bigint"), "sex": part % 2 + 1, "r_def": supp % 3, "c_res": part % 3 + 1, "eda": part % 100,
        "clase1": part % 2 * (line % 2) + 1, "clase2": line % 3 + 1, "ambito1": F.when(line < 6, part % 4), "dur9c": supp % 5, "tpg_p8a": part % 6, "remune2c": part % 3, "sub_o": supp % 2, "tcco": part % 5, "tue2": part % 7, "emp_ppal": supp % 4,
    }
    return t("lineitem").select(*[c.alias(n) for n, c in micro.items()])


@query(_survey_sql())
def labour_rates(t, spark):
    """Thirteen weighted populations and eleven rates, in total and by sex, in one aggregation."""
    return labour.labour_rates(labour.in_universe(survey_rows(t)), ["anio", "trimestre"])
