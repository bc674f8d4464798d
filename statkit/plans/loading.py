"""Loads, history, checks and indicators."""

from __future__ import annotations

from pyspark.sql import functions as F

from statkit.operators import checks, loads
from statkit.operators.indicators import Catalogue, Indicator, Parameter
from statkit.plans.registry import query

DAY = "DATE '2024-02-01'"


def _snapshots(t):
    """A first snapshot of customers with a positive balance, and a second one of all, some moved to another segment."""
    c = t("customer")
    old = c.filter("c_acctbal > 0").select("c_custkey", "c_mktsegment", "c_acctbal")
    new = c.filter("c_acctbal < 8000").select("c_custkey", F.when(F.col("c_nationkey") < 5, "MOVED").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"), "c_acctbal")
    return old, new


SNAPSHOTS = """
WITH old AS (SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE c_acctbal > 0),
new AS (SELECT c_custkey, CASE WHEN c_nationkey < 5 THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment, c_acctbal FROM customer WHERE c_acctbal < 8000)
"""


@query(SNAPSHOTS + """
, j AS (SELECT o.*, n.c_custkey IS NOT NULL AND (n.c_mktsegment <> o.c_mktsegment OR n.c_acctbal <> o.c_acctbal) AS changed FROM old o LEFT JOIN new n ON n.c_custkey = o.c_custkey)
SELECT c_custkey, c_mktsegment, c_acctbal, 1 AS version, NOT changed AS is_current, DATE '2024-01-01' AS valid_from, CASE WHEN changed THEN DATE '2024-02-01' END AS valid_to FROM j
UNION ALL SELECT n.*, CASE WHEN o.c_custkey IS NULL THEN 1 ELSE 2 END, true, DATE '2024-02-01', NULL FROM new n LEFT JOIN old o ON o.c_custkey = n.c_custkey
WHERE o.c_custkey IS NULL OR n.c_mktsegment <> o.c_mktsegment OR n.c_acctbal <> o.c_acctbal""")
def scd2_history(t, spark):
    """K8, K9: versions opened and closed by a snapshot; keys that it lacks stay current."""
    old, new = _snapshots(t)
    first = loads.first_history(old, F.lit("2024-01-01").cast("date"))
    return loads.history(first, new, ["c_custkey"], F.lit("2024-02-01").cast("date"))


@query(SNAPSHOTS + """
SELECT n.c_custkey, n.c_mktsegment, CASE WHEN o.c_custkey IS NULL THEN n.c_acctbal ELSE o.c_acctbal END AS c_acctbal FROM new n LEFT JOIN old o ON o.c_custkey = n.c_custkey
UNION ALL SELECT * FROM old WHERE c_custkey NOT IN (SELECT c_custkey FROM new)""")
def upsert(t, spark):
    """Equal keys replaced in the listed columns only."""
    return loads.upsert(*_snapshots(t), ["c_custkey"], update=["c_mktsegment"])


@query(SNAPSHOTS + "SELECT * FROM old UNION ALL SELECT * FROM new WHERE c_custkey NOT IN (SELECT c_custkey FROM old)")
def insert_ignore(t, spark):
    """Only keys that are not there."""
    return loads.load(*_snapshots(t), ["c_custkey"], "bootstrap")


@query("""
WITH old AS (SELECT o_orderkey, year(o_orderdate)::INTEGER AS edition, o_totalprice AS value FROM orders), new AS (SELECT o_orderkey, year(o_orderdate)::INTEGER AS edition, o_totalprice * 2 AS value FROM orders WHERE year(o_orderdate) >= 1999 AND o_orderstatus = 'F')
SELECT * FROM old WHERE edition NOT IN (SELECT edition FROM new) UNION ALL SELECT * FROM new""")
def replace_scope(t, spark):
    """K5: editions replaced whole."""
    rows = t("orders").select("o_orderkey", F.year("o_orderdate").alias("edition"), F.col("o_totalprice").alias("value"), "o_orderstatus")
    new = rows.filter("edition >= 1999 AND o_orderstatus = 'F'").withColumn("value", F.col("value") * 2)
    return loads.replace_scope(rows.drop("o_orderstatus"), new.drop("o_orderstatus"), ["edition"])


@query("""SELECT o_orderkey, year(o_orderdate)::INTEGER AS edition FROM orders WHERE year(o_orderdate) NOT IN (SELECT year(o_orderdate) FROM orders WHERE o_totalprice > 499500)""")
def skip_loaded(t, spark):
    """Only editions that are not loaded."""
    rows = t("orders").select("o_orderkey", F.year("o_orderdate").alias("edition"), "o_totalprice")
    return loads.skip_loaded(rows, rows.filter("o_totalprice > 499500"), ["edition"]).drop("o_totalprice")


@query("""SELECT s_suppkey, s_name, (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY s_name, s_suppkey) AS id FROM supplier""")
def surrogate_ids(t, spark):
    """Ids that go on after the target's largest."""
    target = t("customer").select(F.col("c_custkey").alias("id"))
    return loads.surrogate_ids(target, t("supplier").select("s_suppkey", "s_name"), ["s_name", "s_suppkey"])


@query("""
WITH p AS (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) AS id FROM part WHERE p_size > 10)
SELECT id, item FROM p JOIN (SELECT DISTINCT p_partkey, unnest(string_split(p_name, ' ')) AS item FROM part WHERE p_size > 10) w ON w.p_partkey = p.p_partkey""")
def parent_bridge(t, spark):
    """Parents numbered, their bridge rows carry the new ids."""
    facts, extras = loads.extension(t("part"), F.col("p_size") > 10, "p_partkey", ["p_name"])
    parents = facts.filter("p_size > 10").select("p_partkey")
    bridge = extras.select("p_partkey", F.explode(F.split("p_name", " ")).alias("item")).distinct()
    return loads.with_bridge(spark.createDataFrame([], "id long"), parents, bridge, "p_partkey", ["p_partkey"])[1]


@query("""
SELECT 'positive' AS "check", count(*) FILTER (NOT l_quantity > 20) AS violations FROM lineitem UNION ALL SELECT 'price', count(*) FILTER (NOT l_extendedprice / l_quantity < 1500) FROM lineitem
UNION ALL SELECT 'flag', count(*) FILTER (NOT l_returnflag IN ('A', 'N')) FROM lineitem""")
def quality_battery(t, spark):
    """Q2, Q6, Q9: violations of several conditions in one pass."""
    return checks.battery(t("lineitem"), {"positive": F.col("l_quantity") > 20, "price": F.col("l_extendedprice") / F.col("l_quantity") < 1500, "flag": F.col("l_returnflag").isin("A", "N")})


@query("SELECT l_suppkey, l_partkey, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def repeated_keys(t, spark):
    """Keys with several rows."""
    return checks.repeated_keys(t("lineitem"), ["l_suppkey", "l_partkey"])


@query("""
WITH c AS (SELECT p_brand AS k, lower(p_type) AS n FROM part)
SELECT 'id' AS kind, k AS value, count(DISTINCT n) AS variants FROM c GROUP BY 2 HAVING count(DISTINCT n) > 1 UNION ALL SELECT 'name', n, count(DISTINCT k) FROM c GROUP BY 2 HAVING count(DISTINCT k) > 1""")
def catalogue_conflicts(t, spark):
    """Q5: ids with several names, names with several ids, compared normalised."""
    return checks.name_conflicts(t("part").select("p_brand", F.initcap("p_type").alias("name")), "p_brand", "name")


@query("""SELECT o_orderpriority, count(DISTINCT o_orderstatus) AS contents FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderstatus) > 1""")
def version_collisions(t, spark):
    """Q7: a version with different contents."""
    return checks.version_collisions(t("orders"), "o_orderpriority", "o_orderstatus")


@query("""
WITH w AS (SELECT o_orderstatus AS status, count(*) AS written FROM orders WHERE o_totalprice > 5000 GROUP BY 1), e AS (SELECT o_orderstatus AS status, count(*) AS expected FROM orders GROUP BY 1)
SELECT coalesce(w.status, e.status) AS status, coalesce(written, 0) AS written, coalesce(expected, 0) AS expected FROM w FULL JOIN e ON e.status = w.status WHERE written IS DISTINCT FROM expected""")
def write_verification(t, spark):
    """Written rows against expected ones, per scope."""
    rows = t("orders").select(F.col("o_orderstatus").alias("status"), "o_totalprice")
    return checks.verify_counts(rows.filter("o_totalprice > 5000"), rows, ["status"])


@query("""SELECT c_custkey, n_nationkey AS code, n_nationkey <> CASE WHEN c_acctbal < 1000 THEN 24 ELSE c_nationkey END AS stale FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def stale_codes(t, spark):
    """Q11: a code that disagrees with the name is taken from the name."""
    shipped = t("customer").select("c_custkey", F.when(F.col("c_acctbal") < 1000, 24).otherwise(F.col("c_nationkey")).alias("code"), F.concat(F.lit("nation_"), "c_nationkey").alias("name"))
    return checks.stale_codes(shipped, t("nation"), "code", "name", "n_nationkey", "n_name").drop("name")


@query("""
SELECT 'o_orderkey' AS "column", 0::BIGINT AS nulls, 0.0::DOUBLE AS null_share, count(DISTINCT o_orderkey) AS values, min(o_orderkey::VARCHAR) AS low, max(o_orderkey::VARCHAR) AS high, true AS numeric, arg_min(o_orderkey::VARCHAR, md5(o_orderkey::VARCHAR)) AS sample, 'integer' AS inferred FROM orders
UNION ALL SELECT 'status', count(*) FILTER (o_orderstatus = 'P'), round(count(*) FILTER (o_orderstatus = 'P') * 1.0::DOUBLE / count(*), 6), count(DISTINCT CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END), min(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END), max(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END), false, arg_min(o_orderstatus, md5(o_orderstatus)) FILTER (o_orderstatus <> 'P'), 'text' FROM orders""")
def column_profile(t, spark):
    """A profile of each column in one pass."""
    return checks.profile(t("orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status")))


CATALOGUE = Catalogue(
    Indicator(
        "orders_rate", "trade", "orders per 1,000 customers", "nation", "orders",
        """SELECT lpad(cast(c_nationkey AS string), 2, '0') AS geo_key, n_name AS geo_name, date_format(trunc(o_orderdate, 'YEAR'), 'yyyy') AS period,
             round(count(*) * 1000D / any_value(people), 2) AS value, cast(NULL AS string) AS category
           FROM {orders} JOIN {customer} ON c_custkey = o_custkey JOIN {nation} ON n_nationkey = c_nationkey
             JOIN (SELECT c_nationkey AS k, count(*) AS people FROM {customer} GROUP BY 1) ON k = c_nationkey
           WHERE (:year IS NULL OR year(o_orderdate) = :year) AND (:nation IS NULL OR n_name ILIKE :nation) GROUP BY c_nationkey, n_name, trunc(o_orderdate, 'YEAR')""",
        {"year": Parameter("int"), "nation": Parameter("str")},
    ),
    Indicator(
        "status_share", "trade", "percent", "country", "orders",
        """SELECT '00' AS geo_key, 'all' AS geo_name, cast(year(o_orderdate) AS string) AS period, round(count(*) * 100D / sum(count(*)) OVER (PARTITION BY year(o_orderdate)), 2) AS value, o_orderstatus AS category
           FROM {orders} WHERE year(o_orderdate) BETWEEN :first AND :last GROUP BY year(o_orderdate), o_orderstatus""",
        {"first": Parameter("int", True), "last": Parameter("int", True)},
    ),
)


def _frames(t):
    return {name: t(name) for name in ("orders", "customer", "nation")}


@query("""
SELECT lpad(c_nationkey::VARCHAR, 2, '0') AS geo_key, n_name AS geo_name, year(o_orderdate)::VARCHAR AS period, round(count(*) * 1000.0::DOUBLE / any_value(people), 2) AS value, NULL::VARCHAR AS category
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN (SELECT c_nationkey AS k, count(*) AS people FROM customer GROUP BY 1) ON k = c_nationkey
WHERE n_name ILIKE 'nation_1_' GROUP BY c_nationkey, n_name, year(o_orderdate)""")
def indicator_optional(t, spark):
    """An indicator with optional parameters, one of them absent."""
    return CATALOGUE.run(spark, "orders_rate", frames=_frames(t), nation="nation_1_")


@query("""
SELECT '00' AS geo_key, 'all' AS geo_name, year(o_orderdate)::VARCHAR AS period, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY year(o_orderdate)), 2) AS value, o_orderstatus AS category
FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1999 GROUP BY year(o_orderdate), o_orderstatus""")
def indicator_required(t, spark):
    """An indicator with required parameters."""
    return CATALOGUE.run(spark, "status_share", frames=_frames(t), first="1996", last=1999)


@query("""
WITH f AS (SELECT l_orderkey, l_linenumber, n_nationkey AS nation_id, p_partkey AS part_id, l_quantity AS quantity FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN part ON p_partkey = l_partkey)
SELECT l_orderkey, l_linenumber, nation_id, part_id, quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY nation_id, part_id, quantity) AS r FROM f) WHERE r = 1""")
def staged_load(t, spark):
    """Staged rows resolved against their dimensions in one plan, then merged by key."""
    from statkit.operators import lookup

    staged = t("lineitem").join(t("supplier"), F.col("s_suppkey") == F.col("l_suppkey")).join(t("nation").select("n_nationkey", "n_name"), F.col("n_nationkey") == F.col("s_nationkey"))
    staged = staged.select("l_orderkey", "l_linenumber", F.lower("n_name").alias("nation"), "l_partkey", F.col("l_quantity").alias("quantity"))
    facts = lookup.name_lookup(staged, t("nation"), "nation", "n_name", {"n_nationkey": "nation_id"})
    facts = lookup.lookup(facts.withColumnRenamed("l_partkey", "p_partkey").withColumn("part_id", F.col("p_partkey")), lookup.counted(t("part").select("p_partkey", "p_brand")), ["p_partkey"], {"p_brand": "brand"}, "drop")
    facts = facts.select("l_orderkey", "l_linenumber", "nation_id", "part_id", "quantity")
    old = facts.filter("quantity > 40").withColumn("quantity", F.lit(0.0))
    return loads.upsert(old, facts, ["l_orderkey", "l_linenumber"])
