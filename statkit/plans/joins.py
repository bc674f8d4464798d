"""Lookups and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from statkit.functions.codes import sector_of
from statkit.operators import lookup, ranking, rates
from statkit.plans.registry import query


@query("""
SELECT o_orderkey, c_name AS customer, c_mktsegment AS segment, n_name AS nation, r_name AS region
FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""")
def star_denormalise(t, spark):
    """A star and its hierarchy resolved to labels."""
    steps = [
        (t("customer"), "o_custkey", "c_custkey", {"c_name": "customer", "c_mktsegment": "segment", "c_nationkey": "nation_id"}),
        (t("nation"), "nation_id", "n_nationkey", {"n_name": "nation", "n_regionkey": "region_id"}),
        (t("region"), "region_id", "r_regionkey", {"r_name": "region"}),
    ]
    return lookup.denormalised(t("orders"), *steps).select("o_orderkey", "customer", "segment", "nation", "region")


@query("""
WITH f AS (SELECT c_custkey, CASE WHEN c_nationkey < 5 THEN 'Nátion_' || c_nationkey WHEN c_nationkey < 10 THEN '  NATION_' || c_nationkey || ' ' WHEN c_nationkey = 10 THEN 'old ten' ELSE 'nowhere' END AS name FROM customer)
SELECT c_custkey, name, n_nationkey AS nation FROM f LEFT JOIN nation
  ON CASE WHEN name = 'old ten' THEN 'nation_10' ELSE lower(trim(replace(name, 'á', 'a'))) END = lower(n_name)""")
def normalised_lookup(t, spark):
    """Names compared without accents, case and spaces; aliases redirected first."""
    key = F.col("c_nationkey")
    name = F.when(key < 5, F.concat(F.lit("Nátion_"), key)).when(key < 10, F.concat(F.lit("  NATION_"), key, F.lit(" "))).when(key == 10, "old ten").otherwise("nowhere")
    facts = t("customer").select("c_custkey", name.alias("name"))
    return lookup.name_lookup(facts, t("nation"), "name", "n_name", {"n_nationkey": "nation"}, aliases={"old ten": "nation_10"})


@query("""
WITH d AS (SELECT DISTINCT p_brand AS brand, p_type AS type, min(p_partkey) OVER (PARTITION BY p_brand, p_type) AS id FROM part),
f AS (SELECT p_partkey, p_brand AS brand, CASE WHEN p_size > 45 THEN 'UNKNOWN' ELSE lower(p_type) END AS type FROM part)
SELECT p_partkey, f.brand, f.type, d.id FROM f LEFT JOIN d ON d.brand = f.brand AND lower(d.type) = f.type""")
def scoped_lookup(t, spark):
    """Names resolved inside their own scope; unresolved ones stay null."""
    dim = t("part").groupBy(F.col("p_brand").alias("brand"), F.col("p_type").alias("label")).agg(F.min("p_partkey").alias("pid"))
    facts = t("part").select("p_partkey", F.col("p_brand").alias("brand"), F.when(F.col("p_size") > 45, "UNKNOWN").otherwise(F.lower("p_type")).alias("type"))
    return lookup.name_lookup(facts, dim, "type", "label", {"pid": "id"}, scope=[("brand", "brand")])


@query("""
WITH d AS (SELECT p_type AS code, year(o_orderdate)::INTEGER AS edition, max(p_brand) AS label FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey WHERE l_quantity > 25 GROUP BY 1, 2)
SELECT l_orderkey, l_linenumber, p_type AS code, year(o_orderdate)::INTEGER AS edition, label
FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey LEFT JOIN d ON d.code = p_type AND d.edition = year(o_orderdate)""")
def versioned_lookup(t, spark):
    """A code means what its own edition's code book says."""
    facts = t("lineitem").join(t("part"), F.col("p_partkey") == F.col("l_partkey")).join(t("orders"), F.col("o_orderkey") == F.col("l_orderkey"))
    facts = facts.select("l_orderkey", "l_linenumber", F.col("p_type").alias("code"), F.year("o_orderdate").alias("edition"), "p_brand", "l_quantity")
    book = facts.filter("l_quantity > 25").groupBy("code", "edition").agg(F.max("p_brand").alias("name"))
    return lookup.lookup(facts.drop("p_brand", "l_quantity"), book, ["code", "edition"], {"name": "label"})


@query("""
SELECT l_orderkey, l_linenumber, a.n_name AS sold_to, b.n_name AS sold_by FROM lineitem JOIN orders ON o_orderkey = l_orderkey
  JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN nation a ON a.n_nationkey = c_nationkey LEFT JOIN nation b ON b.n_nationkey = s_nationkey""")
def multi_role_lookup(t, spark):
    """One dimension in two roles."""
    facts = t("lineitem").join(t("orders"), F.col("o_orderkey") == F.col("l_orderkey")).join(t("customer"), F.col("c_custkey") == F.col("o_custkey")).join(t("supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
    facts = facts.select("l_orderkey", "l_linenumber", "c_nationkey", "s_nationkey")
    return lookup.roles(facts, t("nation"), "n_nationkey", "n_name", {"c_nationkey": "sold_to", "s_nationkey": "sold_by"}).select("l_orderkey", "l_linenumber", "sold_to", "sold_by")


@query("""
WITH g AS (SELECT l_suppkey AS supplier, l_returnflag AS flag, avg(l_extendedprice) AS estimate, stddev_samp(l_extendedprice) AS error FROM lineitem GROUP BY 1, 2)
SELECT supplier, flag, round(max(estimate), 4) AS estimate, round(max(error) * 100 / nullif(max(estimate), 0), 4) AS cv FROM g GROUP BY 1, 2""")
def estimate_with_error(t, spark):
    """Estimates beside their errors on (key, period), in one pass over a long table of roles."""
    g = t("lineitem").groupBy(F.col("l_suppkey").alias("supplier"), F.col("l_returnflag").alias("flag")).agg(F.avg("l_extendedprice").alias("e"), F.stddev_samp("l_extendedprice").alias("s"))
    long = g.select("supplier", "flag", F.inline(F.array(F.struct(F.lit("estimate").alias("role"), F.col("e").alias("value")), F.struct(F.lit("error").alias("role"), F.col("s").alias("value")))))
    value = lambda role: F.max(F.when(F.col("role") == role, F.col("value")))
    return long.groupBy("supplier", "flag").agg(F.round(value("estimate"), 4).alias("estimate"), rates.ratio(value("error"), value("estimate"), 100, 4).alias("cv"))


@query("""SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 200000)
  AND c_nationkey IN (SELECT s_nationkey FROM supplier)""")
def semi_exists(t, spark):
    """EXISTS and IN as semi joins."""
    big = t("orders").filter("o_totalprice > 200000")
    rows = t("customer").join(big, F.col("o_custkey") == F.col("c_custkey"), "left_semi").join(t("supplier"), F.col("s_nationkey") == F.col("c_nationkey"), "left_semi")
    return rows.select("c_custkey", "c_name")


@query("""
WITH d AS (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
SELECT o_orderkey, d.c_custkey AS customer FROM orders LEFT JOIN d ON d.c_custkey = o_custkey""")
def null_bad_fk(t, spark):
    """Foreign keys that the dimension lacks become null."""
    facts = t("orders").select("o_orderkey", F.col("o_custkey").alias("customer"))
    return lookup.null_foreign_keys(facts, t("customer").filter("c_acctbal > 0"), "customer", "c_custkey")


@query("""
WITH d AS (SELECT row_number() OVER (ORDER BY p_type) AS id, p_type AS key FROM (SELECT DISTINCT p_type FROM part WHERE p_size > 48)),
n AS (SELECT DISTINCT p_type || '/' || p_brand AS key FROM part WHERE p_size <= 3 UNION SELECT p_type FROM part)
SELECT id, key, 'known' AS label FROM d UNION ALL
SELECT (SELECT max(id) FROM d) + row_number() OVER (ORDER BY key), key, 'NOT DESCRIBED' FROM n WHERE key NOT IN (SELECT key FROM d)""")
def get_or_create_dim(t, spark):
    """New members go on after the last id, with a placeholder label."""
    known = t("part").filter("p_size > 48").select(F.col("p_type").alias("key")).distinct()
    dim = ranking.numbered(known, ["key"]).select("id", "key", F.lit("known").alias("label"))
    seen = t("part").filter("p_size <= 3").select(F.concat_ws("/", "p_type", "p_brand").alias("key")).unionByName(t("part").select(F.col("p_type").alias("key")))
    return lookup.get_or_create(seen, dim, "key", "id", "label")


@query("""SELECT a.user_id, a.event_type, n, top FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL) a
  LEFT JOIN (SELECT user_id, event_type, max(value) AS top FROM events WHERE value > 20 GROUP BY ALL) b ON a.user_id = b.user_id AND a.event_type = b.event_type""")
def merge_common_keys(t, spark):
    """Joined on those candidate keys that both sides have."""
    a = t("events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    b = t("events").filter("value > 20").groupBy("user_id", "event_type").agg(F.max("value").alias("top"))
    return lookup.merged(a, b, ["state", "user_id", "event_type", "year"])


@query("""SELECT o_orderkey, coalesce((SELECT string_agg(DISTINCT p_type, ', ' ORDER BY p_type) FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_orderkey = o_orderkey), '') AS types FROM orders""")
def correlated_list(t, spark):
    """An ordered list per row, made before the join."""
    items = t("lineitem").join(t("part"), F.col("p_partkey") == F.col("l_partkey")).select(F.col("l_orderkey").alias("o_orderkey"), "p_type")
    return t("orders").select("o_orderkey").join(lookup.ordered_list(items, ["o_orderkey"], F.col("p_type"), "types"), "o_orderkey", "left").fillna("", ["types"])


@query("""
WITH c AS (SELECT p_partkey, lpad((31 + p_size % 20)::VARCHAR, 2, '0') || lpad((p_partkey % 10000)::VARCHAR, 4, '0') AS code FROM part)
SELECT CASE WHEN left(code, 2) IN ('31', '32', '33') THEN '31-33' WHEN left(code, 2) IN ('48', '49') THEN '48-49' ELSE left(code, 2) END AS sector,
  count(*) AS n, count(DISTINCT left(code, 3)) AS subsectors, count(DISTINCT left(code, 4)) AS branches FROM c GROUP BY 1""")
def code_prefix_hierarchy(t, spark):
    """Ancestors of a code by its prefix, with merged ranges."""
    code = F.concat(F.lpad((F.col("p_size") % 20 + 31).cast("string"), 2, "0"), F.lpad((F.col("p_partkey") % 10000).cast("string"), 4, "0"))
    coded = t("part").select(code.alias("code"))
    return coded.groupBy(sector_of(F.col("code")).alias("sector")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(F.substring("code", 1, 3)).alias("subsectors"), F.countDistinct(F.substring("code", 1, 4)).alias("branches"))


@query("""SELECT o_orderstatus AS status, o_custkey AS customer, count(*) AS rows FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 100) GROUP BY 1, 2""")
def unmatched_report(t, spark):
    """Keys without an entry, counted."""
    dim = t("customer").filter("c_acctbal > 100").select(F.explode(F.array(*map(F.lit, "FOP"))).alias("status"), F.col("c_custkey").alias("customer"))
    facts = t("orders").select(F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("customer"))
    return lookup.unmatched_counts(facts, dim, ["status", "customer"])
