"""Headers, keys, manifests, registers and loads of landed data."""

from __future__ import annotations

import enum

from pyspark.sql import functions as F
from pyspark.sql import types as T

from statkit.functions.codes import padded
from statkit.functions.text import renamed_for, sentence_case
from statkit.operators import cells, checks, loads
from statkit.plans.registry import query
from statkit.plans.shapes import BOXES, _layers
from statkit.plans.sourcing import landing
from statkit.sources import editions, files, seeds


@query("""SELECT c_custkey AS custkey, c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN 2019 ELSE 2022 END AS year FROM customer""")
def headers_by_year(t, spark):
    """Headers in snake case without accents, then the renaming dictionary of the edition's year."""
    names = {2018: {"clave_cte": "custkey", "razon_social": "name"}, 2021: {"id_cliente": "custkey", "denominacion": "name"}}
    old = t("customer").filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias(" CLAVE CTE "), F.col("c_name").alias("Razón  Social"))
    new = t("customer").filter("c_custkey % 2 = 1").select(F.col("c_custkey").alias("Id-Cliente"), F.col("c_name").alias("DENOMINACIÓN"))
    parts = [renamed_for(part, names, year).withColumn("year", F.lit(year)) for part, year in ((old, 2019), (new, 2022))]
    return parts[0].unionByName(parts[1])


@query("""
SELECT p_partkey, regexp_replace(regexp_replace(upper(left(s, 1)) || lower(substr(s, 2)), '\\bPROMO\\b', 'PROMO', 'gi'), '\\bECONOMY\\b', 'Economy', 'gi') AS label
FROM (SELECT p_partkey, p_name || ' OF TYPE ' || p_type AS s FROM part)""")
def sentence_terms(t, spark):
    """Sentence case in which given terms keep their spelling."""
    text = F.concat("p_name", F.lit(" OF TYPE "), "p_type")
    return t("part").select("p_partkey", sentence_case(text, ["PROMO", "Economy"]).alias("label"))


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' WHEN length(c_custkey::VARCHAR) >= 4 THEN c_custkey::VARCHAR ELSE lpad(c_custkey::VARCHAR, 4, '0') END AS key FROM customer""")
def padded_keys(t, spark):
    """Zero padding; empty stays empty, longer text stays whole."""
    raw = F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_custkey").cast("string"))
    return t("customer").select("c_custkey", padded(raw, 4).alias("key"))


@query("""
SELECT c_custkey, c_name, c_nationkey, 'customer' AS source, '2024-01' AS version, DATE '2024-02-03' AS processed,
  sha256(coalesce(c_custkey::VARCHAR, '') || chr(31) || coalesce(c_name, '') || chr(31) || coalesce(c_nationkey::VARCHAR, '')) AS content_sha256
FROM customer""")
def traced_rows(t, spark):
    """Source, version, processing date and content hash of each row."""
    return loads.traced(t("customer").select("c_custkey", "c_name", "c_nationkey"), "customer", "2024-01", "2024-02-03")


@query("""
SELECT 'key' AS "column", count(*) AS given, 0::BIGINT AS unreadable FROM orders
UNION ALL SELECT 'customer', count(*), count(*) FILTER (o_orderkey % 7 = 0) FROM orders
UNION ALL SELECT 'day', count(*) FILTER (o_orderkey % 5 <> 0), count(*) FILTER (o_orderkey % 5 = 1) FROM orders""")
def unreadable_values(t, spark):
    """Q10: values that the modelled types can't hold, counted by column before they turn null."""
    k = F.col("o_orderkey")
    day = F.when(k % 5 == 1, "31/31/1999").when(k % 5 > 1, F.date_format("o_orderdate", "yyyy-MM-dd"))
    raw = t("orders").select(k.cast("string").alias("key"), F.when(k % 7 == 0, F.lit("n.d.")).otherwise(F.col("o_custkey").cast("string")).alias("customer"), day.alias("day"))
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("customer", T.LongType()), T.StructField("day", T.DateType())])
    return checks.unreadable(raw, schema)


@query("""SELECT s_suppkey, s_name FROM supplier""")
def required_columns(t, spark):
    """Q1, Q2, Q3: rows pass only if the required columns exist, hold no null and are a key."""
    return checks.require(t("supplier"), ["s_suppkey", "s_name"], ["s_suppkey", "s_name"], ["s_suppkey"]).select("s_suppkey", "s_name")


@query("""
WITH s AS (SELECT count(*) FILTER (s_suppkey % 3 = 0) AS nulls, (SELECT n_nationkey FROM nation ORDER BY n_nationkey LIMIT 1) AS first FROM supplier)
SELECT 'good' AS name, count(*) AS rows, false AS failed, NULL::VARCHAR AS error FROM supplier
UNION ALL SELECT 'missing', NULL, true, 'CheckFailed: missing columns: [''no_such_column'']' FROM s
UNION ALL SELECT 'nulls', NULL, true, 'CheckFailed: nulls: {''name'': ' || nulls || '}' FROM s
UNION ALL SELECT 'repeated', NULL, true, 'CheckFailed: repeated keys: [(' || first || ', 2)]' FROM s""")
def failed_checks(t, spark):
    """Q1, Q2, Q3: what each check says of a table that has a violation, and of one that has none."""
    supplier, nation = t("supplier"), t("nation")
    gaps = supplier.select(F.when(F.col("s_suppkey") % 3 != 0, F.col("s_name")).alias("name"))
    twice = nation.select("n_nationkey").unionByName(nation.orderBy("n_nationkey").limit(1).select("n_nationkey"))
    return loads.load_report(spark, loads.tried({
        "good": lambda: checks.require(supplier, ["s_suppkey", "s_name"], ["s_suppkey", "s_name"], ["s_suppkey"]).count(),
        "missing": lambda: checks.require(supplier, ["s_suppkey", "no_such_column"]).count(),
        "nulls": lambda: checks.require(gaps, ["name"], ["name"]).count(),
        "repeated": lambda: checks.require(twice, unique=["n_nationkey"]).count(),
    }))


class OrderStatus(enum.Enum):
    FILLED = "F"
    OPEN = "O"
    PARTLY_FILLED = "P"
    NEVER_SEEN = "N"


@query("""
SELECT s.id, s.code, s.label, count(o_orderkey) AS orders FROM (VALUES (1, 'FILLED', 'Filled', 'F'), (2, 'OPEN', 'Open', 'O'), (3, 'PARTLY_FILLED', 'Partly filled', 'P'), (4, 'NEVER_SEEN', 'Never seen', 'N')) s(id, code, label, status)
LEFT JOIN orders ON o_orderstatus = s.status GROUP BY ALL""")
def seeded_statuses(t, spark):
    """An enumeration as a catalogue, with the facts of each member; members without facts stay."""
    codes = {m.value: m.name for m in OrderStatus}
    named = t("orders").replace(codes, subset=["o_orderstatus"]).groupBy(F.col("o_orderstatus").alias("code")).agg(F.count(F.lit(1)).alias("orders"))
    return seeds.seed(spark, OrderStatus).join(named, "code", "left").fillna(0, ["orders"]).select("id", "code", "label", "orders")


@query("""
WITH m AS (SELECT event_type AS folder, CASE WHEN event_id % 4 = 0 THEN 'draft' ELSE 'complete' END AS state, event_id AS uploaded, event_id % 3 AS slot, 'u' || user_id AS name FROM events)
SELECT folder, slot, uploaded, name FROM (SELECT *, row_number() OVER (PARTITION BY folder, slot ORDER BY uploaded DESC, name DESC) AS r FROM m WHERE state = 'complete') WHERE r = 1""")
def newest_upload(t, spark):
    """JSON manifests, landed and read again; of complete uploads the newest of each slot."""
    path = landing(spark)
    listed = F.array(F.struct((F.col("event_id") % 3).alias("slot"), F.concat(F.lit("u"), "user_id").alias("name")))
    state = F.when(F.col("event_id") % 4 == 0, "draft").otherwise("complete")
    t("events").select(F.col("event_type").alias("folder"), state.alias("state"), F.col("event_id").alias("uploaded"), listed.alias("files")).write.json(path)
    manifests = spark.read.schema("folder string, state string, uploaded long, files array<struct<slot:long,name:string>>").json(path)
    return editions.newest_uploads(manifests).select("folder", "slot", "uploaded", "name")


@query("""SELECT lpad(c_custkey::VARCHAR, 6, '0') AS key, c_name AS name FROM customer""")
def nested_header_sheet(t, spark):
    """A sheet whose two header rows and notes stand among the rows; rows are told by their key."""
    path = landing(spark)
    rows = t("customer").select(F.lpad(F.col("c_custkey").cast("string"), 6, "0").alias("a"), F.col("c_name").alias("b"))
    heads = t("region").select(F.lit("Key").alias("a"), F.concat(F.lit("Table of "), "r_name").alias("b"))
    heads.unionByName(rows).unionByName(heads.withColumn("a", F.lit(None).cast("string"))).write.csv(path)
    return files.sheet_rows(files.delimited(spark, path, ["a", "b"]), ["key", "name"], "^[0-9]{6}$")


@query("""
WITH f AS (SELECT p_partkey AS modified, p_brand || '-' || p_size AS etag FROM part), r AS (SELECT * FROM f WHERE modified < (SELECT max(modified) // 2 FROM f))
SELECT etag, modified FROM f WHERE modified > (SELECT max(modified) FROM r) AND etag NOT IN (SELECT etag FROM r)""")
def load_register(t, spark):
    """Objects newer than a load register's high-water mark whose content tag it has not seen."""
    landed = t("part").select(F.col("p_partkey").alias("modified"), F.concat_ws("-", "p_brand", "p_size").alias("etag"))
    half = landed.agg(F.floor(F.max("modified") / 2).alias("half"))
    register = landed.join(F.broadcast(half), F.col("modified") < F.col("half")).drop("half")  # one row
    return editions.unseen(landed, register).select("etag", "modified")


@query("""
SELECT 'nation' AS name, count(*) AS rows, false AS failed, NULL::VARCHAR AS error FROM nation UNION ALL SELECT 'region', count(*), false, NULL FROM region
UNION ALL SELECT 'suppliers without phone', NULL, true, 'CheckFailed: missing columns: [''no_such_column'']' FROM (SELECT count(*) FROM supplier)""")
def isolated_loads(t, spark):
    """Independent loads; one that fails does not stop the others; what each gave is a row."""
    path = landing(spark)

    def load(name, columns=()):
        def run():
            typed, seen = loads.counted(checks.require(t(name), columns).select(*[F.col(c).cast("string") for c in t(name).columns]), t(name).schema)
            loads.append(typed, f"{path}/{name}")
            return seen.get["rows"]

        return run

    return loads.load_report(spark, loads.tried({"nation": load("nation"), "suppliers without phone": load("supplier", ["no_such_column"]), "region": load("region")}))


@query(BOXES + """
, c AS (SELECT a, x0 + x AS cx, y0 + y AS cy FROM a, range(9) r(x), range(6) s(y) WHERE x < w AND y < h),
d AS (SELECT DISTINCT x0 + x AS cx, y0 + y AS cy FROM b, range(12) r(x), range(12) s(y))
SELECT a, count(*) AS cells FROM c SEMI JOIN d ON c.cx = d.cx AND c.cy = d.cy GROUP BY a""")
def clipped_cells(t, spark):
    """Each unit's cells inside a mask."""
    a, b = _layers(t)
    return cells.clip(a, b).groupBy("a").agg(F.count(F.lit(1)).alias("cells"))


@query("""
SELECT o_orderkey, c_name, n_name FROM orders JOIN customer ON c_custkey = o_custkey AND c_acctbal > 0 AND o_orderstatus = 'F' JOIN nation ON n_nationkey = c_nationkey AND n_regionkey <> 0""")
def filtered_joins(t, spark):
    """Inner joins whose conditions hold filters too; they reach the scans."""
    out = t("orders").join(t("customer"), (F.col("c_custkey") == F.col("o_custkey")) & (F.col("c_acctbal") > 0) & (F.col("o_orderstatus") == "F"))
    return out.join(t("nation"), (F.col("n_nationkey") == F.col("c_nationkey")) & (F.col("n_regionkey") != 0)).select("o_orderkey", "c_name", "n_name")
