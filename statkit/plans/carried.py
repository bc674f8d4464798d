"""Queries on quadtrees, archives, carry scans, commits, upserting streams, marts and registers."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from statkit.operators import carry, checks, commits, loads, lookup, marts, quadtree, registry, sketches
from statkit.plans.registry import query
from statkit.plans.sourcing import landing
from statkit.sources import archives
from statkit.streaming import upserts

#: boxes on a grid of 1/16: of parts, up to 46 x 41 units, and of suppliers, 40 x 40 units side by side
FINE = """
WITH a AS (SELECT p_partkey AS a, (p_partkey % 40) * 9 + (p_size % 16) / 16.0 AS x0, (p_partkey // 40 % 50) * 7 + (p_size % 5) / 16.0 AS y0, 1 + p_size % 46 + (p_partkey % 16) / 16.0 AS w, 1 + p_size % 41 + 0.5 AS h FROM part),
b AS (SELECT s_suppkey AS b, (s_suppkey % 10) * 40 AS x0, (s_suppkey // 10) * 40 AS y0, 40 AS w, 40 AS h FROM supplier)"""


def _fine(t):
    k, size = F.col("p_partkey"), F.col("p_size")
    x, y = (k % 40) * 9 + (size % 16) / 16, F.floor(k / 40) % 50 * 7 + (size % 5) / 16
    a = t("part").select(k.alias("a"), x.alias("x0"), y.alias("y0"), (x + 1 + size % 46 + (k % 16) / 16).alias("x1"), (y + 1 + size % 41 + 0.5).alias("y1"))
    k = F.col("s_suppkey")
    x, y = (k % 10) * 40, F.floor(k / 10) * 40
    b = t("supplier").select(k.alias("b"), x.alias("x0"), y.alias("y0"), (x + 40).alias("x1"), (y + 40).alias("y1"))
    box = ("x0", "y0", "x1", "y1")
    return quadtree.tiles(a, ["a"], *box, 1 / 16), quadtree.tiles(b, ["b"], *box, 1 / 16)


@query(FINE + """
, j AS (SELECT a, b, (least(a.x0 + a.w, b.x0 + b.w) - greatest(a.x0, b.x0)) * (least(a.y0 + a.h, b.y0 + b.h) - greatest(a.y0, b.y0)) AS area, a.w * a.h AS sa, b.w * b.h AS sb
  FROM a JOIN b ON a.x0 < b.x0 + b.w AND b.x0 < a.x0 + a.w AND a.y0 < b.y0 + b.h AND b.y0 < a.y0 + a.h)
SELECT a, b, area::DOUBLE AS area, round(area * 100.0::DOUBLE / sa, 6) AS share_a, round(area * 100.0::DOUBLE / sb, 6) AS share_b FROM j""")
def quad_overlay(t, spark):
    """Areas of intersections and their shares on a fine grid, by prefix joins of the quadtree cells of the boxes' sizes."""
    a, b = _fine(t)
    return quadtree.overlay_tiles(a, b, "a", "b", 1 / 16)


@query(FINE + """
, k AS (SELECT b.b, a.a, greatest(a.x0, b.x0) AS x0, least(a.x0 + a.w, b.x0 + b.w) AS x1, greatest(a.y0, b.y0) AS y0, least(a.y0 + a.h, b.y0 + b.h) AS y1
  FROM a JOIN b ON a.x0 < b.x0 + b.w AND b.x0 < a.x0 + a.w AND a.y0 < b.y0 + b.h AND b.y0 < a.y0 + a.h),
xs AS (SELECT b, x, lead(x) OVER (PARTITION BY b ORDER BY x) - x AS dx FROM (SELECT b, x0 AS x FROM k UNION SELECT b, x1 FROM k)),
ys AS (SELECT b, y, lead(y) OVER (PARTITION BY b ORDER BY y) - y AS dy FROM (SELECT b, y0 AS y FROM k UNION SELECT b, y1 FROM k)),
g AS (SELECT DISTINCT k.b, xs.x, ys.y, dx, dy FROM k JOIN xs ON xs.b = k.b AND xs.x >= x0 AND xs.x < x1 JOIN ys ON ys.b = k.b AND ys.y >= y0 AND ys.y < y1)
SELECT b, sum(dx * dy)::DOUBLE AS area FROM g GROUP BY b""")
def quad_dissolve(t, spark):
    """The part of each unit that the union of all other boxes covers."""
    a, b = _fine(t)
    return quadtree.united_areas(quadtree.shared_tiles(a, b, "a", "b"), ["b"], 1 / 16)


@query("""
WITH p AS (SELECT p_brand AS g, p_partkey % 60 AS cx, p_partkey // 60 % 60 AS cy FROM part WHERE p_size % 9 <> 0
  UNION ALL SELECT p_brand, p_partkey % 60 + 1, p_partkey // 60 % 60 FROM part WHERE p_size % 9 <> 0)
SELECT g, count(*)::DOUBLE AS area FROM (SELECT DISTINCT * FROM p) GROUP BY g""")
def quad_merge(t, spark):
    """Scattered unit cells merged upwards into quadtree cells; the area of each key's union."""
    part = t("part").filter("p_size % 9 <> 0")
    cell = lambda more: part.select(F.col("p_brand").alias("g"), (F.col("p_partkey") % 60 + more).alias("cx"), (F.floor(F.col("p_partkey") / 60) % 60).alias("cy"))
    return quadtree.areas(quadtree.from_cells(cell(0).unionByName(cell(1)), ["g"]), ["g"])


@query("""
WITH r AS (SELECT 'a' || (c_custkey % 5) || '.zip' AS file, CASE WHEN c_custkey % 5 = 3 THEN 'notes.txt' WHEN c_custkey % 5 = 0 AND c_custkey % 2 = 0 THEN 'exact.csv' ELSE 'datos_' || (1 + c_custkey % 12) || '.csv' END AS member,
    c_custkey || ';' || c_name AS line FROM customer),
m AS (SELECT file, CASE WHEN max(member = 'exact.csv') THEN 'exact.csv' ELSE max_by(member, TRY_CAST(regexp_extract(member, '[0-9]+') AS INTEGER)) FILTER (member LIKE 'datos%') END AS member
  FROM (SELECT file, member, member LIKE 'datos%' AS d FROM r) GROUP BY file)
SELECT m.file, m.member, count(r.line) AS lines, coalesce(sum(length(line)), 0)::BIGINT AS chars FROM m LEFT JOIN r ON r.file = m.file AND r.member = m.member GROUP BY ALL""")
def archive_members(t, spark):
    """Zip archives of several editions; the member of the expected name, else the newest edition; an archive without one is a row."""
    path, k = landing(spark), F.col("c_custkey")
    member = F.when(k % 5 == 3, "notes.txt").when((k % 5 == 0) & (k % 2 == 0), "exact.csv").otherwise(F.concat(F.lit("datos_"), 1 + k % 12, F.lit(".csv")))
    rows = t("customer").select(F.concat(F.lit("a"), k % 5, F.lit(".zip")).alias("archive"), member.alias("member"), k.alias("number"), F.concat_ws(";", k, "c_name").alias("line"))
    archives.write_archives(rows, path, "archive", "member", "number", "line")
    lines = archives.archive_lines(spark, path, expected="exact.csv", pattern="datos_*.csv", missing="row")
    file = F.element_at(F.split("file", "/"), -1).alias("file")
    return lines.groupBy(file, "member").agg(F.count("line").alias("lines"), F.coalesce(F.sum(F.length("line").cast("bigint")), F.lit(0)).alias("chars"))


@query("""
WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN o_clerk_ END AS clerk, o_orderkey % 50 = 3 AS head FROM (SELECT *, 'c' || (o_custkey % 90) AS o_clerk_ FROM orders)),
b AS (SELECT *, last_value(clerk IGNORE NULLS) OVER w AS filled, sum(head::INTEGER) OVER w AS block FROM r WINDOW w AS (ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING))
SELECT o_orderkey, filled, block::BIGINT AS block, row_number() OVER (PARTITION BY block ORDER BY o_orderkey) AS n FROM b""")
def long_file_fill(t, spark):
    """Along one file without groups, merged cells filled down and rows counted from each heading."""
    key = F.col("o_orderkey")
    rows = t("orders").select("o_orderkey", F.when(key % 7 == 0, F.concat(F.lit("c"), F.col("o_custkey") % 90)).alias("filled"))
    return carry.count_on(carry.fill_down(rows, ["o_orderkey"], ["filled"]), ["o_orderkey"], key % 50 == 3).select("o_orderkey", "filled", "block", "n")


@query("""
WITH r AS (SELECT l_orderkey AS k, l_linenumber AS i, l_partkey AS j, CASE WHEN l_orderkey % 64 = 1 AND l_linenumber = 1 THEN 'C' || l_orderkey END AS c, CASE WHEN l_partkey % 11 = 0 THEN 'S' || l_partkey END AS s FROM lineitem),
p AS (SELECT *, row_number() OVER (ORDER BY k, i, j) AS n FROM r),
m AS (SELECT *, max(CASE WHEN c IS NOT NULL THEN n END) OVER w AS cn, max(CASE WHEN s IS NOT NULL THEN n END) OVER w AS sn, last_value(c IGNORE NULLS) OVER w AS chapter, last_value(s IGNORE NULLS) OVER w AS sec
  FROM p WINDOW w AS (ORDER BY n ROWS UNBOUNDED PRECEDING))
SELECT k AS l_orderkey, i AS l_linenumber, chapter, CASE WHEN sn > coalesce(cn, 0) THEN sec END AS section FROM m""")
def long_file_outline(t, spark):
    """Along one file without groups, the chapter and section that each row stands under; a chapter ends the section before it."""
    rows = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    chapter = F.when((F.col("l_orderkey") % 64 == 1) & (F.col("l_linenumber") == 1), F.concat(F.lit("C"), "l_orderkey"))
    section = F.when(F.col("l_partkey") % 11 == 0, F.concat(F.lit("S"), "l_partkey"))
    return carry.outline(rows, ["l_orderkey", "l_linenumber", "l_partkey"], {"chapter": chapter, "section": section}).drop("l_partkey")


@query("""
WITH r AS (SELECT user_id, event_type, event_id AS version, value, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS i FROM events)
SELECT user_id, event_type, version, value FROM r WHERE i = 1""")
def upsert_stream(t, spark):
    """Files of several editions upserted file by file into one table, each micro-batch once; a later version of a key replaces it."""
    path = landing(spark)
    rows = t("events").select("user_id", "event_type", F.col("event_id").alias("version"), "value")
    cuts = rows.agg(F.percentile_approx("version", F.array(F.lit(0.4), F.lit(0.7)), 1000).alias("c")).first()["c"]
    for part in (F.col("version") <= cuts[0], F.col("version").between(cuts[0] + 1, cuts[1]), F.col("version") > cuts[1]):
        rows.filter(part).coalesce(1).write.mode("append").parquet(f"{path}/landed")
        upserts.ingest_upserts(spark, f"{path}/landed", rows.schema, f"{path}/table", f"{path}/state", ["user_id", "event_type"], upserts.newest("version"), files=1)
    return upserts.table(spark, f"{path}/table")


@query("""
SELECT r_name, count(o_orderkey) AS orders, round(sum(o_totalprice), 2) AS total, 4::BIGINT AS first, 2::BIGINT AS changed, 2::BIGINT AS kept
FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey GROUP BY r_name""")
def mart_chain(t, spark):
    """Marts on three levels; after one table changed, only those that depend on it are made anew."""
    path = landing(spark)
    bases = {name: f"{path}/base/{name}" for name in ("orders", "customer", "nation")}
    commits.replace(t("orders").filter("o_orderstatus = 'F'"), bases["orders"])
    commits.replace(t("customer"), bases["customer"])
    commits.replace(t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name"), bases["nation"])
    by_customer = lambda o: o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"), F.sum("o_totalprice").alias("total"))
    chain = [
        marts.Mart("by_region", ["per_customer", "places"], lambda c, p: c.join(p, F.col("o_custkey") == F.col("c_custkey")).groupBy("r_name").agg(F.sum("orders").alias("orders"), F.round(F.sum("total"), 2).alias("total"))),
        marts.Mart("per_customer", ["orders"], by_customer),
        marts.Mart("places", ["customer", "nation"], lambda c, n: c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "r_name")),
        marts.Mart("customers_by_region", ["places"], lambda p: p.groupBy("r_name").count()),
    ]
    began = marts.refresh(spark, f"{path}/marts", chain, bases)
    commits.replace(t("orders"), bases["orders"])
    again = marts.refresh(spark, f"{path}/marts", chain, bases)
    count = lambda done, state: F.lit(sum(x == state for x in done.values())).cast("long").alias(state)
    return marts.read(spark, f"{path}/marts", "by_region").select("r_name", "orders", "total", count(began, "first"), count(again, "changed"), count(again, "kept"))


@query("""
WITH r AS (SELECT o_orderpriority AS object, count(*) AS n, count(*) FILTER (o_orderkey % 9 = 0) AS bad, max(o_orderkey) AS top FROM orders GROUP BY 1)
SELECT 's2' AS submission, object, CASE WHEN object LIKE '1%' THEN 'failed' ELSE 'loaded' END AS state, CASE WHEN object NOT LIKE '1%' THEN n END AS rows, CASE WHEN object NOT LIKE '1%' THEN bad END AS unreadable,
  CASE WHEN object LIKE '1%' THEN 'CheckFailed: missing columns: [''no_such_column'']' END AS error FROM r
UNION ALL SELECT 's1', object, 'loaded', n, bad, NULL FROM r""")
def submission_register(t, spark):
    """Loads one by one, each with a row of the register; counts come from the writing job; a failed one is told, the others stay."""
    path = landing(spark)
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("total", T.DoubleType())])
    total = F.when(F.col("o_orderkey") % 9 == 0, F.lit("n.d.")).otherwise(F.col("o_totalprice").cast("string"))
    rows = t("orders").select("o_orderpriority", F.col("o_orderkey").cast("string").alias("key"), total.alias("total"))
    objects = sorted(r[0] for r in rows.select("o_orderpriority").distinct().collect())  # the kinds of priority

    def load(name: str, submission: str):
        def run():
            frame = rows.filter(F.col("o_orderpriority") == name).drop("o_orderpriority")
            if submission == "s2" and name.startswith("1"):
                checks.require(frame, ["no_such_column"])
            typed, seen = loads.counted(frame, schema)
            loads.append(typed, f"{path}/table")
            return {"rows": seen.get["rows"], "unreadable": seen.get["unreadable_total"]}

        return lambda: loads.registered(spark, f"{path}/register", submission, name, run)["rows"]

    for submission in ("s1", "s2", "s2"):  # the second one is sent twice: its rows of the register are replaced
        loads.tried({name: load(name, submission) for name in objects})
    found = commits.read(spark, f"{path}/register", commits.head(spark, f"{path}/register"))
    return found.select("submission", "object", "state", F.col("counts")["rows"].alias("rows"), F.col("counts")["unreadable"].alias("unreadable"), "error")


@query("""
WITH o AS (SELECT o_orderkey::VARCHAR AS o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders)
SELECT 'o_orderkey' AS "column", count(*) AS rows, 0::BIGINT AS nulls, min(o_orderkey) AS low, max(o_orderkey) AS high, 'integer' AS inferred, count(DISTINCT o_orderkey) AS values, true AS close, true AS same, NULL::VARCHAR AS frequent FROM o
UNION ALL SELECT 'status', count(*), count(*) FILTER (status IS NULL), min(status), max(status), 'text', count(DISTINCT status), true, true, (SELECT string_agg(status || '=' || n, ',' ORDER BY n DESC, status) FROM (SELECT status, count(*) AS n FROM o WHERE status IS NOT NULL GROUP BY 1)) FROM o
UNION ALL SELECT 'day', count(*), 0, min(day), max(day), 'date', count(DISTINCT day), true, true, NULL FROM o""")
def merged_profile(t, spark):
    """Each year's profile state is stored; merged, they tell what a profile of all rows tells. Exact counts and frequent values on request."""
    rows = t("orders").select(F.col("o_orderkey").cast("string").alias("o_orderkey"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.year("o_orderdate").alias("year"))
    path, columns = landing(spark), ["o_orderkey", "status", "day"]
    sketches.states(rows, columns, ["year"]).write.partitionBy("year").parquet(path)  # the editions, in one pass
    merged = sketches.shown(sketches.merged(spark.read.parquet(path)))
    whole = sketches.shown(sketches.states(rows, columns)).select("column", F.col("values").alias("whole"))
    exact = sketches.exact_values(rows, columns).withColumnRenamed("values", "exact")
    top = sketches.frequent(rows, ["status"]).groupBy("column").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "value", "n"))), lambda x: F.concat_ws("=", x["value"], x["n"])), ",").alias("frequent"))
    out = merged.join(whole, "column").join(exact, "column").join(top, "column", "left")
    same = F.abs(F.col("values") - F.col("whole")) <= F.col("whole") * 0.01
    return out.select("column", "rows", "nulls", "low", "high", "inferred", F.col("exact").alias("values"), sketches.close(F.col("values"), F.col("exact")).alias("close"), same.alias("same"), "frequent")


ROLES = 36  #: roles of the widest star


@query("SELECT c_custkey, " + ", ".join(f"{d}{i}.{label} AS role_{i}" for i in range(ROLES) for d, label in [(("n", "n_name"), ("r", "r_name"), ("s", "s_name"))[i % 3]]) + " FROM customer " + " ".join(
    (f"LEFT JOIN nation n{i} ON n{i}.n_nationkey = (c_custkey + {i}) % 27", f"LEFT JOIN region r{i} ON r{i}.r_regionkey = (c_custkey + {i}) % 6", f"LEFT JOIN supplier s{i} ON s{i}.s_suppkey = (c_custkey + {i}) % 90")[i % 3] for i in range(ROLES)))
def wide_star(t, spark):
    """36 roles of three dimensions, looked up together; unknown codes stay null."""
    names = ("nation", "region", "supplier")
    facts = t("customer").select("c_custkey", *[((F.col("c_custkey") + i) % (27, 6, 90)[i % 3]).alias(f"code_{i}") for i in range(ROLES)])
    dims = {"nation": (t("nation"), "n_nationkey", "n_name"), "region": (t("region"), "r_regionkey", "r_name"), "supplier": (t("supplier"), "s_suppkey", "s_name")}
    out = lookup.star(facts, dims, {f"role_{i}": (f"code_{i}", names[i % 3]) for i in range(ROLES)})
    return out.select("c_custkey", *[f"role_{i}" for i in range(ROLES)])


@query("""
WITH k AS (SELECT DISTINCT p_brand || '/' || p_size AS key FROM part), s AS (SELECT 'seed' AS key UNION ALL SELECT * FROM k)
SELECT key, true AS stays, true AS own FROM s""")
def stable_ids(t, spark):
    """Ids of a catalogue entered in parts, and again in another order: each key keeps the id it had."""
    path = landing(spark)
    keys = t("part").select(F.concat_ws("/", "p_brand", "p_size").alias("key"), "p_size")
    first = registry.catalogue(spark, path, ["seed"], keys.filter("p_size > 25"), "key").withColumnRenamed("id", "was")
    for part in ("p_size <= 10", "p_size > 5", "p_size <= 50"):
        registry.enter(keys.filter(part), path, "key")
    now = registry.entries(spark, path)
    n, ids = now.count(), now.select("id").distinct().count()
    out = now.join(first, "key", "left")
    return out.select("key", (F.col("was").isNull() | (F.col("was") == F.col("id"))).alias("stays"), (F.lit(n == ids) & ((F.col("id") - 1) % registry.SHARDS == F.col("shard"))).alias("own"))
