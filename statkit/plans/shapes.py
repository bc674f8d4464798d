"""Reshaping, set operations, ordered operators and cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from statkit.functions.codes import utm_to_degrees
from statkit.operators import cells, ranking, reshape
from statkit.plans.registry import query

MONTH_COLUMNS = {f"m{i:02d}": i for i in range(1, 13)}


def _wide(t):
    month = F.month("l_shipdate")
    return t("lineitem").groupBy(F.col("l_suppkey").alias("supplier"), F.year("l_shipdate").alias("year")).agg(*[F.count_if(month == i).alias(c) for c, i in MONTH_COLUMNS.items()])


@query("""SELECT l_suppkey AS supplier, year(l_shipdate)::INTEGER AS year, month(l_shipdate)::INTEGER AS month, count(*) AS n FROM lineitem GROUP BY 1, 2, 3""")
def month_unpivot(t, spark):
    """Twelve month columns to rows, zeros dropped."""
    return reshape.unpivot_months(_wide(t), ["supplier", "year"], MONTH_COLUMNS)


@query("""
WITH g AS (SELECT l_returnflag AS flag, l_linestatus AS status, sum(l_quantity) AS q, round(sum(l_extendedprice), 2) AS x, round(sum(l_tax), 4) AS y FROM lineitem GROUP BY 1, 2)
SELECT flag, status, 1 AS measure, q AS value FROM g UNION ALL SELECT flag, status, 2, x FROM g UNION ALL SELECT flag, status, 7, y FROM g""")
def melt_measures(t, spark):
    """R2: measures to rows by id."""
    g = t("lineitem").groupBy(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status")).agg(F.sum("l_quantity").alias("q"), F.round(F.sum("l_extendedprice"), 2).alias("x"), F.round(F.sum("l_tax"), 4).alias("y"))
    return reshape.melt(g, ["flag", "status"], {"q": 1, "x": 2, "y": 7})


@query("""
WITH y AS (SELECT unnest([1996, 1997, 1998])::INTEGER AS year), s AS (SELECT DISTINCT l_suppkey FROM lineitem)
SELECT s.l_suppkey AS supplier, y.year, count(l.l_orderkey) AS lines, coalesce(sum(l_quantity), 0) AS quantity FROM s CROSS JOIN y
LEFT JOIN lineitem l ON l.l_suppkey = s.l_suppkey AND year(l_shipdate) = y.year GROUP BY 1, 2""")
def wide_to_tidy(t, spark):
    """{measure}_{year} columns to a row per year."""
    years, year = (1996, 1997, 1998), F.year("l_shipdate")
    wide = t("lineitem").groupBy(F.col("l_suppkey").alias("supplier")).agg(
        *[F.count_if(year == y).alias(f"lines_{y}") for y in years],
        *[F.sum(F.when(year == y, F.col("l_quantity")).otherwise(0)).alias(f"quantity_{y}") for y in years],
    )
    return reshape.tidy_years(wide, ["supplier"], ["lines", "quantity"], years)


@query("""SELECT o_custkey, min(o_totalprice) FILTER (o_orderstatus = 'F') AS "F", min(o_totalprice) FILTER (o_orderstatus = 'O') AS "O", min(o_totalprice) FILTER (o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1""")
def pivot_first(t, spark):
    """A column per value."""
    return reshape.pivot_first(t("orders"), ["o_custkey"], "o_orderstatus", ["F", "O", "P"], "o_totalprice")


@query("""SELECT CASE WHEN p_size <= 10 THEN 'national' WHEN p_size <= 30 THEN 'state' ELSE 'local' END AS level, count(*) AS n, sum(p_size)::BIGINT AS size FROM part GROUP BY 1""")
def level_split_union(t, spark):
    """Rows proven to be of one level each, split and united."""
    size = F.col("p_size")
    tagged = reshape.split_levels(t("part"), {"national": size <= 10, "state": (size > 10) & (size <= 30), "local": size > 30})
    one = lambda level: tagged.filter(F.col("level") == level)
    all_levels = one("national").unionByName(one("state")).unionByName(one("local"))
    return all_levels.groupBy("level").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("p_size").cast("bigint")).alias("size"))


OUTLINE = """
WITH o AS (
  SELECT p_type AS sector, row_number() OVER (PARTITION BY p_type ORDER BY p_brand, p_partkey) AS i, p_partkey, p_brand, p_name FROM part),
r AS (SELECT sector, i, CASE WHEN i = 1 OR p_brand <> lag(p_brand) OVER (PARTITION BY sector ORDER BY i) THEN 1 ELSE 2 END AS level, p_partkey::VARCHAR AS code, p_name AS label FROM o)
SELECT sector, i, level::INTEGER AS level, code, label, CASE WHEN level = 2 THEN last_value(CASE WHEN level = 1 THEN code END IGNORE NULLS) OVER (PARTITION BY sector ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS parent FROM r"""


@query(OUTLINE)
def outline_to_hierarchy(t, spark):
    """An outline by indentation; each row's parent is the last code a level up."""
    from pyspark.sql import Window

    order = Window.partitionBy("p_type").orderBy("p_brand", "p_partkey")
    rows = t("part").withColumn("i", F.row_number().over(order).cast("bigint")).withColumn("head", (F.col("i") == 1) | (F.col("p_brand") != F.lag("p_brand").over(order)))
    code = F.col("p_partkey").cast("string")
    cells_ = rows.select(F.col("p_type").alias("sector"), "i", F.when(F.col("head"), code).alias("c1"), F.when(F.col("head"), F.col("p_name")).otherwise(code).alias("c2"), F.when(~F.col("head"), F.col("p_name")).alias("c3"))
    return reshape.outline(cells_, ["c1", "c2", "c3"], "i", ["sector"])


@query("""
WITH l AS (SELECT p_partkey, unnest(string_split(p_size || ' ,x, ' || (p_size + 1) || ',' || p_size, ',')) AS item FROM part)
SELECT DISTINCT p_partkey, trim(item)::INTEGER AS item FROM l WHERE try_cast(trim(item) AS INTEGER) IS NOT NULL""")
def list_explode_bridge(t, spark):
    """A delimited list to distinct bridge rows; items that are no numbers go."""
    size = F.col("p_size")
    lists = t("part").select("p_partkey", F.concat(size, F.lit(" ,x, "), size + 1, F.lit(","), size).alias("list"))
    return reshape.list_bridge(lists, "p_partkey", "list", "item")


@query("""SELECT p_partkey, unnest(generate_series(p_size, p_size + CASE WHEN p_size % 5 = 0 THEN 0 ELSE 2 END))::INTEGER AS number FROM part""")
def range_expand(t, spark):
    """R9: "2 - 4" to rows 2, 3 and 4."""
    size = F.col("p_size")
    text = F.when(size % 5 == 0, size.cast("string")).otherwise(F.concat(size, F.lit(" - "), size + 2))
    return reshape.expand_ranges(t("part").select("p_partkey", text.alias("range")), "range", "number").select("p_partkey", "number")


@query("""
WITH e AS (SELECT user_id, event_id, ts, CASE WHEN value > 50 THEN event_type END AS kind FROM events)
SELECT user_id, event_id, last_value(kind IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS kind FROM e""")
def forward_fill(t, spark):
    """Gaps take the last value before them."""
    rows = t("events").select("user_id", "event_id", "ts", F.when(F.col("value") > 50, F.col("event_type")).alias("kind"))
    return ranking.fill_forward(rows, ["user_id"], ["ts", "event_id"], ["kind"]).drop("ts")


@query("SELECT event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id)::INTEGER AS n FROM events")
def running_counter(t, spark):
    """A running number in each group."""
    return ranking.counter(t("events"), ["user_id", "event_type"], ["ts", "event_id"]).select("event_id", "n")


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id FROM orders")
def surrogate_numbers(t, spark):
    """Consecutive ids by a total order, numbered in parallel."""
    return ranking.numbered(t("orders"), ["o_orderdate", "o_orderkey"]).select("o_orderkey", "id")


@query("""SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 25""")
def top_rows(t, spark):
    """O1, O3: the first rows of an order with nulls last."""
    return t("orders").select("o_orderkey", "o_totalprice").orderBy(F.desc_nulls_last("o_totalprice"), "o_orderkey").limit(25)


@query("""
WITH u AS (SELECT p_brand AS value, 2 AS p FROM part UNION ALL SELECT 'Brand#1', 1 UNION ALL SELECT 'Brand#99', 1),
d AS (SELECT value, min(p) AS p FROM u GROUP BY 1)
SELECT row_number() OVER (ORDER BY p, CASE WHEN value = 'Brand#99' THEN 0 ELSE 1 END, value)::INTEGER AS id, value FROM d""")
def seed_catalogue(t, spark):
    """Seeded values keep their ids, observed ones follow."""
    from statkit.operators.loads import seeded_catalogue

    return seeded_catalogue(["Brand#99", "Brand#1"], t("part"), "p_brand")


BOXES = """
WITH a AS (SELECT p_partkey AS a, (p_partkey % 40) * 3 AS x0, (p_partkey // 40) * 3 AS y0, 2 + p_size % 7 AS w, 1 + p_size % 5 AS h FROM part),
b AS (SELECT s_suppkey AS b, (s_suppkey % 10) * 12 AS x0, (s_suppkey // 10) * 12 AS y0, 12 AS w, 12 AS h FROM supplier)
"""


def _boxes(t):
    k, s = F.col("p_partkey"), F.col("p_size")
    x, y = (k % 40) * 3, F.floor(k / 40) * 3
    a = t("part").select(k.alias("a"), "p_brand", x.alias("x0"), y.alias("y0"), (x + 2 + s % 7).alias("x1"), (y + 1 + s % 5).alias("y1"))
    k = F.col("s_suppkey")
    x, y = (k % 10) * 12, F.floor(k / 10) * 12
    return a, t("supplier").select(k.alias("b"), x.alias("x0"), y.alias("y0"), (x + 12).alias("x1"), (y + 12).alias("y1"))


def _layers(t):
    a, b = _boxes(t)
    box = ("x0", "y0", "x1", "y1")
    return cells.cover(a, ["a"], *box), cells.cover(b, ["b"], *box)


@query(BOXES + """
, j AS (SELECT a, b, (least(a.x0 + a.w, b.x0 + b.w) - greatest(a.x0, b.x0)) * (least(a.y0 + a.h, b.y0 + b.h) - greatest(a.y0, b.y0)) AS area, a.w * a.h AS sa, b.w * b.h AS sb
  FROM a JOIN b ON a.x0 < b.x0 + b.w AND b.x0 < a.x0 + a.w AND a.y0 < b.y0 + b.h AND b.y0 < a.y0 + a.h)
SELECT a, b, area::DOUBLE AS area, round(area * 100.0::DOUBLE / sa, 6) AS share_a, round(area * 100.0::DOUBLE / sb, 6) AS share_b FROM j""")
def cell_overlay(t, spark):
    """Areas of intersections and their shares, by joins on cells."""
    return cells.overlay(*_layers(t), "a", "b")


@query("""
WITH p AS (SELECT DISTINCT p_brand, (p_partkey % 40) * 3 + x AS cx, (p_partkey // 40) * 3 + y AS cy FROM part, range(9) r(x), range(6) s(y) WHERE x < 2 + p_size % 7 AND y < 1 + p_size % 5)
SELECT p_brand, count(*)::DOUBLE AS area FROM p GROUP BY 1""")
def cell_dissolve(t, spark):
    """Area of each key's union."""
    a, _ = _boxes(t)
    return cells.dissolve(cells.cover(a, ["p_brand"], "x0", "y0", "x1", "y1"), "p_brand")


@query(BOXES + """
, c AS (SELECT a, x0 + x AS cx, y0 + y AS cy FROM a, range(9) r(x), range(6) s(y) WHERE x < w AND y < h),
d AS (SELECT DISTINCT x0 + x AS cx, y0 + y AS cy FROM b, range(12) r(x), range(12) s(y)),
l AS (SELECT cx, cy, count(DISTINCT a) AS n FROM c GROUP BY ALL)
SELECT (SELECT count(*) FROM l WHERE n > 1) AS overlaps, (SELECT count(*)::DOUBLE FROM l SEMI JOIN d ON l.cx = d.cx AND l.cy = d.cy) AS both_area,
  (SELECT count(*)::DOUBLE FROM l ANTI JOIN d ON l.cx = d.cx AND l.cy = d.cy) AS left_only, (SELECT count(*)::DOUBLE FROM d ANTI JOIN l ON l.cx = d.cx AND l.cy = d.cy) AS right_only""")
def overlap_check(t, spark):
    """Masks of two layers, and cells that several keys claim."""
    a, b = _layers(t)
    return cells.masks(a, b).crossJoin(cells.self_overlaps(a, "a")).select(F.col("cells").alias("overlaps"), "both_area", "left_only", "right_only")


@query("""
WITH k AS (SELECT 6378137.0::DOUBLE AS a, 1 / 298.257222101::DOUBLE AS f, 0.9996::DOUBLE AS k0), m AS (SELECT *, f / (2 - f) AS n FROM k),
r AS (SELECT *, a / (1 + n) * (1 + n ** 2 / 4 + n ** 4 / 64) * k0 AS big FROM m),
x AS (SELECT c_custkey, (2200000.0::DOUBLE + c_custkey % 1000 * 150) / big AS xi, c_acctbal * 20 / big AS eta, n,
  n / 2 - 2 * n ** 2 / 3 + 37 * n ** 3 / 96 AS b1, n ** 2 / 48 + n ** 3 / 15 AS b2, 17 * n ** 3 / 480 AS b3 FROM customer, r),
y AS (SELECT *, xi - b1 * sin(2 * xi) * cosh(2 * eta) - b2 * sin(4 * xi) * cosh(4 * eta) - b3 * sin(6 * xi) * cosh(6 * eta) AS xi1,
  eta - b1 * cos(2 * xi) * sinh(2 * eta) - b2 * cos(4 * xi) * sinh(4 * eta) - b3 * cos(6 * xi) * sinh(6 * eta) AS eta1 FROM x),
z AS (SELECT *, asin(sin(xi1) / cosh(eta1)) AS chi FROM y),
d AS (SELECT c_custkey, round(degrees(radians(-105.0::DOUBLE) + atan2(sinh(eta1), cos(xi1))), 6) AS lon,
  round(degrees(chi + (2 * n - 2 * n ** 2 / 3 - 2 * n ** 3) * sin(2 * chi) + (7 * n ** 2 / 3 - 8 * n ** 3 / 5) * sin(4 * chi) + 56 * n ** 3 / 15 * sin(6 * chi)), 6) AS lat FROM z)
SELECT c_custkey, lon, lat, lon BETWEEN -106 AND -103 AND lat BETWEEN 19 AND 21 AS inside FROM d""")
def utm_project(t, spark):
    """Projected coordinates to degrees, and which points lie inside an envelope."""
    k = F.col("c_custkey")
    raw = t("customer").select("c_custkey", (F.lit(500000.0) + F.col("c_acctbal") * 20).alias("x"), (F.lit(2200000.0) + k % 1000 * 150).alias("y"))
    lon, lat = utm_to_degrees(F.col("x"), F.col("y"))
    out = raw.select("c_custkey", F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"))
    return out.withColumn("inside", cells.point(F.col("lon"), F.col("lat"), -106.0, 19.0, -103.0, 21.0).isNotNull())


@query("""
WITH s AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) WHEN p_partkey % 3 = 1 THEN replace(p_name, ' ', '  ') ELSE p_name END AS name FROM part)
SELECT name FROM (SELECT name, row_number() OVER (PARTITION BY lower(replace(name, '  ', ' ')) ORDER BY p_partkey) AS r FROM s) WHERE r = 1""")
def dedup_first_spelling(t, spark):
    """One spelling of each normalised name, the first one seen."""
    from statkit.functions.text import match_key

    k, name = F.col("p_partkey"), F.col("p_name")
    spelt = t("part").select(k, F.when(k % 3 == 0, F.upper(name)).when(k % 3 == 1, F.replace(name, F.lit(" "), F.lit("  "))).otherwise(name).alias("name"))
    return ranking.keep_one(spelt, [match_key(F.col("name"))], [F.asc("p_partkey")]).select("name")


@query("""
WITH u AS (
  SELECT o_custkey AS customer, o_orderpriority AS label, year(o_orderdate)::INTEGER AS edition, NULL::DOUBLE AS price FROM orders WHERE year(o_orderdate) < 1998
  UNION ALL SELECT o_custkey, o_orderpriority, year(o_orderdate), o_totalprice FROM orders WHERE year(o_orderdate) >= 1998)
SELECT customer, label, edition, price FROM (SELECT *, row_number() OVER (PARTITION BY customer ORDER BY edition DESC, label, price NULLS LAST) AS r FROM u) WHERE r = 1""")
def edition_union(t, spark):
    """An old and a new layout united by name, the latest edition of each key kept."""
    from statkit.sources.files import union_all

    rows = t("orders").select(F.col("o_custkey").alias("customer"), F.col("o_orderpriority").alias("label"), F.year("o_orderdate").alias("edition"), F.col("o_totalprice").alias("price"))
    both = union_all(rows.filter("edition < 1998").drop("price"), rows.filter("edition >= 1998"))
    return ranking.keep_one(both, ["customer"], [F.desc("edition"), F.asc("label"), F.asc_nulls_last("price")]).select("customer", "label", "edition", "price")


@query("""
WITH p AS (SELECT c_nationkey::VARCHAR AS unit, count(*) AS n FROM customer GROUP BY 1 UNION ALL SELECT '00', count(*) FROM customer UNION ALL SELECT '9999', 0)
SELECT unit, n, (SELECT min(unit) FROM p WHERE unit NOT IN ('00', '9999')) AS first_unit FROM p WHERE unit NOT IN ('00', '9999') AND n IS NOT NULL""")
def drop_aggregate_rows(t, spark):
    """Totals and sentinel units shipped inside the data are dropped; a constant taken as a minimum."""
    units = t("customer").groupBy(F.col("c_nationkey").cast("string").alias("unit")).agg(F.count(F.lit(1)).alias("n"))
    shipped = units.unionByName(t("customer").agg(F.lit("00").alias("unit"), F.count(F.lit(1)).alias("n")))
    clean = shipped.filter(~F.col("unit").isin("00", "9999")).dropna(subset=["n"])
    return clean.crossJoin(F.broadcast(clean.agg(F.min("unit").alias("first_unit"))))  # one row
