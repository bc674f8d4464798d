"""Cleaning and scalar functions. Odd values are put into the tables' columns, alike in the SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from statkit.functions import codes, periods, text
from statkit.plans.registry import query


@query("""
WITH d AS (SELECT p_partkey, CASE WHEN p_size < 10 THEN ' "' || p_name || '"  ' WHEN p_size < 20 THEN ' N/a ' WHEN p_size < 25 THEN '' ELSE replace(p_name, ' ', '   ') END AS raw FROM part)
SELECT p_partkey, CASE WHEN lower(trim(raw)) IN ('n/a', '') THEN NULL ELSE trim(trim(regexp_replace(trim(raw), '\\s+', ' ', 'g'), '"')) END AS clean FROM d""")
def clean_tokens(t, spark):
    """Quotes and white space cleaned, null tokens to null."""
    size, name = F.col("p_size"), F.col("p_name")
    raw = F.when(size < 10, F.concat(F.lit(' "'), name, F.lit('"  '))).when(size < 20, " N/a ").when(size < 25, "").otherwise(F.replace(name, F.lit(" "), F.lit("   ")))
    return t("part").select("p_partkey", text.null_tokens(raw).alias("clean"))


@query("""
WITH d AS (SELECT event_id, CASE WHEN value < 20 THEN floor(value)::BIGINT || '.0' WHEN value < 40 THEN 'x' || user_id WHEN value < 50 THEN '12.5%' ELSE floor(value)::BIGINT::VARCHAR END AS raw, json_extract_string(props, '$.k') AS k FROM events)
SELECT event_id, try_cast(try_cast(raw AS DOUBLE) AS BIGINT) AS whole, coalesce(try_cast(try_cast(raw AS DOUBLE) AS BIGINT), 0) AS zero,
  try_cast(replace(raw, '%', '') AS DOUBLE) AS percent, CASE WHEN k::INTEGER NOT IN (0, 99) THEN k::INTEGER END AS k FROM d""")
def coerce_numbers(t, spark):
    """Numbers from text, sentinels to null."""
    v = F.col("value")
    whole = F.floor(v).cast("string")
    raw = F.when(v < 20, F.concat(whole, F.lit(".0"))).when(v < 40, F.concat(F.lit("x"), "user_id")).when(v < 50, "12.5%").otherwise(whole)
    d = t("events").select("event_id", raw.alias("raw"), F.get_json_object("props", "$.k").cast("int").alias("k"))
    return d.select("event_id", codes.to_int(F.col("raw")).alias("whole"), codes.or_zero(F.col("raw")).alias("zero"), text.percent(F.col("raw")).alias("percent"), codes.unless(F.col("k"), 0, 99).alias("k"))


@query("""SELECT p_partkey, upper(left(p_name, 1)) || lower(substr(p_name, 2)) AS sentence, lower(p_type) AS low, upper(p_name) AS up FROM part""")
def case_functions(t, spark):
    """Case functions."""
    return t("part").select("p_partkey", text.capitalised(F.col("p_name")).alias("sentence"), F.lower("p_type").alias("low"), F.upper("p_name").alias("up"))


@query("""SELECT doc_id, lower(strip_accents(text)) AS folded FROM documents""")
def accent_fold(t, spark):
    """Accents folded over whole texts."""
    return t("documents").select("doc_id", F.lower(text.accent_fold(F.col("text"))).alias("folded"))


@query("""
WITH w AS (SELECT p_partkey, string_split(p_name || ' de la ' || p_type, ' ') AS ws FROM part)
SELECT p_partkey, array_to_string(list_transform(ws, lambda w, i: CASE WHEN lower(w) = 'promo' THEN 'PROMO' WHEN i > 1 AND lower(w) IN ('de', 'la') THEN lower(w) ELSE upper(left(w, 1)) || lower(substr(w, 2)) END), ' ') AS title FROM w""")
def title_particles(t, spark):
    """Titles with particles and canonical tokens."""
    name = F.concat_ws(" de la ", "p_name", "p_type")
    return t("part").select("p_partkey", text.title_with_particles(name, ["de", "la"], {"promo": "PROMO"}).alias("title"))


@query("""
SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 'Región de México' ELSE 'la población ' || n_name END AS label, 'SA de CV ' || CASE WHEN n_nationkey % 3 = 0 THEN 'IMSS' ELSE 'TV' END AS firm FROM nation""")
def restored_spelling(t, spark):
    """Accents restored by a map of words, acronyms upper-cased."""
    k = F.col("n_nationkey")
    raw = F.when(k % 2 == 0, "Region de Mexico").otherwise(F.concat(F.lit("la poblacion "), "n_name"))
    firm = F.concat(F.lit("sa de cv "), F.when(k % 3 == 0, "imss").otherwise("tv"))
    return t("nation").select("n_nationkey", text.restore_accents(raw, {"region": "región", "mexico": "méxico", "poblacion": "población"}).alias("label"), text.restore_acronyms(firm, ["SA", "IMSS"]).alias("firm"))


@query("""
WITH d AS (SELECT event_id, CASE WHEN value < 30 THEN 9999 ELSE year(ts) END::INTEGER AS y, CASE WHEN value > 90 THEN 99 ELSE month(ts) + (event_id % 2) END::INTEGER AS m, (day(ts) + event_id % 5)::INTEGER AS d FROM events)
SELECT event_id, CASE WHEN y <> 9999 THEN y END AS year, CASE WHEN m <> 99 THEN m END AS month, CASE WHEN d <> 99 THEN d END AS day,
  CASE WHEN y <> 9999 AND m <> 99 THEN try_cast(printf('%04d-%02d-%02d', y, m, d) AS DATE) END AS date FROM d""")
def date_parts(t, spark):
    """Dates of parts; sentinels null their part, impossible dates are null."""
    v, i = F.col("value"), F.col("event_id")
    d = t("events").select("event_id", F.when(v < 30, 9999).otherwise(F.year("ts")).alias("y"), F.when(v > 90, 99).otherwise(F.month("ts") + i % 2).cast("int").alias("m"), (F.dayofmonth("ts") + i % 5).cast("int").alias("d"))
    return d.select("event_id", *[c.alias(n) for n, c in periods.date_of_parts(F.col("y"), F.col("m"), F.col("d")).items()])


@query("""
WITH d AS (SELECT event_id, (user_id % 30)::INTEGER AS h, (event_id % 65)::INTEGER AS m FROM events)
SELECT event_id, CASE WHEN h < 24 AND m < 60 THEN printf('%02d:%02d', h, m) END AS clock, CASE WHEN m < 60 THEN h * 60 + m END AS minutes, m // 10 AS unit, CASE WHEN m % 10 <> 9 THEN m % 10 END AS amount FROM d""")
def time_parts(t, spark):
    """Clock times, durations and packed codes."""
    d = t("events").select("event_id", (F.col("user_id") % 30).cast("int").alias("h"), (F.col("event_id") % 65).cast("int").alias("m"))
    unit, amount = codes.packed(F.col("m"), 10, 9)
    return d.select("event_id", periods.clock(F.col("h"), F.col("m")).alias("clock"), periods.minutes(F.format_string("%d:%02d", "h", "m")).alias("minutes"), unit.alias("unit"), amount.alias("amount"))


@query("""
SELECT o_orderkey, date_trunc('month', o_orderdate)::DATE AS month, date_trunc('quarter', o_orderdate)::DATE AS quarter, last_day(o_orderdate::DATE) AS month_end,
  CASE o_orderkey % 5 WHEN 0 THEN date_trunc('year', o_orderdate)::DATE WHEN 1 THEN date_trunc('month', o_orderdate)::DATE WHEN 4 THEN NULL ELSE o_orderdate::DATE END AS parsed FROM orders""")
def period_builders(t, spark):
    """Periods from numbers and from partial dates in text."""
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 5
    raw = F.when(k == 0, F.date_format(d, "yyyy")).when(k == 1, F.date_format(d, "MM/yyyy")).when(k == 2, F.date_format(d, "dd/MM/yyyy")).when(k == 3, F.lower(F.date_format(d, "d-MMM-yyyy"))).otherwise("13/13/2000")
    return t("orders").select(
        "o_orderkey", periods.month_start(F.date_format(d, "yyyy"), F.month(d)).alias("month"), periods.quarter_start(F.year(d), F.quarter(d)).alias("quarter"),
        F.last_day(d).alias("month_end"), periods.partial_date(raw).alias("parsed"),
    )


@query("""SELECT dayname(ts) AS day, CASE WHEN hour(ts) < 6 THEN 'night' WHEN hour(ts) < 12 THEN 'morning' WHEN hour(ts) < 18 THEN 'afternoon' ELSE 'evening' END AS band, count(*) AS n FROM events GROUP BY 1, 2""")
def weekday_hour_band(t, spark):
    """Weekdays and hour bands."""
    return t("events").groupBy(periods.weekday(F.col("ts")).alias("day"), periods.hour_band(F.hour("ts")).alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 'offer' WHEN p_type = 'ECONOMY' THEN 'basic' ELSE 'other' END AS relabelled,
  CASE WHEN contains(p_name, 'widget') THEN 3 WHEN contains(p_name, 'cold') THEN 2 WHEN contains(p_name, 'd') THEN 1 END AS class, CASE WHEN regexp_matches(p_type, '^STAND') THEN 'not specified' ELSE p_type END AS label FROM part""")
def relabel_comparable(t, spark):
    """Relabelling, the last matching substring, canonical labels."""
    return t("part").select(
        "p_partkey", text.mapped(F.col("p_type"), {"PROMO": "offer", "ECONOMY": "basic"}, F.lit("other")).alias("relabelled"),
        text.last_matching(F.col("p_name"), [("d", 1), ("cold", 2), ("widget", 3)]).alias("class"), text.canonical_label(F.col("p_type"), [("(?i)^stand", "not specified")]).alias("label"),
    )


@query("""
SELECT c_custkey, sha256(c_custkey || '|' || coalesce(CASE WHEN c_acctbal > 0 THEN c_mktsegment END, '') || '|' || c_nationkey) AS hash,
  lpad(((c_nationkey + 1) * 1000 + c_custkey % 1000)::VARCHAR, 5, '0') AS area, CASE WHEN ltrim(c_nationkey::VARCHAR, '0') = '' THEN '0' ELSE ltrim(c_nationkey::VARCHAR, '0') END AS key, coalesce(CASE WHEN c_acctbal > 0 THEN c_mktsegment END = 'BUILDING', false) AS building FROM customer""")
def row_hash(t, spark):
    """Row hashes, composite keys and flags that are never null."""
    segment = F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment"))
    return t("customer").select(
        "c_custkey", codes.row_hash(F.col("c_custkey"), segment, F.col("c_nationkey")).alias("hash"), codes.area_key(F.col("c_nationkey") + 1, F.col("c_custkey") % 1000).alias("area"),
        codes.text_key(F.concat(F.lit("00"), F.col("c_nationkey").cast("string"))).alias("key"), codes.flag(segment == "BUILDING").alias("building"),
    )


@query("""
SELECT event_id, CASE event_id % 4 WHEN 0 THEN true WHEN 1 THEN false END AS answer, CASE WHEN user_id % 12 IN (0, 1, 2, 8, 9) THEN (user_id % 12)::INTEGER END AS code, CASE WHEN user_id <= 32 THEN user_id END AS state, CASE WHEN user_id > 32 THEN user_id END AS country,
  CASE event_id % 3 WHEN 0 THEN NULL WHEN 1 THEN user_id::VARCHAR ELSE '12-B' END AS house FROM events""")
def coded_answers(t, spark):
    """yes/no text, five-valued domains, split domains, house numbers."""
    i, u = F.col("event_id"), F.col("user_id")
    state, country = codes.split_domain(u, 32)
    answer = F.when(i % 4 == 0, " sí ").when(i % 4 == 1, "NO").when(i % 4 == 2, "?")
    house = F.when(i % 3 == 0, "S/N").when(i % 3 == 1, F.concat(u.cast("string"), F.lit(".0"))).otherwise(" 12-B")
    return t("events").select("event_id", text.yes_no(answer).alias("answer"), codes.domain((u % 12).cast("string"), (0, 1, 2, 8, 9)).alias("code"), state.alias("state"), country.alias("country"), text.number_text(house).alias("house"))


@query("""
SELECT s_suppkey, round(s_acctbal::DECIMAL(18, 4), 1)::DOUBLE AS rounded, CASE WHEN length(s_name) = 18 THEN s_name END AS name, nullif(s_nationkey, 0) AS nation, CASE WHEN s_acctbal BETWEEN 0 AND 9000 THEN s_acctbal END AS inside,
  split_part(s_name, '#', 2) AS number, left(s_name, 4) AS start FROM supplier""")
def validity_and_rounding(t, spark):
    """Validity by length and range, rounding of decimals, null scalars and parts of text."""
    bal = F.col("s_acctbal")
    return t("supplier").select(
        "s_suppkey", F.round(bal.cast("decimal(18,4)"), 1).cast("double").alias("rounded"), codes.of_length(F.col("s_name"), 18).alias("name"), F.nullif("s_nationkey", F.lit(0)).alias("nation"),
        codes.within(bal, 0, 9000).alias("inside"), F.split_part("s_name", F.lit("#"), F.lit(2)).alias("number"), F.left("s_name", F.lit(4)).alias("start"),
    )
