"""Scans of landed files: each query lands files that Spark derives from the tables, in the shared folder, and reads them."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from statkit.operators import loads
from statkit.operators.shared import shared_folder
from statkit.plans.registry import query
from statkit.sources import editions, files
from statkit.streaming.editions import ingest_editions

FILE_LINES = 100_000  #: expected lines of a landed file


def landing(spark) -> str:
    """A new folder below the shared one."""
    return f"{shared_folder(spark)}/landing-{uuid.uuid4().hex}"


@query("""SELECT c_custkey, c_mktsegment AS segment, c_acctbal AS balance FROM customer""")
def delimited_scan(t, spark):
    """Bar-separated text, every column a string, then the modelled types; unknown columns dropped."""
    path = landing(spark)
    t("customer").select("c_custkey", F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"), F.lit("x").alias("unknown")).write.options(sep="|", header=True).csv(path)
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("segment", T.StringType()), T.StructField("balance", T.DoubleType())])
    return files.reconciled(files.delimited(spark, path, sep="|"), schema)[0]


@query("""SELECT lang, count(*) AS lines, sum(length(line))::BIGINT AS chars FROM (SELECT lang, regexp_replace(replace(text, chr(10), ' '), '[^ -~\\x{A1}-\\x{FF}]', '?', 'g') AS line FROM documents) GROUP BY 1""")
def encoding_scan(t, spark):
    """Files in UTF-8 and in Latin-1, decoded by a validity test."""
    line = F.regexp_replace(F.replace("text", F.lit("\n"), F.lit(" ")), "[^ -~\\x{A1}-\\x{FF}]", "?")
    mark = F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-"))  # a null lang is a mark of its own
    docs = t("documents").select(F.coalesce(F.col("lang").isin("de", "fr"), F.lit(False)).alias("latin"), F.concat_ws("\t", mark, line).alias("value"))
    path = landing(spark)
    docs.filter("latin").select("value").write.options(encoding="ISO-8859-1", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{path}/latin", sep="\x01", quote="")
    docs.filter("NOT latin").select("value").write.text(f"{path}/utf")
    lines = files.decoded_lines(spark, f"{path}/*/part-*").filter("line <> ''")
    parts = F.split("line", "\t", 2)
    return lines.select(F.when(parts[0] != "-", F.substring(parts[0], 2, 2**31 - 1)).alias("lang"), F.get(parts, 1).alias("line")).groupBy("lang").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.length("line").cast("bigint")).alias("chars"))


@query("""SELECT p_partkey, p_brand AS brand, CASE WHEN p_size % 3 = 1 THEN NULL WHEN p_size % 3 = 2 THEN p_type || ',' || p_size ELSE p_type END AS label FROM part""")
def ragged_csv(t, spark):
    """A header found below a preamble; surplus fields rejoined, short lines padded."""
    path, size = landing(spark), F.col("p_size")
    line = F.when(size % 3 == 1, F.concat_ws(",", "p_partkey", "p_brand")).when(size % 3 == 2, F.concat_ws(",", "p_partkey", "p_brand", "p_type", "p_size")).otherwise(F.concat_ws(",", "p_partkey", "p_brand", "p_type"))
    lines = t("part").select(line.alias("value"), F.xxhash64(F.monotonically_increasing_id()).alias("salt"))
    n = max(4, -(-lines.count() // FILE_LINES))  # each file holds about FILE_LINES lines, whatever the brands' sizes
    lines = lines.select("value", F.pmod("salt", F.lit(n)).alias("file"), F.lit(2).alias("place"))
    heads = spark.range(n).select(F.inline(F.array(F.struct(F.lit("Statistics office").alias("value"), F.col("id").alias("file"), F.lit(0).alias("place")), F.struct(F.lit("Code,Brand,Label").alias("value"), F.col("id").alias("file"), F.lit(1).alias("place")))))
    lines.unionByName(heads).repartition(n, "file").sortWithinPartitions("file", "place").select("file", "value").write.partitionBy("file").text(path)
    rows = files.below_header(files.decoded_lines(spark, f"{path}/file=*/part-*"), ["code"])
    rows = rows.filter(~F.col("line").isin("", "Statistics office", "Code,Brand,Label")).select(files.repaired_fields(F.col("line"), 3).alias("f"))
    return rows.select(F.col("f")[0].cast("bigint").alias("p_partkey"), F.col("f")[1].alias("brand"), F.col("f")[2].alias("label"))


@query("""
WITH f AS (SELECT p_brand AS folder, 'd_' || (1990 + p_size) || '_trim' || (1 + p_partkey % 4) AS name, p_partkey AS modified FROM part)
SELECT folder, name, modified, regexp_extract(name, '([0-9]{4})_trim', 1)::INTEGER AS year, regexp_extract(name, 'trim([1-4])', 1)::INTEGER AS quarter
FROM (SELECT *, row_number() OVER (PARTITION BY folder ORDER BY modified DESC, name DESC) AS r FROM f) WHERE r = 1""")
def latest_file(t, spark):
    """The newest file of each folder, and the period that its name holds."""
    size = F.col("p_size")
    name = F.concat(F.lit("d_"), size + 1990, F.lit("_trim"), F.col("p_partkey") % 4 + 1)
    last = editions.latest(t("part").select(F.col("p_brand").alias("folder"), name.alias("name"), F.col("p_partkey").alias("modified")), ["folder"])
    period = files.name_period(F.col("name"))
    return last.select("folder", "name", "modified", period["year"].alias("year"), period["quarter"].alias("quarter"))


@query("""SELECT DISTINCT year(o_orderdate)::INTEGER AS year, quarter(o_orderdate)::INTEGER AS quarter FROM orders WHERE (year(o_orderdate), quarter(o_orderdate)) > (SELECT (year(max(o_orderdate)), quarter(max(o_orderdate))) FROM orders WHERE o_orderdate < TIMESTAMP '1999-02-01')""")
def pending_editions(t, spark):
    """Editions after the last one loaded."""
    rows = t("orders").select("o_orderdate", F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter"))
    loaded = rows.filter("o_orderdate < '1999-02-01'").select("year", "quarter")
    return editions.pending(rows.select("year", "quarter").distinct(), loaded, ["year", "quarter"], after_last=True)


@query("""SELECT day(ts)::INTEGER AS edition, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY 1""")
def incremental_stream(t, spark):
    """Editions that land in two rounds, each processed once by an available-now stream."""
    path = landing(spark)
    rows = t("events").select("event_id", "value", F.dayofmonth("ts").alias("edition"))
    for part in ("edition <= 15", "edition > 15"):
        rows.filter(part).write.mode("append").parquet(f"{path}/landed")
        ingest_editions(spark, f"{path}/landed", rows.schema, f"{path}/table", f"{path}/state", ["edition"])
    out = spark.read.parquet(f"{path}/table")
    return out.groupBy("edition").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("value"))


@query("""SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1""")
def published_mart(t, spark):
    """A mart published as a version, replaced by the next; readers get the last."""
    path = landing(spark)
    loads.publish(t("orders").filter("o_orderstatus = 'F'").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n")), path)
    loads.publish(t("orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n")), path)
    return loads.current(spark, path)


@query("""SELECT p_brand, string_agg(DISTINCT p_type || '=' || m, ',' ORDER BY p_type || '=' || m) AS entries FROM (SELECT p_brand, p_type, min(p_size) AS m FROM part GROUP BY 1, 2) GROUP BY 1""")
def grouped_lookup(t, spark):
    """A lookup file of (group, key, value) as one map per group."""
    rows = t("part").groupBy("p_brand", "p_type").agg(F.min("p_size").alias("m"))
    maps = files.grouped_lookup(rows, "p_brand", "p_type", "m")
    return maps.select("p_brand", F.array_join(F.array_sort(F.transform(F.map_entries("entries"), lambda e: F.concat_ws("=", e["key"], e["value"]))), ",").alias("entries"))
