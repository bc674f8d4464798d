"""The available-now stream processes each landed file once and replaces whole editions."""

from pyspark.sql import types as T

from statkit.streaming.editions import ingest_editions


def test_only_new_files_and_whole_editions(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("landed", "table", "state"))
    schema = T.StructType([T.StructField("v", T.LongType()), T.StructField("edition", T.IntegerType())])
    land = lambda *r: spark.createDataFrame(list(r), schema).coalesce(1).write.mode("append").parquet(source)
    land((1, 2020), (2, 2021))
    assert ingest_editions(spark, source, schema, target, state, ["edition"]) == 1
    assert ingest_editions(spark, source, schema, target, state, ["edition"]) == 0
    land((3, 2021))
    assert ingest_editions(spark, source, schema, target, state, ["edition"]) == 1
    assert sorted(map(tuple, spark.read.parquet(target).select("v", "edition").collect())) == [(1, 2020), (3, 2021)]


def test_an_edition_of_very_many_files_stays_whole(spark, tmp_path):
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", "4")
    source, target, state = (str(tmp_path / n) for n in ("landed", "table", "state"))
    schema = T.StructType([T.StructField("v", T.LongType()), T.StructField("edition", T.LongType())])
    spark.range(1100).selectExpr("id AS v", "id % 2 AS edition").coalesce(1).write.option("maxRecordsPerFile", 1).json(source)
    assert len(list((tmp_path / "landed").glob("part-*"))) > 1000
    ingest_editions(spark, source, schema, target, state, ["edition"], format="json")
    assert spark.read.parquet(target).count() == 1100
    spark.conf.unset("spark.sql.sources.parallelPartitionDiscovery.parallelism")
