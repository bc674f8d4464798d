"""Landed files stay bounded, and hold every row, whatever the tables' groups and nulls."""

import pytest
from pyspark.sql import functions as F

from statkit.plans import sourcing


def test_ragged_files_are_bounded_with_one_hot_brand(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sourcing, "FILE_LINES", 100, raising=False)
    monkeypatch.setattr(sourcing, "landing", lambda _: str(tmp_path / "landed"))
    part = spark.range(2000).select(F.col("id").alias("p_partkey"), F.lit("Brand#1").alias("p_brand"), F.lit("PROMO").alias("p_type"), (F.col("id") % 50).cast("int").alias("p_size"))
    rows = sourcing.ragged_csv(lambda name: part, spark).cache()
    assert rows.count() == 2000 and rows.filter("brand = 'Brand#1'").select("p_partkey").distinct().count() == 2000
    sizes = [sum(1 for _ in f.open()) for f in (tmp_path / "landed").rglob("part-*")]
    assert len(sizes) >= 20 and max(sizes) <= 250


def test_documents_without_lang_are_a_group(spark):
    docs = spark.createDataFrame([(None, "no lang"), (None, "ja"), ("de", "größer"), ("en", "one\ntwo"), ("-", "dash"), (None, None)], "lang string, text string")
    rows = sourcing.encoding_scan(lambda name: docs, spark).collect()
    assert {r["lang"]: (r["lines"], r["chars"]) for r in rows} == {None: (3, 9), "de": (1, 6), "en": (1, 7), "-": (1, 4)}


def test_seeds(spark):
    import enum

    from statkit.sources import seeds

    class Kind(enum.IntEnum):
        NOT_KNOWN = 9
        KNOWN = 1

    assert [tuple(r) for r in seeds.seed(spark, Kind).collect()] == [(9, "NOT_KNOWN", "Not known"), (1, "KNOWN", "Known")]
    assert [tuple(r) for r in seeds.seed(spark, {1: "one", 2: "two"}).collect()] == [(1, "1", "one"), (2, "2", "two")]
    with pytest.raises(ValueError, match="twice"):
        seeds.seed(spark, ["a", "a"])
