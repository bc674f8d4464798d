"""Carry scans against plain loops, over many partitions, with values that cross several of them."""

import pytest
from pyspark.sql import functions as F

from statkit.operators import carry

ROWS = [(i, f"v{i}" if i in (3, 4, 170, 171) else None, i if i % 23 == 5 else None, 1, 2) for i in range(300)]
SCHEMA = "k long, a string, b long, part int, at int"  # with the names that the operators use themselves


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_fill_crosses_partitions(spark, parts):
    rows = spark.createDataFrame(ROWS[::-1], SCHEMA)
    got = carry.fill_down(rows, ["k"], ["a", "b"], parts=parts)
    assert got.columns == rows.columns
    a = b = None
    want = []
    for r in ROWS:
        a, b = r[1] or a, r[2] if r[2] is not None else b
        want.append((r[0], a, b, 1, 2))
    assert sorted(tuple(r) for r in got.collect()) == want
    only = carry.fill_down(rows, ["k"], ["a"], when=F.col("k") % 2 == 0, parts=parts).orderBy("k").collect()
    assert [r["a"] for r in only] == [w[1] if w[0] % 2 == 0 else r[1] for w, r in zip(want, ROWS, strict=True)]


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_numbers_and_blocks(spark, parts):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    got = carry.count_on(rows, ["k"], F.col("a").isNotNull(), parts=parts).orderBy("k").collect()
    n = block = 0
    for r, row in zip(ROWS, got, strict=True):
        block, n = (block + 1, 1) if r[1] else (block, n + 1)
        assert (row["k"], row["n"], row["block"]) == (r[0], n, block)
    whole = carry.count_on(rows, ["k"], parts=parts).orderBy("k").collect()
    assert [r["n"] for r in whole] == list(range(1, 301)) and {r["block"] for r in whole} == {0}


@pytest.mark.parametrize("parts", [1, 20])
def test_outline(spark, parts):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    levels = {"chapter": F.when(F.col("k") % 90 == 40, F.col("k")), "section": F.when(F.col("k") % 31 == 7, F.col("k")), "item": F.col("b")}
    got = carry.outline(rows, ["k"], levels, parts=parts).orderBy("k").collect()
    chapter = section = item = None
    for r, row in zip(ROWS, got, strict=True):
        if r[0] % 90 == 40:
            chapter, section, item = r[0], None, None
        if r[0] % 31 == 7:
            section, item = r[0], None
        if r[2] is not None:
            item = r[2]
        assert (row["chapter"], row["section"], row["item"]) == (chapter, section, item)


def test_no_task_holds_all_rows(spark):
    rows = spark.range(20_000).select(F.col("id").alias("k"), F.when(F.col("id") % 1000 == 0, F.col("id")).alias("v"))
    got = carry.fill_down(rows, ["k"], ["v"], parts=16)
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    laid, part, _ = carry.laid_out(rows, ["k"], 16)
    assert max(r["count"] for r in laid.groupBy(part).count().collect()) < 5000 and sum(sizes) == 20_000
    assert carry.parts_for(rows) >= 1


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert carry.fill_down(none, ["k"], ["a"]).count() == 0
    assert carry.count_on(none, ["k"]).count() == 0
    assert carry.outline(none, ["k"], {"c": F.col("b")}).columns == [*none.columns, "c"]
