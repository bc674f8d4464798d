"""Cells of many or large boxes: what a join or a task may hold of them."""

from pyspark.sql import functions as F

from statkit.operators import cells

BOX = ("x0", "y0", "x1", "y1")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def covers(spark, *keys):
    boxes = lambda k: spark.range(40).select(F.col("id").alias(k), *[(F.col("id") * 7 + n).alias(c) for c, n in zip(BOX, (0, 0, 300, 200), strict=True)])
    return [cells.cover(boxes(k), [k], *BOX) for k in keys]


def test_cells_of_few_boxes_are_joined_by_shuffles(spark):
    """A few small rows give many cells: their estimated size must not let a join broadcast them, nor one task make them all."""
    a, b = covers(spark, "a", "b")
    assert a.rdd.getNumPartitions() == 40 * 300 * 200 // cells.TASK_CELLS + 1 > 1
    for made in (cells.overlay(a, b, "a", "b"), cells.candidates(a, b, "a", "b")):
        assert "Broadcast" not in plan(made)
    assert cells.overlay(a, b, "a", "b").filter("a = 0 AND b = 10").first()["area"] == 230 * 130


def test_a_mask_is_not_broadcast(spark):
    a, b = covers(spark, "a", "b")
    clipped = cells.clip(a, b.filter("b = 0"))
    assert "Broadcast" not in plan(clipped)
    assert clipped.filter("a = 10").count() == 230 * 130


def test_cells_are_dissolved_in_as_many_tasks_as_they_fill(spark):
    """What one task gathers before the first shuffle is bounded, however small the file of boxes."""
    keyed = spark.range(40).select((F.col("id") % 2).alias("g"), *[(F.col("id") * 7 + n).alias(c) for c, n in zip(BOX, (0, 0, 300, 200), strict=True)])
    made = cells.cover(keyed, ["g"], *BOX)
    per_task = [r["n"] for r in made.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(per_task) == 40 * 300 * 200 and max(per_task) <= 1.2 * cells.TASK_CELLS
    assert cells.dissolve(made, "g").filter("g = 0").first()["area"] == made.filter("g = 0").distinct().count()


def test_cells_that_several_keys_claim_keep_two_keys_each(spark):
    made = spark.createDataFrame([(1, 0, 0), (1, 0, 0), (2, 0, 0), (None, 0, 1), (3, 0, 1), (4, 1, 1), (5, 1, 1), (6, 1, 1)], "a int, cx int, cy int")
    found = cells.self_overlaps(made, "a")
    assert tuple(found.first()) == (2, 2.0)
    assert plan(found).count("HashAggregate(keys=[cx") == 2  # one grouping; distinct keys would be a second one
