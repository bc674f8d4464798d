"""Quadtree cells against unit cells, and the number of rows that boxes give."""

import random

import duckdb
from pyspark.sql import functions as F

from statkit import plans
from statkit.operators import cells, quadtree

BOX = ("x0", "y0", "x1", "y1")


def boxes(spark, rows, key):
    return spark.createDataFrame(rows, f"{key} long, x0 double, y0 double, x1 double, y1 double")


def found(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_a_large_box_gives_rows_as_its_outline(spark):
    """A million unit cells, at an odd place: a few thousand rows, whose areas add up and do not overlap."""
    rows = quadtree.quads(boxes(spark, [(1, -333.0, 77.0, 667.0, 1077.0)], "a"), ["a"], *BOX).cache()
    assert rows.count() <= 8 * 1000
    assert quadtree.areas(rows, ["a"]).first()["area"] == 1e6
    assert quadtree.dissolved(rows, ["a"]).count() == rows.count()
    aligned = quadtree.quads(boxes(spark, [(1, 0.0, 0.0, 1024.0, 1024.0)], "a"), ["a"], *BOX).collect()
    assert [r["level"] for r in aligned] == [10]
    thin = quadtree.quads(boxes(spark, [(1, 0.0, 0.0, 1.0, 5000.0)], "a"), ["a"], *BOX)
    assert thin.count() == 5000
    rows.unpersist()


def test_overlay_equals_unit_cells(spark):
    rng = random.Random(5)
    rows = lambda n: [(i, *(lambda x, y: (x, y, x + rng.randint(1, 25), y + rng.randint(1, 25)))(rng.randint(-20, 20), rng.randint(-20, 20))) for i in range(n)]
    a, b = ([(i, *map(float, r)) for i, *r in rows(12)] for _ in range(2))
    left, right = boxes(spark, a, "a"), boxes(spark, b, "b")
    want = cells.overlay(cells.cover(left, ["a"], *BOX), cells.cover(right, ["b"], *BOX), "a", "b")
    assert found(quadtree.overlay(quadtree.quads(left, ["a"], *BOX), quadtree.quads(right, ["b"], *BOX), "a", "b")) == found(want)


def test_unions_and_masks_equal_unit_cells(spark):
    rng = random.Random(6)
    rows = [(i % 3, *map(float, (lambda x, y: (x, y, x + rng.randint(1, 20), y + rng.randint(1, 20)))(rng.randint(-9, 20), rng.randint(-9, 20)))) for i in range(15)]
    a, b = boxes(spark, rows, "a"), boxes(spark, [(9, 2.0, -4.0, 19.0, 13.0), (8, 5.0, 5.0, 30.0, 9.0)], "b")
    qa, qb = quadtree.quads(a, ["a"], *BOX), quadtree.quads(b, ["b"], *BOX)
    ca, cb = cells.cover(a, ["a"], *BOX), cells.cover(b, ["b"], *BOX)
    assert found(quadtree.areas(quadtree.dissolved(qa, ["a"]), ["a"])) == found(cells.dissolve(ca, "a"))
    assert quadtree.masks(qa, qb).first() == cells.masks(ca, cb).first()
    merged = quadtree.from_cells(ca, ["a"])
    assert found(quadtree.areas(merged, ["a"])) == found(cells.dissolve(ca, "a"))
    assert merged.count() < ca.distinct().count() / 2


def test_odd_boxes(spark):
    rows = [(1, None, 0.0, 1.0, 1.0), (2, 3.0, 0.0, 3.0, 5.0), (3, 5.0, 0.0, 1.0, 1.0), (None, 0.25, 0.25, 0.5, 0.5), (4, 0.0, 0.0, 1.0, 1.0), (4, 0.0, 0.0, 1.0, 1.0)]
    got = quadtree.quads(boxes(spark, rows, "a"), ["a"], *BOX, 0.25)
    assert found(quadtree.areas(quadtree.dissolved(got, ["a"]), ["a"], 0.25).orderBy("area").select("area")) == [(0.0625,), (1.0,)]
    none = quadtree.quads(boxes(spark, [], "a"), ["a"], *BOX)
    assert none.count() == 0 and quadtree.masks(none, none).first()["union_area"] == 0.0
    assert quadtree.overlay(none, none.withColumnRenamed("a", "b"), "a", "b").count() == 0
    assert quadtree.from_cells(spark.range(0).select("id", F.lit(1).alias("cx"), F.lit(1).alias("cy")), ["id"]).count() == 0


def test_tiles_give_what_quads_give(spark):
    """A box is at most four rows whatever its outline; overlays and unions equal those of quads, for overlapping boxes and odd edges too."""
    rng = random.Random(7)
    spot = lambda i: (i % 7, *(lambda x, y: (x, y, x + rng.randint(1, 300) / 4, y + rng.randint(1, 300) / 4))(rng.randint(-99, 99) / 4, rng.randint(-99, 99) / 4))
    a = boxes(spark, [*map(spot, range(30)), (8, None, 0.0, 1.0, 1.0), (8, 3.0, 0.0, 3.0, 5.0), (9, 0.0, 0.0, 0.25, 0.25), (10, -64.0, -64.0, 64.0, 64.0)], "a")
    b = boxes(spark, [(i * 10 + j, i * 20.0, j * 20.0, i * 20.0 + 20, j * 20.0 + 20) for i in range(-4, 4) for j in range(-4, 4)] + [(None, 0.0, 0.0, 9.0, 9.0)], "b")
    ta, tb = (quadtree.tiles(d, [k], *BOX, 0.25) for d, k in ((a, "a"), (b, "b")))
    qa, qb = (quadtree.quads(d, [k], *BOX, 0.25) for d, k in ((a, "a"), (b, "b")))
    assert ta.count() <= 4 * a.count() < qa.count() / 40
    one = a.filter("x0 IS NOT NULL").select(F.monotonically_increasing_id().alias("a"), *BOX).localCheckpoint()
    to, qo = quadtree.tiles(one, ["a"], *BOX, 0.25), quadtree.quads(one, ["a"], *BOX, 0.25)
    made = quadtree.overlay_tiles(to, tb.filter("b IS NOT NULL"), "a", "b", 0.25)
    assert "Broadcast" not in made._jdf.queryExecution().executedPlan().toString()
    assert found(made) == found(quadtree.overlay(qo, qb.filter("b IS NOT NULL"), "a", "b", 0.25))
    order = lambda d: sorted(found(d.fillna(-1, ["b"])))
    want = quadtree.areas(quadtree.dissolved(quadtree.shared(qa, qb, "a", "b"), ["b"]), ["b"], 0.25)
    assert order(quadtree.united_areas(quadtree.shared_tiles(ta, tb, "a", "b"), ["b"], 0.25)) == order(want)


def test_every_box_counts_in_a_union(spark, tmp_path):
    """quad_dissolve over boxes of all keys, in the query and in its SQL: each grid cell that any box covers, once."""
    parts, units = [(1, 3), (2, 20), (3, 9), (4, 6), (5, 2), (41, 4), (83, 11)], [0, 1, 2, 10]
    spark.createDataFrame(parts, "p_partkey long, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(s,) for s in units], "s_suppkey long").write.parquet(f"{tmp_path}/supplier.parquet")
    covered = set()
    for k, size in parts:
        x, y = k % 40 * 144 + size % 16, k // 40 % 50 * 112 + size % 5  # in units of 1/16
        covered |= {(i, j) for i in range(x, x + 16 + size % 46 * 16 + k % 16) for j in range(y, y + 16 + size % 41 * 16 + 8)}
    inside = lambda s: sum(i // 640 == s % 10 and j // 640 == s // 10 for i, j in covered) / 256
    want = [(s, inside(s)) for s in units if inside(s)]
    assert len(want) == 2
    assert found(plans.QUERIES["quad_dissolve"](spark, str(tmp_path)).select("b", "area")) == want
    con = duckdb.connect()
    for name in ("part", "supplier"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    assert sorted(con.sql(f"SELECT b, area FROM ({plans.ORACLE['quad_dissolve']})").fetchall()) == want
