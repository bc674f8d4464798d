"""Exact top-k inner-product search with an M-tree.

The tree is built from above: TOPS routing objects, under each up to FAN leaf objects (all from a bounded sample of
vectors), under each leaf object its pages. A vector goes to the nearest top object, then to the nearest leaf object under
it, and a leaf's vectors are cut by their distance to it into paged nodes of about PAGE entries. Stored are: each entry's
distance to its leaf object (parent distance); each page's ring, the covering radius and the nearest distance; each leaf
object's covering radius and its distance to the top object; each top object's covering radius. x.y = (|x|^2 + |y|^2 -
|x - y|^2) / 2, so a lower bound on the distance and a largest norm make an upper bound on the inner product.

Queries are taken in blocks of bounded size, near ones together. A block first reads each query's most promising page for
a k-th score to beat. Then the tree is descended: a node is passed over, often without computing its distance, where the
triangle inequality shows that it holds nothing that good; pages that no query of the block needs are not read. Tasks
visit the others best first and raise each query's k-th score on the way.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if, shared_dir, stored, unit_hash

TOPS, FAN = 16, 16  #: routing objects of the root, and of each node under it at most
RINGS = 64  #: rings that a leaf's distances are counted in before they are grouped into pages
PAGE = 1024  #: entries of a page, about; a task cuts longer ones
SLICE = 1024  #: queries that a page is visited with at once
BLOCK = 16_384  #: queries of a block; so many vectors are sent to the tasks at once
SAMPLE = 4096  #: vectors that the routing objects are chosen from


def quantised(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """row (a number of its own), vec_id and v: floor(scale * x) of each component x as double, shorter vectors filled with zeros.

    Rows whose vec_id or vector is null, or whose vector has a null or non-finite component, go. Components so large that an
    inner product may reach 2 ** 53 are an error, since scores would not be exact.
    """
    x = vectors.select("vec_id", F.transform("embedding", lambda c: c.cast("double")).alias("x")).filter("vec_id is not null and x is not null")
    x = x.filter(~F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    rows = stored(x.select(F.monotonically_increasing_id().alias("row"), "vec_id", F.transform("x", lambda c: F.floor(c * scale).cast("long")).alias("v")), "quantised")
    largest = F.max(F.greatest(F.abs(F.array_max("v").cast("double")), F.abs(F.array_min("v").cast("double"))))
    sizes = rows.agg(F.min(F.size("v")).alias("low"), F.max(F.size("v")).alias("high"), largest.alias("most")).first()
    if (sizes["most"] or 0.0) ** 2 * (sizes["high"] or 0) >= 2.0**53:
        raise ValueError(f"components up to {sizes['most']:.0f} in {sizes['high']} dimensions pass what products of doubles hold exactly; lower the scale")
    if sizes["low"] == sizes["high"]:
        return rows
    return rows.withColumn("v", F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(sizes["high"]) - F.size("v"))))


def matrix(column: pa.Array) -> np.ndarray:
    """An array column of equally long vectors as a float matrix; exact for integers whose inner products stay below 2 ** 53."""
    return np.array(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(column), -1)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x**2).sum(axis=1)[:, None] + (y**2).sum(axis=1)[None, :] - 2 * (x @ y.T), 0.0))


def spread(x: np.ndarray, most: int) -> np.ndarray:
    """Places of up to `most` distinct vectors, each the farthest from those before it."""
    out, away = [0], distances(x, x[:1])[:, 0]
    while len(out) < most and away.max() > 0:
        out.append(int(away.argmax()))
        away = np.minimum(away, distances(x, x[out[-1:]])[:, 0])
    return np.array(out)


@dataclass
class Tree:
    """The inner nodes: a row for each top and leaf object. low, high and norm: of the vectors under it (norm: the largest)."""

    tops: np.ndarray
    leaves: np.ndarray
    parent: np.ndarray  #: of each leaf, its top object
    to_parent: np.ndarray  #: and its distance to it
    low: np.ndarray
    high: np.ndarray
    norm: np.ndarray

    @property
    def covering(self) -> np.ndarray:
        """Covering radii of the top objects."""
        out = np.zeros(len(self.tops))
        np.maximum.at(out, self.parent, self.to_parent + self.high)
        return out


def grown(sample: np.ndarray, n: int) -> Tree:
    """A tree of routing objects without entries, for n vectors: with about as many leaf objects as pages, TOPS * FAN at most."""
    wide = max(1, -(-n // PAGE)) ** 0.5
    tops = sample[spread(sample, min(TOPS, round(wide + 0.5)))]
    near = distances(sample, tops).argmin(axis=1)
    leaves, parent = [], []
    for t in range(len(tops)):
        own = sample[near == t]
        chosen = own[spread(own, min(FAN, round(wide + 0.5)))] if len(own) else tops[t : t + 1]
        leaves.append(chosen)
        parent += [t] * len(chosen)
    leaves, parent = np.vstack(leaves), np.array(parent)
    zero = np.zeros(len(leaves))
    return Tree(tops, leaves, parent, np.sqrt(((leaves - tops[parent]) ** 2).sum(axis=1)), zero, zero.copy(), zero.copy())


def _routed(tree: Tree):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(2))
            top = distances(x, tree.tops).argmin(axis=1)
            leaf, away = np.zeros(len(x), np.int64), np.zeros(len(x))
            for t in np.unique(top):
                rows, under = np.flatnonzero(top == t), np.flatnonzero(tree.parent == t)
                leaf[rows] = under[distances(x[rows], tree.leaves[under]).argmin(axis=1)]
            away = np.sqrt(((x - tree.leaves[leaf]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf), pa.array(away), pa.array(np.sqrt((x**2).sum(axis=1)))], names=["row", "vec_id", "v", "leaf", "away", "norm"])

    return run


def build(rows: DataFrame) -> tuple[Tree, DataFrame, DataFrame] | None:
    """(inner nodes, pages, entries) of quantised rows; None if there are none. Entries lie page by page, in a folder for each leaf."""
    drawn = rows.orderBy(unit_hash(8, F.col("row")), "row").limit(SAMPLE).collect()
    if not drawn:
        return None
    tree = grown(np.array([r["v"] for r in drawn], dtype=np.float64), rows.count())
    routed = stored(rows.mapInArrow(_routed(tree), "row long, vec_id long, v array<long>, leaf long, away double, norm double"), "routed")
    leaf = routed.groupBy("leaf").agg(F.min("away").alias("least"), F.max("away").alias("most"))  # a row for each leaf object
    ring = F.least(F.floor((F.col("away") - F.col("least")) / (F.col("most") - F.col("least")) * RINGS), F.lit(RINGS - 1))
    ringed = routed.join(F.broadcast(leaf), "leaf").withColumn("ring", F.when(F.col("most") > F.col("least"), ring).otherwise(0))
    rings = ringed.groupBy("leaf", "ring").agg(F.count(F.lit(1)).alias("n"))  # at most TOPS * FAN * RINGS rows
    upto = Window.partitionBy("leaf").orderBy("ring").rowsBetween(Window.unboundedPreceding, -1)
    rings = rings.withColumn("group", F.floor(F.coalesce(F.sum("n").over(upto), F.lit(0)) / PAGE)).withColumn("parts", F.ceil(F.col("n") / PAGE))
    paged = ringed.join(F.broadcast(rings.select("leaf", "ring", "group", "parts")), ["leaf", "ring"])
    split = F.when(F.col("parts") > 1, F.pmod(F.xxhash64("row"), F.col("parts")) + 1).otherwise(0)  # equal distances are cut by hash
    page = F.xxhash64("leaf", "group", F.when(split > 0, F.col("ring")), split)
    paged = paged.select("row", "vec_id", "v", "away", "norm", "leaf", page.alias("page"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    path = f"{shared_dir(rows.sparkSession)}/entries-{uuid.uuid4().hex}"
    paged.repartitionByRange(parts, "leaf", "page").sortWithinPartitions("leaf", "page", "away").write.partitionBy("leaf").parquet(path)
    entries = rows.sparkSession.read.schema("row long, vec_id long, v array<long>, away double, norm double, page long, leaf long").parquet(path)
    pages = stored(entries.groupBy("leaf", "page").agg(F.min("away").alias("low"), F.max("away").alias("high"), F.max("norm").alias("norm"), F.count(F.lit(1)).alias("n")), "pages")
    for r in pages.groupBy("leaf").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.max("norm").alias("norm")).collect():  # a row for each leaf object
        tree.low[r["leaf"]], tree.high[r["leaf"]], tree.norm[r["leaf"]] = r["low"], r["high"], r["norm"]
    return tree, pages, entries


def upper(square: np.ndarray, norm, nearest: np.ndarray) -> np.ndarray:
    """The largest inner product of a query (its squared norm) with vectors of at most that norm and at least that distance; with a margin for rounding."""
    return (square + norm**2 - np.maximum(nearest, 0.0) ** 2) / 2 + 1e-6 * (1 + square + norm**2)


def descended(tree: Tree, q: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, int]:
    """Distances of queries to leaf objects, infinite where the leaf can't hold a score of `least`; and how many were computed.

    A top object's subtree is passed over by its covering radius, a leaf by its stored distance to the top object.
    """
    square, out, done = (q**2).sum(axis=1), np.full((len(q), len(tree.leaves)), np.inf), 0
    to_top = distances(q, tree.tops)
    largest = np.zeros(len(tree.tops))
    np.maximum.at(largest, tree.parent, tree.norm)
    open_ = upper(square[:, None], largest[None, :], to_top - tree.covering[None, :]) >= least[:, None]
    for j, t in enumerate(tree.parent):
        gap = np.abs(to_top[:, t] - tree.to_parent[j])
        may = np.flatnonzero(open_[:, t] & (upper(square, tree.norm[j], gap - tree.high[j]) >= least))
        if len(may):
            out[may, j] = distances(q[may], tree.leaves[j : j + 1])[:, 0]
            done += len(may)
    return out, done


def ring_bounds(square: np.ndarray, to_leaf: np.ndarray, low, high, norm) -> np.ndarray:
    """Upper bounds of queries on a page with that ring; minus infinity where the leaf is closed to a query."""
    return np.where(np.isfinite(to_leaf), upper(square, norm, np.maximum(to_leaf - high, low - to_leaf)), -np.inf)


def _columns(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in names]


def _homes(shared, k: int):
    """Of pages with more than k entries: each query's page with the highest bound (of this task)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, q, least = shared.value
        square, to_leaf = (q**2).sum(axis=1), descended(tree, q, least)[0]
        best, where, of = np.full(len(q), -np.inf), np.zeros(len(q), np.int64), np.zeros(len(q), np.int64)
        for batch in batches:
            for leaf, page, n, low, high, norm in zip(*_columns(batch, "leaf", "page", "n", "low", "high", "norm"), strict=True):
                if n <= k:
                    continue
                bound = ring_bounds(square, to_leaf[:, leaf], low, high, norm)
                better = bound > best
                best[better], where[better], of[better] = bound[better], page, leaf
        some = np.flatnonzero(np.isfinite(best))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(best[some]), pa.array(where[some]), pa.array(of[some])], names=["query", "bound", "page", "leaf"])

    return run


def _opened(shared):
    """Of pages: those that some query of the block needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, q, least = shared.value
        square, to_leaf = (q**2).sum(axis=1), descended(tree, q, least)[0]
        for batch in batches:
            leaves, pages, *rings = _columns(batch, "leaf", "page", "low", "high", "norm")
            need = np.array([(ring_bounds(square, to_leaf[:, leaf], *ring) >= least).any() for leaf, *ring in zip(leaves, *rings, strict=True)], dtype=bool)
            yield pa.RecordBatch.from_arrays([pa.array(pages[need]), pa.array(leaves[need])], names=["page", "leaf"])

    return run


class Best:
    """The k best (score, vec_id, row) of each query of a block, ties to the smaller vec_id, then row."""

    def __init__(self, n: int, k: int, least: np.ndarray):
        last = np.iinfo(np.int64).max
        self.score, self.ids, self.rows, self.k = np.full((n, k), -np.inf), np.full((n, k), last), np.full((n, k), last), k
        self.least = least.copy()  # a score that k candidates are known to reach

    def add(self, q: np.ndarray, ids: np.ndarray, rows: np.ndarray, scores: np.ndarray) -> None:
        """scores: a row for each of the queries q, a column for each of ids; -inf where the pair does not count."""
        s = np.concatenate([self.score[q], scores], axis=1)
        i, r = (np.concatenate([old[q], np.broadcast_to(new, scores.shape)], axis=1) for old, new in ((self.ids, ids), (self.rows, rows)))
        order = np.lexsort((r, i, -s), axis=1)[:, : self.k]
        self.score[q], self.ids[q], self.rows[q] = (np.take_along_axis(x, order, 1) for x in (s, i, r))
        self.least[q] = np.maximum(self.least[q], self.score[q, -1])


def visit(best: Best, q: np.ndarray, q_rows: np.ndarray, ids: np.ndarray, rows: np.ndarray, x: np.ndarray, away: np.ndarray, to_leaf: np.ndarray, most: int = SLICE) -> int:
    """One page for all queries whose bound allows it, `most` at a time; the number of inner products computed."""
    square, own, done = (q**2).sum(axis=1), (x**2).sum(axis=1), 0
    may = np.flatnonzero(ring_bounds(square, to_leaf, away.min(), away.max(), np.sqrt(own.max())) >= best.least)
    for start in range(0, len(may), most):
        part = may[start : start + most]
        gap = np.abs(to_leaf[part][:, None] - away[None, :])  # a lower bound on the distance by the stored parent distances
        open_ = upper(square[part][:, None], np.sqrt(own)[None, :], gap) >= best.least[part][:, None]
        columns = np.flatnonzero(open_.any(axis=0))
        if not len(columns):
            continue
        scores = q[part] @ x[columns].T
        scores[~open_[:, columns] | (q_rows[part][:, None] == rows[columns][None, :])] = -np.inf
        best.add(part, ids[columns], rows[columns], scores)
        done += len(part) * len(columns)
    return done


def _searched(shared, k: int, most: int):
    """Entries, page by page: this task's k best of each query. With homes, a page is visited by the queries at home there only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, q, least, q_rows, homes = shared.value
        best, to_leaf = Best(len(q), k, least), descended(tree, q, least)[0]
        for batch in batches:
            if not batch.num_rows:
                continue
            page, leaf, ids, rows, away = _columns(batch, "page", "leaf", "vec_id", "row", "away")
            x = matrix(batch.column(batch.schema.get_field_index("v")))
            square = (q**2).sum(axis=1)
            runs = [0, *(np.flatnonzero(page[1:] != page[:-1]) + 1), len(page)]
            cuts = [(i, min(i + most, b)) for a, b in zip(runs, runs[1:], strict=False) for i in range(a, b, most)]
            norms = np.sqrt((x**2).sum(axis=1))
            bounds = [ring_bounds(square, to_leaf[:, leaf[a]], away[a:b].min(), away[a:b].max(), norms[a:b].max()).max() for a, b in cuts]
            for i in np.argsort(-np.array(bounds), kind="stable"):  # best first; each cut of a page is a node with a ring of its own
                a, b = cuts[i]
                at = slice(a, b)
                here = to_leaf[:, leaf[a]] if homes is None else np.where(homes == page[a], to_leaf[:, leaf[a]], np.inf)
                visit(best, q, q_rows, ids[at], rows[at], x[at], away[at], here)
        found, columns = np.nonzero(np.isfinite(best.score))
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(best.ids[found, columns]), pa.array(best.rows[found, columns]), pa.array(best.score[found, columns].astype(np.int64))], names=["query", "vec_id", "row", "score"])

    return run


FOUND = "query long, vec_id long, row long, score long"


def _read(entries: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """The entries of the wanted pages (page, leaf), page by page; only the folders of their leaves are read."""
    leaves = [r["leaf"] for r in wanted.select("leaf").distinct().collect()]  # at most TOPS * FAN
    some = entries.filter(F.col("leaf").isin(leaves)).join(broadcast_if(wanted.select("page").distinct(), n), "page", "left_semi")
    return some if n <= 100_000 else some.sortWithinPartitions("page", "away")


def _blocks(asked: DataFrame) -> list[list[int]]:
    """Units (a leaf's queries, or a part of them) by block, of at most about BLOCK queries."""
    sizes = sorted((r["leaf"], r["count"]) for r in asked.groupBy("leaf").count().collect())  # a row for each leaf object
    blocks, room = [], 0
    for leaf, n in sizes:
        parts = -(-n * 5 // (4 * BLOCK))
        for part in range(parts):
            if room < -(-n // parts):
                blocks.append([])
                room = BLOCK * 4 // 5
            blocks[-1].append((leaf, part, parts))
            room -= -(-n // parts)
    return blocks


def top_k(vectors: DataFrame, queries, k: int = 10, scale: int = 1024, counts: dict | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best other rows by integer inner product, ties to the smaller vec_id.

    vectors needs vec_id (an integer) and embedding. queries: a condition on vec_id. Rows with null vec_id, with a null
    vector or with null or non-finite components take no part. Of vectors of unequal length the shorter count as filled
    with zeros (an empty one scores 0). Rows that share a vec_id are rows of their own: each is a query and a candidate of
    all others. A query with fewer than k candidates gets all; an empty table gives no rows. counts gets the numbers of
    blocks, of pages and of pages that were not read, summed over blocks.

    Through the driver pass SAMPLE vectors once, and for one block at a time its queries (at most about BLOCK); they are
    sent to the tasks as a broadcast variable, which is destroyed after the block.
    """
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    counts = {} if counts is None else counts
    counts.update(blocks=0, pages=0, unread=0)
    index = build(quantised(vectors, scale))
    if index is None:
        return empty
    tree, pages, entries = index
    asked = entries.filter(queries).select("row", "vec_id", "v", "leaf")
    path, n_pages = f"{shared_dir(spark)}/found-{uuid.uuid4().hex}", pages.count()
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    blocks = _blocks(asked)
    for number, units in enumerate(blocks):
        wanted = [(F.col("leaf") == leaf) & (F.pmod(F.xxhash64("row"), F.lit(parts)) == part) for leaf, part, parts in units if parts > 1]
        whole = [leaf for leaf, _, parts in units if parts == 1]
        chosen = F.col("leaf").isin(whole)
        for condition in wanted:
            chosen = chosen | condition
        block = asked.filter(chosen).orderBy("row").collect()
        q, q_rows = np.array([r["v"] for r in block], dtype=np.float64), np.array([r["row"] for r in block])
        least = np.full(len(q), -np.inf)

        sent = [spark.sparkContext.broadcast((tree, q, least))]
        homes = pages.mapInArrow(_homes(sent[0], k), "query long, bound double, page long, leaf long")
        homes = stored(homes.groupBy("query").agg(F.max_by(F.struct("page", "leaf"), F.struct("bound", "page")).alias("at")).select("query", "at.page", "at.leaf"), "homes")
        home = np.zeros(len(q), np.int64)
        for r in homes.collect():  # a row for each query of the block
            home[r["query"]] = r["page"]
        sent.append(spark.sparkContext.broadcast((tree, q, least, q_rows, home)))
        near = _read(entries, homes, len(q)).mapInArrow(_searched(sent[1], k, PAGE), FOUND)
        near = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") == k).select("query", "score")
        for r in near.collect():  # of queries with k candidates at home, the k-th score
            least[r["query"]] = r["score"]

        sent.append(spark.sparkContext.broadcast((tree, q, least)))
        opened = stored(pages.mapInArrow(_opened(sent[2]), "page long, leaf long"), "opened")
        n = opened.count()
        counts.update(blocks=counts["blocks"] + 1, pages=counts["pages"] + n_pages, unread=counts["unread"] + n_pages - n)
        sent.append(spark.sparkContext.broadcast((tree, q, least, q_rows, None)))
        found = _read(entries, opened, n).mapInArrow(_searched(sent[3], k, PAGE), FOUND)
        found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        ids = asked.filter(chosen).select("row", F.col("vec_id").alias("query_id"))
        places = spark.createDataFrame([(i, int(r)) for i, r in enumerate(q_rows)], "query long, row long")
        named = found.drop("row").join(F.broadcast(places.join(ids, "row").drop("row")), "query")
        named.select("query_id", "rank", "vec_id", "score").write.parquet(f"{path}/block={number}")
        for variable in sent:
            variable.destroy()
    return spark.read.schema("query_id long, rank int, vec_id long, score long").parquet(*[f"{path}/block={i}" for i in range(len(blocks))]) if blocks else empty
