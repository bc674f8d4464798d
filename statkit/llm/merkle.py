"""Merkle manifest of a dataset by nested-interval labels.

The leaves of a tree are numbered by rank, and each node carries the interval [lo, hi) of leaf ranks that it covers: a
parent's interval is the union of its children's, so one node is an ancestor of another if its interval contains the
other's, and what is left of a parent's interval without a child's is the interval of the child's sibling.

Levels are dealt with in bands of BAND. A bucket is the part of a band below one node at the band's top: at most 2 ** BAND
nodes, gathered by rank, so no group grows with the data, and a hot tree is many buckets. Bucket by bucket the band's
levels are formed; the buckets' tops are the next band's lowest nodes. Ancestors are attached downwards by a containment
join of each bucket's top with the bucket above it. A tree of n leaves takes log2(n) / BAND rounds.

There is a tree for each group (subroot), and one over the subroots, formed alike (root).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statkit.operators.ranking import numbered

from .common import broadcast_if, stored

BAND = 10  #: levels that are joined at once
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def shown(digest: Column) -> Column:
    """A digest as lower-case hexadecimal text."""
    return F.lower(F.hex(digest))


def digest(*parts: Column) -> Column:
    """SHA-256 of the concatenated texts, as binary."""
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def leaf_digest(*values: Column) -> Column:
    """The digest of a row's values: `-` for null, else its UTF-8 byte count, a colon and the value, integers in decimal."""
    text = [v.cast("string") for v in values]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text])


def _parent(left: Column, right: Column) -> Column:
    return F.struct(
        left["lo"].alias("lo"), F.coalesce(right["hi"], left["hi"]).alias("hi"),
        digest(shown(left["digest"]), F.coalesce(shown(right["digest"]), F.lit(""))).alias("digest"),
    )


def _levels(nodes: Column, count: Column) -> Column:
    """Array of levels, each an array of nodes (lo, hi, digest) by rank: `nodes` and `count` levels above them."""
    steps = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.expr("cast(array() as array<int>)"))

    def up(levels: Column, _: Column) -> Column:
        below = F.element_at(levels, -1)
        pairs = F.sequence(F.lit(0), F.floor((F.size(below) - 1) / 2).cast("int"))
        return F.concat(levels, F.array(F.transform(pairs, lambda i: _parent(F.get(below, 2 * i), F.get(below, 2 * i + 1)))))

    return F.aggregate(steps, F.array(nodes), up)


def _path(levels: Column, count: Column, at: Column) -> Column:
    """Array by level of (before, after): the digests of the siblings on the way from node `at` of the lowest level upwards."""
    steps = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.expr("cast(array() as array<int>)"))

    def siblings(level: Column) -> Column:
        here, above = F.get(levels, level), F.get(levels, level + 1)
        i = F.call_function("shiftright", at, level)
        own, parent = F.get(here, i), F.get(above, F.call_function("shiftright", at, level + 1))
        # the parent's interval without the node's own: what lies before it, and what lies after it
        before, after = F.get(here, i - 1), F.get(here, i + 1)
        return F.struct(
            F.when((parent["lo"] < own["lo"]) & (before["lo"] == parent["lo"]) & (before["hi"] == own["lo"]), before["digest"]).alias("before"),
            F.when((own["hi"] < parent["hi"]) & (after["lo"] == own["hi"]) & (after["hi"] == parent["hi"]), after["digest"]).alias("after"),
        )

    return F.transform(steps, siblings)


NO_PATH = "cast(array() as array<struct<before:binary,after:binary>>)"


@dataclass
class Forest:
    """Trees by bands. bands: (tree, n, bucket, lo, hi, count, members, levels, top), a row for each bucket; trees: (tree, n, digest), a row for each tree."""

    bands: list[DataFrame]
    trees: DataFrame


def forest(leaves: DataFrame, most: int) -> Forest:
    """The trees over leaves (tree, n, rank, digest, load): n leaves each, of ranks 0 to n - 1, at most `most`; load is carried along."""
    nodes = leaves.select("tree", "n", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "digest", "load")
    bands, roots = [], None
    depth = F.when(F.col("n") > 1, F.length(F.bin(F.col("n") - 1))).otherwise(0)
    while True:
        r = len(bands)
        count = F.least(F.greatest(depth - r * BAND, F.lit(0)), F.lit(BAND)).cast("int")
        members = F.sort_array(F.collect_list(F.struct("lo", "hi", "digest", "load")))
        buckets = nodes.groupBy("tree", "n", F.shiftright("lo", BAND * (r + 1)).alias("bucket")).agg(members.alias("members"))
        lowest = F.transform("members", lambda m: F.struct(m["lo"].alias("lo"), m["hi"].alias("hi"), m["digest"].alias("digest")))
        buckets = buckets.select("tree", "n", "bucket", count.alias("count"), "members", _levels(lowest, count).alias("levels"))
        top = F.get(F.element_at("levels", -1), F.lit(0))
        band = stored(buckets.select("*", top["lo"].alias("lo"), top["hi"].alias("hi"), top["digest"].alias("top")), "band")
        bands.append(band)
        here = band.filter(F.col("hi") - F.col("lo") == F.col("n")).select("tree", "n", F.col("top").alias("digest"))
        roots = here if roots is None else roots.unionByName(here)
        if most <= 1 << (BAND * (r + 1)):
            return Forest(bands, roots)
        nodes = band.filter(F.col("hi") - F.col("lo") < F.col("n")).select("tree", "n", "lo", "hi", F.col("top").alias("digest"), F.lit(None).cast("int").alias("load"))


def paths(grown: Forest) -> DataFrame:
    """(tree, lo, digest, load, path) for each leaf: path is the array of (before, after) from the leaf to its tree's root."""
    above = None
    for r in reversed(range(len(grown.bands))):
        band = grown.bands[r].select("tree", "bucket", "lo", "hi", "count", "members", "levels")
        if above is None:
            band = band.withColumn("on", F.expr(NO_PATH))
        else:
            # containment join: the node that the upper band has for this bucket covers the bucket's interval
            up = above.select(F.col("tree").alias("up_tree"), F.shiftright("lo", BAND * (r + 1)).alias("up_bucket"), F.col("lo").alias("up_lo"), F.col("hi").alias("up_hi"), F.col("path").alias("up_path"))
            inside = (F.col("tree") == F.col("up_tree")) & (F.col("bucket") == F.col("up_bucket")) & (F.col("up_lo") <= F.col("lo")) & (F.col("hi") <= F.col("up_hi"))
            band = band.join(up, inside, "left").withColumn("on", F.coalesce("up_path", F.expr(NO_PATH)))
        one = band.select("tree", "count", "levels", "on", F.posexplode("members").alias("at", "m"))
        above = one.select("tree", "m.lo", "m.hi", "m.digest", "m.load", F.concat(_path(F.col("levels"), F.col("count"), F.col("at")), "on").alias("path"))
    return above


def folded(path: Column, leaf: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda own, s: digest(F.coalesce(shown(s["before"]), F.lit("")), shown(own), F.coalesce(shown(s["after"]), F.lit(""))))


def proof_text(path: Column) -> Column:
    """The siblings on a path as one text, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(F.coalesce(shown(s["before"]), F.lit("")), F.coalesce(shown(s["after"]), F.lit("")))), "")


@dataclass
class Manifest:
    """forest: a tree for each group, whose number (tree) is that of its first leaf; groups: (tree, name, n); over: the tree of the subroots; root: its digest."""

    forest: Forest
    groups: DataFrame
    over: Forest
    root: bytes | None


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, by: str = "lang", order: str = "doc_id", load: Column | None = None) -> Manifest:
    """The Merkle trees of docs, whose rows are leaves: a tree for each value of `by`, in ascending `order`, and one over them.

    fields: the columns that a leaf's digest covers. load: a column that is carried along with each leaf (else the order).
    While more than one node remains, every two consecutive ones become the digest of their hexadecimal digests, the last
    one alone its own. Trees are ordered by `by`, null first, then bytewise.

    Null values are told from empty ones. Null order comes first. Rows that agree in order are ranked by their digests, so
    equal rows are interchangeable. Columns not named are not read, whatever their names. An empty table has no root.
    """
    rows = docs.select(F.col(by).cast("string").alias("name"), F.col(order).alias("key"), leaf_digest(*[F.col(f"`{f}`") for f in fields]).alias("digest"), (F.col(order) if load is None else load).alias("load"))
    ranked = numbered(stored(rows, "leaves"), ["name", "key", "digest"], "place", start=-1)
    groups = stored(ranked.groupBy("name").agg(F.min("place").alias("tree"), F.count(F.lit(1)).alias("n")), "trees")
    trees, most = groups.agg(F.count(F.lit(1)), F.max("n")).first()
    leaves = ranked.join(broadcast_if(groups.withColumnRenamed("name", "of"), trees), F.col("name").eqNullSafe(F.col("of")))
    grown = forest(leaves.select("tree", "n", (F.col("place") - F.col("tree")).alias("rank"), "digest", "load"), most or 0)
    subroots = numbered(groups.join(grown.trees.select("tree", "digest"), "tree").select("name", "digest", F.col("tree").alias("load")), ["name"], "rank", start=-1)
    over = forest(subroots.select(F.lit(0).cast("long").alias("tree"), F.lit(trees).cast("long").alias("n"), "rank", "digest", "load"), trees)
    root = over.trees.first()
    return Manifest(grown, groups, over, bytes(root["digest"]) if root else None)


def nodes(made: Manifest) -> DataFrame:
    """(name, level, lo, hi, digest): all nodes of the groups' trees, level 0 the leaves; what a manifest file holds."""
    out = None
    for r, band in enumerate(made.forest.bands):
        level = band.select("tree", "lo", "hi", "n", F.posexplode("levels").alias("level", "nodes"))
        # a bucket's top is the lowest node of the band above, if there is one
        level = level.filter((F.lit(r == 0) | (F.col("level") > 0))).select("tree", (F.col("level") + r * BAND).alias("level"), F.explode("nodes").alias("x"))
        level = level.select("tree", "level", "x.lo", "x.hi", "x.digest")
        out = level if out is None else out.unionByName(level)
    return out.join(made.groups.select("tree", "name"), "tree").select("name", "level", "lo", "hi", "digest")


def proofs(made: Manifest) -> DataFrame:
    """(digest, load, subroot, path) for each leaf: path leads through its tree's subroot to the root."""
    over = paths(made.over).select(F.col("load").alias("tree"), F.col("digest").alias("subroot"), F.col("path").alias("over"))
    over = stored(over, "over")
    return paths(made.forest).join(broadcast_if(over, over.count()), "tree").select("digest", "load", "subroot", F.concat("path", "over").alias("path"))
