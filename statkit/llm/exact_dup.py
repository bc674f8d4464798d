"""Exact dedup with a log-structured merge index.

Rows come in generations (memtables). A memtable groups its rows by digest and is flushed as a run: a table in shards by
digest, each sorted by digest, with the identifier that stays and the number of rows of each digest, and a filter (a bitmap
of its digests). Before a run joins the index, its digests are tested against the filter of each run that the index has;
only those that pass are looked up in that run's rows, and what is found there is a hit. FANOUT runs of a level are
compacted into one run of the next: shard by shard their rows of a digest keep the smallest (or largest) identifier.

Hits (digests with more than one row) receive byte verification: the texts of a hit are compared with the text of the row
that stays; rows whose bytes differ (a digest collision) are grouped anew by their bytes. Only hits' texts move: rows
that a broadcast filter of the hits excludes are answered where they are. A hot group of copies is salted over many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import filter_bits, key_filter, maybe_in, own_columns, stored, whole_text, without

GENERATIONS = 2  #: memtables that one table of documents is ingested in
FANOUT = 2  #: runs of a level that are compacted into one of the next
SALT_ROWS = 512  #: rows of one hot digest that share a verification task
HOT_DIGESTS = 10_000  #: a digest is hot with more than SALT_ROWS rows and 1 / HOT_DIGESTS of all rows; so there are fewer of them


def digest_of(text: Column, bits: int = 256) -> Column:
    """First bits (a multiple of 8) of the SHA-256 of the text's UTF-8 bytes."""
    return F.substring(F.unhex(F.sha2(text.cast("binary"), 256)), 1, bits // 8)


@dataclass
class Run:
    """A sorted run: rows (digest, keep_id, n), their number, and the filter (bucket, bits) of 2 ** bits bits."""

    rows: DataFrame
    size: int
    filter: DataFrame
    bits: int


@dataclass
class Index:
    """Runs by level, and the counts of what was done: digests tested, digests that passed a filter, runs read, compactions."""

    keep: str = "smallest"
    levels: list[list[Run]] = field(default_factory=list)
    tested: int = 0
    passed: int = 0
    looked_up: int = 0
    compactions: int = 0


def flushed(rows: DataFrame, keep: str) -> Run:
    """A run of rows (digest, keep_id, n), written once: one row for each digest, sorted by digest in each shard; and its filter."""
    chosen = F.min("keep_id") if keep == "smallest" else F.max("keep_id")
    run = stored(rows.groupBy("digest").agg(chosen.alias("keep_id"), F.sum("n").alias("n")).sortWithinPartitions("digest"), "run")
    size = run.count()
    bits = filter_bits(size)
    return Run(run, size, key_filter(run, ["digest"], bits), bits)


def add(index: Index, rows: DataFrame) -> DataFrame:
    """Flushes a memtable of rows (doc_id, digest) into the index and returns its hits (digest; may repeat).

    A hit is a digest that the memtable has more than once, or that a run of the index has too.
    """
    run = flushed(rows.select("digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("n")), index.keep)
    hits = run.rows.filter("n > 1").select("digest")
    for old in [r for level in index.levels for r in level]:
        passing = stored(maybe_in(run.rows.select("digest"), [F.col("digest")], old.filter, old.bits)[0], "probes")
        n = passing.count()
        index.tested += run.size
        index.passed += n
        if n:  # else the run is not read
            index.looked_up += 1
            hits = hits.unionByName(passing.join(old.rows, "digest", "left_semi"))
    if not index.levels:
        index.levels.append([])
    index.levels[0].append(run)
    level = 0
    while len(index.levels[level]) >= FANOUT:
        if level + 1 == len(index.levels):
            index.levels.append([])
        whole = index.levels[level][0].rows
        for other in index.levels[level][1:]:
            whole = whole.unionByName(other.rows)
        index.levels[level + 1].append(flushed(whole, index.keep))
        index.levels[level] = []
        index.compactions += 1
        level += 1
    return stored(hits, "hits")


def resolved(index: Index, digests: DataFrame) -> DataFrame:
    """(digest, keep_id, n) of the digests (a column; may repeat), merged over all runs of the index."""
    wanted = digests.select("digest").distinct()
    parts = [r.rows.join(wanted, "digest", "left_semi") for level in index.levels for r in level]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    chosen = F.min("keep_id") if index.keep == "smallest" else F.max("keep_id")
    return whole.groupBy("digest").agg(chosen.alias("keep_id"), F.sum("n").alias("n"))


def exact_duplicates(docs: DataFrame, keep: str = "smallest", digest_bits: int = 256, index: Index | None = None) -> DataFrame:
    """A row per row of docs: doc_id, digest, keep_id, group_size, kept.

    docs needs doc_id and text; other columns are not read. keep: which identifier of equal texts stays, "smallest" or
    "largest". digest_bits: digest length; a short one only makes more hits fail verification (for tests). index: an empty
    index to fill, which `add` can take further rows to later.

    Null text counts as the empty text, so null and empty rows are equal. Null doc_id: such a row stays only if all rows
    of its text have none. Repeated rows (same doc_id and text) get the same answer each. An empty table gives no rows.
    """
    index = index or Index()
    index.keep = keep
    rows = stored(docs.select("doc_id", digest_of(whole_text(), digest_bits).alias("digest")), "digests")
    hits = None
    for g in range(GENERATIONS):
        # a generation is a slice of the identifiers, so that copies meet across memtables too
        found = add(index, rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(GENERATIONS)) == g))
        hits = found if hits is None else hits.unionByName(found)
    hits = stored(resolved(index, hits), "hits")
    n_hits, n_rows = hits.count(), rows.count()
    bits = filter_bits(n_hits)
    hit_filter = stored(key_filter(hits, ["digest"], bits), "filter")
    _, single = maybe_in(rows, [F.col("digest")], hit_filter, bits)
    alone = lambda part: part.select("doc_id", "digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))

    texts = docs.select("doc_id", whole_text().alias("body")).withColumn("digest", digest_of(F.col("body"), digest_bits))
    texts, _ = maybe_in(texts, [F.col("digest")], hit_filter, bits)
    passing, _ = maybe_in(rows, [F.col("digest")], hit_filter, bits)
    single = single.unionByName(passing.join(hits, "digest", "left").filter("n is null").select("doc_id", "digest"))  # what the filter let pass wrongly

    # the text of each row that stays: by digest and identifier, so that a hot digest is no hot key
    keeper_filter = key_filter(hits, ["digest", "keep_id"], bits)
    keepers, _ = maybe_in(texts, [F.col("digest"), F.col("doc_id")], keeper_filter, bits)
    keepers = keepers.withColumnRenamed("digest", "d2").join(hits, (F.col("d2") == F.col("digest")) & F.col("doc_id").eqNullSafe(F.col("keep_id")))
    keepers = keepers.groupBy("digest", "keep_id", "n").agg(F.max("body").alias("kept_body"))
    salts = F.when(F.col("n") > max(SALT_ROWS, n_rows // HOT_DIGESTS), F.ceil(F.col("n") / SALT_ROWS).cast("int")).otherwise(1)
    keepers = keepers.select("digest", "keep_id", "n", "kept_body", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    hot = hits.select("digest", salts.alias("salts")).filter("salts > 1")
    members = texts.join(F.broadcast(hot), "digest", "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64("doc_id"), "salts"), F.lit(0)).cast("int"))
    verified = members.join(keepers, ["digest", "salt"]).select("doc_id", "digest", "keep_id", "n", (F.col("body") == F.col("kept_body")).alias("same"))
    verified = stored(verified, "verified")

    collided = verified.filter(~F.col("same")).select("digest").distinct()
    found = alone(single)
    if not collided.take(1):
        found = found.unionByName(verified.select("doc_id", "digest", "keep_id", F.col("n").alias("group_size")))
    else:
        again = texts.join(collided, "digest", "left_semi")
        chosen = F.min("doc_id") if keep == "smallest" else F.max("doc_id")
        groups = again.groupBy("digest", "body").agg(chosen.alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        again = again.join(groups, ["digest", "body"]).select("doc_id", "digest", "keep_id", "group_size")
        right = verified.join(collided, "digest", "left_anti").select("doc_id", "digest", "keep_id", F.col("n").alias("group_size"))
        found = found.unionByName(right).unionByName(again)
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def drop_exact_duplicates(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """docs without the rows whose text another row keeps; all columns of docs, and one row of repeated rows (same doc_id and text).

    Only the lost rows' keys are joined, so texts of other rows are not shuffled.
    """
    found = stored(exact_duplicates(docs, keep).filter("group_size > 1"), "found")
    keys = {"digest": digest_of(whole_text()), "doc_id": F.col("doc_id")}
    once = without(docs, keys, found.filter("not kept").select("digest", "doc_id").distinct())
    repeated = found.filter("kept").groupBy("digest", "doc_id").count().filter("count > 1").select("digest", "doc_id")
    if not repeated.take(1):
        return once
    d, i = own_columns(docs, "digest", "key")
    part = docs.select("*", keys["digest"].alias(d), F.col("doc_id").alias(i)).join(repeated.toDF("rd", "ri"), (F.col(d) == F.col("rd")) & F.col(i).eqNullSafe(F.col("ri")), "left_semi")
    part = part.dropDuplicates([d, i]).select(*[F.col(f"`{c}`") for c in docs.columns])
    return without(once, keys, repeated).unionByName(part)
