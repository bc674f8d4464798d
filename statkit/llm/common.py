"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FILTER_BITS = 27  #: a filter has at most 2 ** FILTER_BITS bits (16 MB), so that its broadcast is bounded
RUN = 64  #: places of a block that `running` folds
PER_KEY = 5  #: and up to there at least 2 ** PER_KEY bits for each key


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir or the context's; in local mode one of our own where both are unset."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (found or _own()).rstrip("/")


@functools.cache
def _own() -> str:
    return tempfile.mkdtemp(prefix="spark-shared-")


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """df written once as a Parquet table in the shared folder and read again: it cuts the lineage and survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(column: str = "text") -> Column:
    """The text; empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def unit_hash(seed: int, *columns: Column) -> Column:
    """A number strictly between 0 and 1 that only depends on seed and columns (53 bits)."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11)
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))


def let(value: Column, of: Callable[[Column], Column]) -> Column:
    """of(value), with value evaluated once however often `of` names it."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def running(values: Column, start: int, step: Callable[[Column, Column], Column]) -> Column:
    """Array by place of what `step` (associative, `start` neutral) makes of the integers before it.

    Folded in blocks of RUN places, these in blocks again: appending copies what a block has so far, never all places
    before, so that the time grows with the number of values (beyond RUN ** 3 places slightly faster).
    """

    def folded(part: Column) -> Column:  # (whole, before)
        nothing = F.struct(F.lit(start).alias("whole"), F.expr("cast(array() as array<int>)").alias("before"))
        return F.aggregate(part, nothing, lambda s, x: F.struct(step(s["whole"], x).alias("whole"), F.concat(s["before"], F.array(s["whole"])).alias("before")))

    def level(array: Column, deep: int) -> Column:
        if not deep:
            return folded(array)["before"]
        starts = F.sequence(F.lit(0), F.floor(F.greatest(F.size(array) - 1, F.lit(0)) / RUN).cast("int"))
        blocks = F.transform(starts, lambda b: folded(F.slice(array, b * RUN + 1, F.lit(RUN))))
        shifted = lambda block, off: F.transform(block["before"], lambda v: step(off, v))
        return let(blocks, lambda bs: F.flatten(F.zip_with(bs, let(F.transform(bs, lambda b: b["whole"]), lambda w: level(w, deep - 1)), shifted)))

    return let(values, lambda v: F.when(F.size(v) <= RUN, folded(v)["before"]).otherwise(level(v, 2)))


CHUNK = 1024


def chunks(text: Column) -> Column:
    """The text cut every CHUNK code points; `piece` reads from it, since a place far into a text takes long to find."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}+"), F.lit(0))


def piece(cut: Column, start: Column, till: Column) -> Column:
    """Code points start (from 0) to till (exclusive) of a text given in chunks; its time grows with till - start only."""
    first = F.floor(start / CHUNK).cast("int")
    some = F.slice(cut, first + 1, F.greatest(F.floor((till - 1) / CHUNK).cast("int") - first + 1, F.lit(0)))
    return F.substring(F.array_join(some, ""), start % CHUNK + 1, F.greatest(till - start, F.lit(0)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def broadcast_if(df: DataFrame, rows: int, most: int = 100_000) -> DataFrame:
    """df marked for broadcast if its known number of rows is at most `most`; else as it is, for a shuffled join."""
    return F.broadcast(df) if rows <= most else df


def own_columns(docs: DataFrame, *names: str) -> list[str]:
    """A name for a helper column for each of `names`, that no column of docs has (names compare without case)."""
    taken = {c.lower() for c in docs.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def filter_bits(n: int) -> int:
    """Bits (a power of 2, as exponent) of a filter of n keys."""
    return min(max((max(n, 1) - 1).bit_length() + PER_KEY, 15), FILTER_BITS)


def key_filter(keys: DataFrame, columns: Sequence[str], bits: int) -> DataFrame:
    """(bucket, bits): a bitmap of 2 ** bits bits with a bit for each key, 4 KB a row; aggregated, never gathered in one task."""
    place = F.pmod(F.xxhash64(*columns), F.lit(1 << bits)) + 1
    return keys.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))


def flagged(rows: DataFrame, keys: Sequence[Column], found: DataFrame, bits: int, mark: str) -> DataFrame:
    """rows with a boolean column `mark`, a name that rows has not: false if the filter `found` (key_filter) certainly lacks a row's key."""
    bucket, bitmap = own_columns(rows, "bucket", "bits")
    place = F.pmod(F.xxhash64(*keys), F.lit(1 << bits)) + 1
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(F.col(bitmap), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    joined = rows.join(F.broadcast(found.toDF(bucket, bitmap)), F.bitmap_bucket_number(place) == F.col(bucket), "left")
    # the byte shifted right by the bit's place, by a power of 2, since a shift takes no column
    set_ = F.col(bucket).isNotNull() & (F.floor(byte / F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (at % 8 + 1).cast("int"))) % 2 == 1)
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], F.coalesce(set_, F.lit(False)).alias(mark))


def maybe_in(rows: DataFrame, keys: Sequence[Column], found: DataFrame, bits: int) -> tuple[DataFrame, DataFrame]:
    """rows that may have a key of the filter `found` (key_filter), and rows that certainly have none; each with rows' columns.

    The filter is broadcast: it has at most 2 ** FILTER_BITS bits. Beyond that many keys it lets more rows pass, so a
    result must not rely on it, only the number of rows that are shuffled afterwards.
    """
    (mark,) = own_columns(rows, "mark")
    marked = flagged(rows, keys, found, bits, mark)
    columns = [F.col(f"`{c}`") for c in rows.columns]
    return marked.filter(F.col(mark)).select(*columns), marked.filter(~F.col(mark)).select(*columns)


def without(docs: DataFrame, keys: dict[str, Column], lost: DataFrame) -> DataFrame:
    """docs without the rows whose keys stand in `lost` (columns as in keys, distinct; null equals null); all columns of docs.

    Only rows that a broadcast filter lets pass are shuffled; the others stay where they are, with their texts.
    """
    n = lost.count()
    if not n:
        return docs
    names = own_columns(docs, *keys)
    bits = filter_bits(n)
    rows = docs.select("*", *[k.alias(c) for c, k in zip(names, keys.values(), strict=True)])
    maybe, rest = maybe_in(rows, [F.col(c) for c in names], key_filter(lost, list(keys), bits), bits)
    other = lost.select(*[F.col(c).alias(f"{n}_lost") for c, n in zip(keys, names, strict=True)])
    same = functools.reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"{c}_lost")) for c in names])
    # no anti join: the optimizer would move it before the filter, and so shuffle all of docs
    (mark,) = own_columns(rows, "lost")
    kept = rest.unionByName(maybe.join(other.withColumn(mark, F.lit(True)), same, "left").filter(F.col(mark).isNull()).select(*[F.col(f"`{c}`") for c in rows.columns]))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
