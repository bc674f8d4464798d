"""Benchmark decontamination with a broadcast hash set of normalised test n-grams.

The benchmark's windows (runs of `width` words; a shorter item is one window) form a set of distinct n-grams, each with its
items. Every document is cut into words once; the hash of each of its windows is looked up in the broadcast set, and a hit
is verified by comparing the words themselves. Only hits and one mark for each document are shuffled, never texts.

The set is broadcast while its measured bytes stay under SET_BYTES. A larger one is joined by a shuffle of the windows that
a bitmap of the set's hashes (of bounded size, broadcast) lets pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, filter_bits, flagged, key_filter, maybe_in, own_columns, stored, whole_text, without

WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
RAW_WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"  #: the same before A-Z are lower-cased
SET_BYTES = 64 << 20  #: a set of windows is broadcast up to here


def words_of(text: Column) -> Column:
    """The text's words: runs of digits, letters and characters from U+0080 on, with A-Z lower-cased."""
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def windows(benchmark: DataFrame, width: int) -> DataFrame:
    """(gram, items, bytes): the distinct windows of all items, each with the sorted ids (as text) of its items.

    benchmark needs item_id and text. Null or wordless texts have no window. Repeated ids are one item. The windows of an
    item without an id count for n_hit, though it is named in no list.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(whole_text()).alias("words")).filter(F.size("words") > 0)
    size = F.least(F.size("words"), F.lit(width))
    grams = items.select("item", F.explode(F.transform(F.sequence(F.lit(1), F.size("words") - size + 1), lambda i: F.slice("words", i, size))).alias("gram"))
    grams = grams.groupBy("gram").agg(F.sort_array(F.collect_set("item")).alias("items"))
    length = lambda a: F.octet_length(F.array_join(a, " ")) + 32 * F.size(a)
    return grams.withColumn("bytes", (length("gram") + length("items")).cast("long"))


def _places(docs: DataFrame, grams: DataFrame, width: int) -> DataFrame:
    """(row, doc_id, k1, k2, n_words, place, items): a mark for each row of docs (place null), and each place of a window.

    place = start * (width + 1) + size of the window. k1 and k2 are hashes of the text.
    """
    bytes_, n, sizes = grams.agg(F.sum("bytes"), F.count(F.lit(1)), F.sort_array(F.collect_set(F.size("gram")))).first()  # at most `width` sizes
    rows = docs.select("doc_id", whole_text().alias("body"))
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64(F.lit(1), "body").alias("k1"), F.xxhash64(F.lit(2), "body").alias("k2"), words_of(F.col("body")).alias("words"))
    nothing = F.expr("cast(array() as array<bigint>)")
    hashes = lambda size: F.when(F.size("words") >= size, F.transform(F.sequence(F.lit(1), F.size("words") - (size - 1)), lambda i: F.xxhash64(F.slice("words", i, size)))).otherwise(nothing)
    rows = rows.select("*", F.concat(F.array(F.xxhash64("row")), *[hashes(size) for size in sizes]).alias("hashes"))
    # the first one is the mark, so no array is empty; _outer, or a filter on the arrays' sizes would form them a second time
    rows = rows.select("row", "doc_id", "k1", "k2", "words", F.posexplode_outer("hashes").alias("at", "hash"))
    size, start = F.lit(1), F.lit(0)
    for s in reversed(sizes):  # where the hashes of each size begin
        first = F.lit(1)
        for t in sizes[: sizes.index(s)]:
            first = first + F.greatest(F.size("words") - (t - 1), F.lit(0))
        last = first + F.greatest(F.size("words") - (s - 1), F.lit(0))
        size = F.when(F.col("at").between(first, last - 1), F.lit(s)).otherwise(size)
        start = F.when(F.col("at").between(first, last - 1), F.col("at") - first).otherwise(start)
    small = grams.select("gram", "items", F.xxhash64("gram").alias("set_hash"))
    if (bytes_ or 0) <= SET_BYTES:
        small = F.broadcast(small)
    else:
        bits = filter_bits(n)
        (mark,) = own_columns(rows, "mark")
        rows = flagged(rows, [F.col("hash")], key_filter(small, ["set_hash"], bits), bits, mark).filter(F.col(mark) | (F.col("at") == 0))
    # joined by the hash alone, a long; what it finds is verified afterwards, so that words are compared for hits only
    hit = (F.col("at") > 0) & (F.slice("words", start + 1, size) == F.col("gram"))
    found = rows.join(small, F.col("hash") == F.col("set_hash"), "left").filter((F.col("at") == 0) | hit)
    place = F.when(F.col("at") > 0, start.cast("long") * (width + 1) + size)
    return found.select("row", "doc_id", "k1", "k2", F.size("words").alias("n_words"), place.alias("place"), F.when(F.col("at") > 0, F.col("items")).alias("items"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """A row per row of docs: doc_id, k1, k2, n_words, n_hit, n_items, items, places.

    docs needs doc_id and text; benchmark item_id and text. n_hit: words inside a place of a window; items: sorted ids (as
    text) of the items with such a place, n_items their number; places: start * (width + 1) + size of each window found,
    in words from 0. k1 and k2: hashes of the text.

    Null and empty texts have no words. Null doc_id and repeated rows are rows like any other. An empty benchmark hits
    nothing; an empty table gives no rows. Other columns are not read. A row's places are one value: a document's own size.
    """
    found = _places(docs, stored(windows(benchmark, width), "windows"), width)
    found = found.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("k1").alias("k1"), F.first("k2").alias("k2"), F.max("n_words").cast("long").alias("n_words"),
        F.sort_array(F.collect_set("place")).alias("places"), F.collect_set("items").alias("items"),
    )
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))

    def step(s: Column, place: Column) -> Column:
        begin = F.floor(place / (width + 1))
        end = begin + place % (width + 1)
        return F.struct(F.greatest(s["end"], end).alias("end"), (s["n"] + F.greatest(end - F.greatest(begin, s["end"]), F.lit(0))).alias("n"))

    items = F.array_sort(F.array_distinct(F.flatten("items")))
    return found.select("doc_id", "k1", "k2", "n_words", F.aggregate("places", start, step, lambda s: s["n"]).alias("n_hit"), items.alias("items"), "places").withColumn("n_items", F.size("items").cast("long"))


def hit_runs(places: Column, width: int) -> Column:
    """Array of (start, till) in words: the maximal runs of words that the places cover, in order."""
    words = F.sort_array(F.array_distinct(F.flatten(F.transform(places, lambda p: F.sequence(F.floor(p / (width + 1)), F.floor(p / (width + 1)) + p % (width + 1) - 1)))))
    firsts = F.filter(words, lambda w, i: F.coalesce(F.get(words, i - 1) != w - 1, F.lit(True)))
    lasts = F.filter(words, lambda w, i: F.coalesce(F.get(words, i + 1) != w + 1, F.lit(True)))
    return F.zip_with(firsts, lasts, lambda a, b: F.struct(a.cast("int").alias("start"), (b + 1).cast("int").alias("till")))


def remove_leaks(docs: DataFrame, benchmark: DataFrame, width: int = 10, action: str = "spans", most: float = 0.0) -> DataFrame:
    """docs without what the benchmark has; all columns of docs.

    action "documents": documents go of whose words more than the share `most` is hit. action "spans": each run of hit words
    is cut out of the text, with what stands between its words and before its first one; the rest of the text stays as it is.
    Documents without a hit stay where they are, untouched. Nulls, repeated and empty rows: as in find_leaks.
    """
    if action not in ("spans", "documents"):
        raise ValueError(f"action is spans or documents, not {action}")
    found = find_leaks(docs, benchmark, width).filter(F.col("n_hit") > F.col("n_words") * F.lit(float(most) if action == "documents" else 0.0))
    keys = {"doc_id": F.col("doc_id"), "k1": F.xxhash64(F.lit(1), whole_text()), "k2": F.xxhash64(F.lit(2), whole_text())}
    if action == "documents":
        return without(docs, keys, stored(found.select(*keys).distinct(), "leaks"))
    found = stored(found.select(*keys, hit_runs(F.col("places"), width).alias("runs")).dropDuplicates(list(keys)), "leaks")
    n = found.count()
    if not n:
        return docs
    bits = filter_bits(n)
    names = own_columns(docs, "leak_id", "leak_k1", "leak_k2")
    rows = docs.select("*", *[k.alias(c) for c, k in zip(names, keys.values(), strict=True)])
    maybe, rest = maybe_in(rows, [F.col(c) for c in names], key_filter(found, list(keys), bits), bits)
    on = [F.col(name).eqNullSafe(F.col(f"{name}_found")) for name in names]
    (runs,) = own_columns(rows, "runs")
    other = found.select(*[F.col(k).alias(f"{name}_found") for k, name in zip(keys, names, strict=True)], F.col("runs").alias(runs))
    maybe = maybe.join(other, on[0] & on[1] & on[2], "left")
    words, gaps = F.regexp_extract_all("text", F.lit(RAW_WORD), F.lit(0)), F.split("text", RAW_WORD, -1)
    (pieces,) = own_columns(maybe, "pieces")
    maybe = maybe.withColumn(pieces, F.when(F.col(runs).isNotNull(), F.zip_with(words, gaps, lambda w, g: F.concat(g, F.coalesce(w, F.lit(""))))))
    ends = F.concat(F.transform(runs, lambda r: r["start"]), F.array(F.size(pieces)))  # what stays: from the end of a run to the start of the next; the last gap too
    begins = F.concat(F.array(F.lit(0)), F.transform(runs, lambda r: r["till"]))
    kept = F.array_join(F.flatten(F.zip_with(begins, ends, lambda a, b: F.slice(pieces, a + 1, F.greatest(b - a, F.lit(0))))), "")
    text = F.when(F.col(runs).isNull(), F.col("text")).otherwise(kept)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    cut = maybe.select(*[text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])
    return rest.select(*columns).unionByName(cut)
