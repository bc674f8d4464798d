"""MinHash near-dedup with circulant signatures.

One pass over the texts makes, for each document, the set of its word shingles, a digest of the set, and a circulant
MinHash signature: a first permutation of the 64-bit shingle codes, then coordinate k is the smallest value of a second
permutation of the code shifted by k. Documents with the same set are one class from there on. Signatures are cut into
bands; classes that share a band are candidates, and each link is confirmed on the full sets.

A bucket's pairs are never emitted. First each bucket's smallest member is compared with its others, which collapses
groups of near copies, and components are joined. Buckets that still hold several components get a second look. Large ones
are cut by prefix filtering: shingles are ordered, rare ones first, and linked sets always share one of the first
n - ceil(similarity * n) + 1 of theirs, whatever the order is; so members meet by these shingles, and unlike documents of a
common template, whose rare shingles are their own, do not meet at all. Short lists of a shingle give pairs, each compared
once; long lists of the same members are one. Small buckets and long lists are compared in full, in blocks: members are cut into classes of similar set sizes and these into chunks of bounded weight, by hash; each pair of
chunks meets in a task of bounded size, where all intersections come from a matrix product, and only a spanning forest of
the links leaves the task. So no link between different texts is lost to a cap, and no bucket is ordered in one task. Star
pairs whose set sizes exclude a link are not loaded, nor are those of buckets that get this second look whose signatures
agree in far too few coordinates for a link (SLACK standard deviations: 1 to 2 links in 10 ** 8 at the threshold, by
the binomial distribution).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, without
from .components import connected

BLOCK = 1 << 16  #: expected weight of a chunk at most, but for a single longer text; a text weighs as much as it has shingles, LEAST,
LEAST = 128  #: or an eighth of its bytes, whichever is most. So a chunk has about BLOCK / LEAST members and 8 * BLOCK bytes at most
CELLS = 1 << 15  #: values that a signature works on at a time, so that they stay in a core's cache
HOT = 256  #: members beyond which a bucket is cut by its members' rare shingles; either way no link of the bucket is lost
LIST = 16  #: members up to which a shingle's list gives pairs
BINS = 1 << 18  #: counters of shingles, by code, that rare ones are told by; they set the order only, and are the driver's 2 MB whatever the input
SLACK = 6.0  #: standard deviations below the expected number of equal coordinates of a just linked pair
SHINGLE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)  #: odd multipliers of a shingle's words


def mixed(x: np.ndarray, a: int, b: int) -> np.ndarray:
    """A permutation of the 64-bit numbers (each step can be undone)."""
    x = x * np.uint64(a)
    x ^= x >> np.uint64(32)
    x *= np.uint64(b)
    x ^= x >> np.uint64(29)
    return x


class Words(dict):
    """Codes of words (64 bits), kept for reuse: at most MOST words of at most LONG bytes, so its memory is bounded; empties itself when full."""

    MOST, LONG = 150_000, 48

    def __missing__(self, word: bytes) -> int:
        code = xxhash.xxh3_64_intdigest(word)
        if len(word) <= self.LONG:
            if len(self) >= self.MOST:
                self.clear()
            self[word] = code
        return code


def shingle_codes(text: str | None, width: int, codes: Words) -> np.ndarray:
    """Sorted distinct codes of a text's word shingles; A-Z is lower-cased; a shorter text is one shingle; no words: none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # on bytes both lower and split know ASCII only
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(codes.__getitem__, words), np.uint64, len(words))
    n = min(width, len(w))
    total = np.zeros(len(w) - n + 1, np.uint64)
    for i in range(n):
        total += mixed(w[i : len(w) - n + 1 + i], SHINGLE[i % 5] + 2 * (i // 5), 0xD6E8FEB86659FD93)
    total += np.uint64(n if n < width else 0)
    return np.unique(mixed(total, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53))


def signature(codes: np.ndarray, size: int) -> np.ndarray:
    """Circulant MinHash: sigma once, then for each k the smallest pi(sigma(code) + k step); some coordinates at a time, CELLS values at most where a set has fewer."""
    first = mixed(codes, 0x9FB21C651E98DF25, 0xA0761D6478BD642F)  # sigma
    turns = np.arange(size, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D)  # the circle is walked in steps of an odd number
    out = np.empty(size, np.uint64)
    many = max(CELLS // len(first), 1)
    for k in range(0, size, many):
        room = first + turns[k : k + many, None]
        room *= np.uint64(0xE7037ED1A0B428DB)  # pi
        room ^= room >> np.uint64(31)
        room *= np.uint64(0x8EBC6AF09C88C6E3)
        room.min(axis=1, out=out[k : k + many])
    return out


def _sketches(width: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Words()
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            n, digests, keys, short = [], [], [], []
            for text in texts:
                s = shingle_codes(text.as_py(), width, codes)
                n.append(len(s))
                if not len(s):
                    digests.append(None)
                    keys.append(None)
                    short.append(None)
                    continue
                digests.append(xxhash.xxh3_128_digest(s.tobytes()))
                sig = signature(s, bands * rows).reshape(bands, rows)
                short.append((sig & np.uint64(255)).astype(np.uint8).tobytes())
                keys.append([xxhash.xxh3_64_intdigest(bytes([b & 255, b >> 8]) + sig[b].tobytes()) - (1 << 63) for b in range(bands)])
            yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(short, pa.binary())], names=["doc_id", "n_shingles", "digest", "bands", "short"])

    return run


def _likely(least: int):
    """Of rows (left, right, left signature, right signature), one byte a coordinate: pairs that agree in `least` places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for i in (2, 3))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array((x == y).sum(axis=1) >= least))

    return run


def _links(width: int, percent: int):
    """Of rows (left, right, left text, right text), sorted by left: the linked pairs, by full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, held, held_id = Words(), None, None
        for batch in batches:
            left, right = [], []
            for a, b, x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if a != held_id:
                    held, held_id = shingle_codes(x.as_py(), width, codes), a
                other = shingle_codes(y.as_py(), width, codes)  # one pair's texts at a time
                small, large = sorted((len(held), len(other)))
                if 100 * small < percent * large:
                    continue
                both = len(np.intersect1d(held, other, assume_unique=True))
                if 100 * both >= percent * (small + large - both):
                    left.append(a)
                    right.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return run


def common(sets: list[np.ndarray]) -> np.ndarray:
    """The sizes of all intersections: codes that many sets hold by a matrix product, the others by counting pairs."""
    m = len(sets)
    codes = np.concatenate(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    order = np.argsort(codes, kind="stable")
    codes, owner = codes[order], owner[order]
    first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    df = np.diff(np.append(first, len(codes)))
    out = np.zeros((m, m))
    many = np.flatnonzero(df > 8)
    for at in range(0, len(many), 4096):
        part = many[at : at + 4096]
        x = np.zeros((m, len(part)), np.float32)
        rows = np.concatenate([owner[first[c] : first[c] + df[c]] for c in part])
        x[rows, np.repeat(np.arange(len(part)), df[part])] = 1
        out += x @ x.T
    for n in range(2, 9):
        places = first[df == n]
        for a in range(n):
            for b in range(a + 1, n):
                out += np.bincount(owner[places + a] * m + owner[places + b], minlength=m * m).reshape(m, m)
    return np.maximum(out, out.T)


def _blocks(width: int, percent: int):
    """Of a block (head, root, body): a spanning forest of the links between its members of different components."""

    def run(block: pa.Table) -> pa.Table:
        heads, at = np.unique(block.column("head").to_numpy(), return_index=True)
        roots = block.column("root").to_numpy()[at]
        codes, texts = Words(), block.column("body")
        sets = [shingle_codes(texts[int(i)].as_py(), width, codes) for i in at]
        size = np.array([len(s) for s in sets])
        both = common(sets)
        near = (100 * both >= percent * (size[:, None] + size[None, :] - both)) & (roots[:, None] != roots[None, :])
        label = np.arange(len(heads))
        while True:
            low = np.minimum(label, np.where(near, label[None, :], len(heads)).min(axis=1, initial=len(heads)))
            low = low[low]
            if (low == label).all():
                break
            label = low
        moved = np.flatnonzero(label != np.arange(len(heads)))
        return pa.table({"a": pa.array(heads[moved], pa.int64()), "b": pa.array(heads[label[moved]], pa.int64())})

    return run


def _counts(width: int):
    """Of texts: how many sets hold a code of each bin (bin, n); the sums of one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, total = Words(), np.zeros(BINS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                np.add.at(total, (shingle_codes(text.as_py(), width, codes) % np.uint64(BINS)).astype(np.int64), 1)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], names=["bin", "n"])

    return run


def prefix(codes: np.ndarray, held: np.ndarray, percent: int) -> np.ndarray:
    """The rarest codes of a set by the counters `held`, ties by code: so many that a linked set must hold one among its own."""
    n = len(codes)
    order = np.lexsort((codes, held[(codes % np.uint64(len(held))).astype(np.int64)]))
    return codes[order[: n + (-percent * n // 100) + 1]]


def _prefixes(width: int, percent: int, held: np.ndarray):
    """Of rows (head, root, size, body): (band, head, root, size), a row for each code of the set's prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Words()
        for batch in batches:
            for i, text in enumerate(batch.column(3)):
                first = prefix(shingle_codes(text.as_py(), width, codes), held, percent)
                same = [np.full(len(first), batch.column(c)[i].as_py(), np.int64) for c in range(3)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (first.view(np.int64), *same)], names=["band", "head", "root", "size"])

    return run


def _rare_lists(members: DataFrame, roots: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """(band, head, root, size, n): the members of hot open buckets by their sets' rare shingles; lists of one component are left out.

    Each member's text meets its component and size before it is cut, so no row of a shingle is joined for them.
    """
    here = members.filter(F.col("n") > HOT).join(roots.withColumnRenamed("node", "head"), "head", "left").withColumn("root", F.coalesce("root", "head"))
    parted = here.groupBy("band").agg(F.min("root").alias("least"), F.max("root").alias("most")).filter("least <> most")
    here = here.join(parted.select("band"), "band", "left_semi").groupBy("head").agg(F.min("root").alias("root"), F.min("size").alias("size"))
    bodies = stored(texts.join(here, "head").select("head", "root", "size", "body"), "hot", compression="zstd")
    held = np.zeros(BINS, np.int64)
    for r in bodies.select("body").mapInArrow(_counts(width), "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect():
        held[r["bin"]] = r["n"]
    lists = stored(bodies.mapInArrow(_prefixes(width, percent, held), "band long, head long, root long, size long"), "prefixes")
    sums = [F.sum(F.xxhash64(F.lit(i), "head").cast("decimal(38,0)")).alias(f"sum{i}") for i in (0, 1)]
    many = lists.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("least"), F.max("root").alias("most"), *sums).filter("least <> most")
    once = many.groupBy("n", "least", "most", "sum0", "sum1").agg(F.min("band").alias("band")).select("band", "n")  # lists of the same members
    return stored(lists.join(once, "band"), "lists")


def _list_pairs(lists: DataFrame) -> DataFrame:
    """(a, b): the pairs of short lists, of different components, once each."""
    short = lists.filter(F.col("n") <= LIST).groupBy("band").agg(F.collect_list(F.struct("head", "root")).alias("all"))
    one = short.select(F.explode("all").alias("x"), "all").select("x", F.explode("all").alias("y")).filter("x.head < y.head and x.root <> y.root")
    return one.select(F.col("x.head").alias("a"), F.col("y.head").alias("b")).distinct()


def _star_links(members: DataFrame, classes: DataFrame, texts: DataFrame, width: int, percent: int, coordinates: int) -> DataFrame:
    """Links between each bucket's smallest member and its others. Pairs of buckets that have no second look (two members) are all compared."""
    pairs = members.filter("head <> low").select(F.col("low").alias("a"), F.col("head").alias("b"), F.col("size").alias("nb"), (F.col("n") == 2).alias("only"))
    pairs = pairs.groupBy("a", "b").agg(F.max("nb").alias("nb"), F.max("only").alias("only"))
    return _checked(pairs, classes, texts, width, percent, coordinates)


def _checked(pairs: DataFrame, classes: DataFrame, texts: DataFrame, width: int, percent: int, coordinates: int) -> DataFrame:
    """Of pairs (a, b, size of b's set, whether to compare them whatever the signatures say): the linked ones."""
    sketches = classes.select("head", "size", F.col("s.short").alias("short"))
    pairs = pairs.join(sketches.toDF("a", "na", "sa"), "a").filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    pairs = stored(pairs.join(sketches.drop("size").toDF("b", "sb"), "b").select("a", "b", "sa", "sb", "only"), "pairs")
    linked = percent / 100
    least = int(coordinates * linked - SLACK * (coordinates * linked * (1 - linked)) ** 0.5)
    likely = pairs.filter("not only").select("a", "b", "sa", "sb").mapInArrow(_likely(least), "a long, b long")
    pairs = likely.unionByName(pairs.filter("only").select("a", "b"))
    loaded = pairs.join(texts.toDF("b", "right"), "b").join(texts.toDF("a", "left"), "a")
    return loaded.select("a", "b", "left", "right").mapInArrow(_links(width, percent), "a long, b long")


def _block_links(members: DataFrame, roots: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links inside the buckets that still hold several components, in blocks.

    Linked sets' sizes differ by no more than the similarity, so a bucket is cut by size into classes, and a member meets
    those of its own and the two neighbouring classes. A class is dealt into chunks by hash; each pair of chunks is a block.
    """
    here = members.join(roots.withColumnRenamed("node", "head"), "head", "left").withColumn("root", F.coalesce("root", "head"))
    parted = here.groupBy("band").agg(F.min("root").alias("least"), F.max("root").alias("most")).filter("least <> most")
    here = here.select("band", "head", "root", "size").join(parted.select("band"), "band", "left_semi")
    weights = texts.select("head", (F.octet_length("body") / 8).cast("long").alias("bytes"))
    step = math.log(100 / percent) * (1 + 1e-9) if percent < 100 else 1e-9  # a little more, so that rounding parts no linked pair
    here = here.join(weights, "head").withColumn("class", F.floor(F.log(F.col("size").cast("double")) / F.lit(step)).cast("long"))
    here = stored(here.withColumn("weight", F.greatest("size", F.lit(LEAST), "bytes")), "open")
    classes = stored(here.groupBy("band", "class").agg(F.ceil(F.sum("weight") / BLOCK).alias("chunks")), "classes")
    own = here.join(classes, ["band", "class"]).withColumn("chunk", F.pmod(F.xxhash64("head"), "chunks"))
    own = own.select("band", "head", "root", F.struct("class", "chunk").alias("own"), F.explode(F.array(*[F.col("class") + d for d in (-1, 0, 1)])).alias("class"))
    meets = own.join(classes, ["band", "class"]).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    meets = meets.withColumn("other", F.struct("class", "chunk")).select("band", "head", "root", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))
    # blocks of one component, of a class alone or not, need no texts
    mixed_ = meets.groupBy("band", "x", "y").agg(F.min("root").alias("least"), F.max("root").alias("most")).filter("least <> most").select("band", "x", "y")
    blocks = meets.join(mixed_, ["band", "x", "y"]).join(texts, "head")
    return blocks.groupBy("band", "x", "y").applyInArrow(_blocks(width, percent), "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, bands: int = 24, rows: int = 4) -> DataFrame:
    """A row per row of docs: doc_id, n_shingles, component_id, kept.

    docs needs doc_id (an integer, unique where not null) and text. Two documents are linked if the Jaccard similarity of
    their sets of `width`-word shingles is at least percent / 100; component_id is the smallest doc_id reachable over links.
    A pair of similarity s shares a band with probability 1 - (1 - s ** rows) ** bands: at 0.85 and 24 bands of 4 all but
    2 in 10 ** 8, at 0.8 all but 4 in 10 ** 6.

    A text of fewer words is one shingle. Null text, empty text and text without words have no shingles and are linked with
    nothing. Rows with null doc_id have null component_id and are kept; they link nothing. Repeated rows (same doc_id and
    text) get the same answer each. An empty table gives no rows.
    """
    sketch = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_sketches(width, bands, rows), "doc_id long, n_shingles long, digest binary, bands array<long>, short binary")
    sketch = stored(sketch, "sketches")
    sets = sketch.filter("doc_id is not null and digest is not null")
    classes = stored(sets.groupBy("digest").agg(F.min("doc_id").alias("head"), F.min_by(F.struct("bands", "short"), "doc_id").alias("s"), F.min("n_shingles").alias("size")), "classes")
    keys = classes.select("head", "size", F.explode("s.bands").alias("band"))
    shared = stored(keys.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("head").alias("low")).filter("n > 1"), "bands")
    members = stored(keys.join(shared, "band"), "members")
    roots = None
    if members.take(1):
        texts = docs.select(F.col("doc_id").cast("long").alias("head"), F.col("text").alias("body")).join(members.select("head").distinct(), "head", "left_semi")
        texts = stored(texts.dropDuplicates(["head"]), "texts", compression="zstd")
        links = stored(_star_links(members, classes, texts, width, percent, bands * rows), "links")
        roots = stored(connected(links), "roots")
        second = members.filter(F.col("n").between(3, HOT)).select("band", "head", "size")
        if members.filter(F.col("n") > HOT).take(1):
            lists = _rare_lists(members, roots, texts, width, percent)
            pairs = _list_pairs(lists).join(classes.select(F.col("head").alias("b"), F.col("size").alias("nb")), "b")
            links = stored(links.unionByName(_checked(pairs.withColumn("only", F.lit(False)), classes, texts, width, percent, bands * rows)), "links")
            roots = stored(connected(links), "roots")
            second = second.unionByName(lists.filter(F.col("n") > LIST).select("band", "head", "size"))
        more = stored(_block_links(second, roots, texts, width, percent), "links")
        if more.take(1):
            roots = stored(connected(links.unionByName(more)), "roots")

    labels = classes.select("digest", "head")
    if roots is not None:
        labels = labels.join(roots.withColumnRenamed("node", "head"), "head", "left")
        labels = labels.select("digest", F.coalesce("root", "head").alias("root"))
    else:
        labels = labels.select("digest", F.col("head").alias("root"))
    out = sketch.select("doc_id", "n_shingles", "digest").join(labels, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """docs without the rows whose component a smaller doc_id stands for; all columns of docs. Rows with null doc_id stay."""
    lost = stored(near_duplicates(docs, width, percent).filter("not kept").select("doc_id").distinct(), "lost")
    return without(docs, {"doc_id": F.col("doc_id").cast("long")}, lost)
