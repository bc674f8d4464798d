"""Best-fit packing by a configuration linear program.

Documents are tokenized once, in tasks; pieces keep their length only. The histogram of lengths (one row per length, so at
most as many as a sequence is long) goes to the driver. There a covering program over configurations (multisets of lengths
that fit into a sequence) is solved by multiplicative weights: a length's price falls exponentially with its coverage, and
a knapsack dynamic program over the prices gives the next configuration. The fractional solution is rounded down, and what
is left is placed best fit, longest first, into the room left and then into new sequences, in runs of equal configurations
(never piece by piece). Each piece then finds its place by its rank among the pieces of its length.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if, stored

SALT_ROWS = 1 << 18  #: about so many pieces of one length are ranked in one task
WORDS = 250_000  #: entries of each of the two generations of a task's word cache
LONG = 48  #: characters of a word that is kept at most; so the caches' memory is bounded
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")  #: the vocabulary's own split, for characters below U+0250
ODD = re.compile(r"<\||[\x1c-\x1f]")  #: texts with these go through the tokenizer whole
NUMBERS = frozenset("²³¹¼½¾")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordTokenizer:
    """Token ids of texts as little-endian unsigned 32-bit bytes, for a vocabulary that drops white space.

    No token spans white space, so a text's ids are those of its words, which repeat and are cached. Words of plain Latin
    letters go to the model at once; any other word goes through the whole tokenizer.
    """

    def __init__(self, path: str, words: int | None = None):
        from tokenizers import Tokenizer

        self.whole, self.most = Tokenizer.from_file(path), words or WORDS
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves in byte-level vocabularies
        rest = [b for b in range(256) if b not in plain]
        self.letters = [chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)]

    def full(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def piece(self, part: str) -> bytes:
        found = self.young.get(part) or self.old.get(part)
        if found is None:
            shown = "".join([self.letters[b] for b in part.encode()])
            found = np.array([t.id for t in self.whole.model.tokenize(shown)], dtype="<u4").tobytes()
            if len(part) <= LONG:
                self.young[part] = found
        return found

    def word(self, word: str) -> bytes:
        found = self.old.get(word)
        if found is None:
            low = word.lower()
            if not low.isascii() and (max(low) >= "ɐ" or max(word) >= "ɐ" or not NUMBERS.isdisjoint(low) or not unicodedata.is_normalized("NFC", word)):
                found = self.full(word)
            elif low.isalpha():
                found = self.piece(low)
            else:
                found = b"".join([self.piece(p) for p in PARTS.findall(low)])
        if len(self.young) >= self.most:
            self.old, self.young = self.young, {}
        if len(word) <= LONG:
            self.young[word] = found
        return found

    def __call__(self, text: str) -> bytes:
        if ODD.search(text):
            return self.full(text)
        get, word = self.young.get, self.word
        out = []
        for w in text.split():
            found = get(w)
            if found is None:
                found = word(w)
                get = self.young.get
            out.append(found)
        return b"".join(out)


def _pieces(path: str, most: int, end: int, with_ids: bool, words: int | None = None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, last = WordTokenizer(path, words), end.to_bytes(4, "little")
        for batch in batches:
            rows: list[list] = [[], [], [], [], [], []]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "") + last
                for k, at in enumerate(range(0, len(ids), 4 * most)):
                    part = ids[at : at + 4 * most]
                    for column, value in zip(rows, (doc, k, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    return run


def best_configuration(prices: np.ndarray, capacity: int) -> np.ndarray:
    """The knapsack dynamic program: copies of each length (1 to len(prices)) of the dearest multiset that fits."""
    lengths = np.flatnonzero(prices > 0) + 1
    p = prices[lengths - 1]
    value, taken = np.zeros(capacity + 1), np.zeros(capacity + 1, dtype=np.int64)
    for c in range(1, capacity + 1):
        k = np.searchsorted(lengths, c, side="right")
        value[c] = value[c - 1]
        if k:
            sums = value[c - lengths[:k]] + p[:k]
            j = int(sums.argmax())
            if sums[j] > value[c]:
                value[c], taken[c] = sums[j], lengths[j]
    out, c = np.zeros(len(prices), dtype=np.int64), capacity
    while c > 0:
        if taken[c]:
            out[taken[c] - 1] += 1
            c -= taken[c]
        else:
            c -= 1
    return out


def solve(counts: np.ndarray, capacity: int, rounds: int, step: float = 0.5) -> list[tuple[int, list[tuple[int, int]]]]:
    """Runs of equal sequences: (how many, [(length, copies), ...] by falling length). counts[i]: pieces of length i + 1."""
    left, runs = counts.astype(np.int64).copy(), []
    if left[capacity - 1]:
        runs.append((int(left[capacity - 1]), [(capacity, 1)]))
        left[capacity - 1] = 0
    total, shares, cover = left.copy(), [], np.zeros(capacity)
    for _ in range(rounds if left.sum() > 1 else 0):
        prices = np.where(total > 0, np.exp(-cover) / np.maximum(total, 1), 0.0) * np.arange(1, capacity + 1)
        config = best_configuration(prices, capacity)
        used = config > 0
        amount = step * (total[used] / config[used]).min()
        cover[used] += amount * config[used] / total[used] / step
        shares.append((amount, config))
    scale = 1 / max((sum(a * (c * np.arange(1, capacity + 1)).sum() for a, c in shares) / max((total * np.arange(1, capacity + 1)).sum(), 1)), 1e-9) if shares else 1.0
    room: dict[int, list] = {}
    for amount, config in sorted(shares, key=lambda s: -s[0]):
        used = config > 0
        many = min(int(amount * min(scale, 1 / step) + 0.5), int((left[used] // config[used]).min()))
        if many:
            left[used] -= many * config[used]
            shape = [(int(i) + 1, int(config[i])) for i in np.flatnonzero(used)[::-1]]
            room.setdefault(capacity - sum(n * k for n, k in shape), []).append((many, shape))
    for length in range(capacity - 1, 0, -1):
        n = int(left[length - 1])
        while n:
            r = min((r for r in room if r >= length), default=None)
            if r is None:
                k = capacity // length
                new = [(n // k, k)] if n >= k else []
                new += [(1, n % k)] if n % k else []
                for many, copies in new:
                    room.setdefault(capacity - length * copies, []).append((many, [(length, copies)]))
                break
            many, shape = room[r].pop()
            if not room[r]:
                del room[r]
            k = r // length
            full = min(many, n // k)
            if full:
                room.setdefault(r - length * k, []).append((full, [*shape, (length, k)]))
                n, many = n - full * k, many - full
            if many and n:  # fewer pieces than one sequence has room for
                room.setdefault(r - length * n, []).append((1, [*shape, (length, n)]))
                n, many = 0, many - 1
            if many:
                room.setdefault(r, []).append((many, shape))
    return runs + [x for r in sorted(room) for x in room[r]]


def places(runs: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, copies a sequence, offset), by length and rank."""
    rows, rank, base = [], {}, 0
    for many, shape in runs:
        at = 0
        for length, copies in shape:
            first = rank.get(length, 0)
            rows.append((length, first, base, copies, at))
            rank[length] = first + many * copies
            at += length * copies
        base += many
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def _placed(table: np.ndarray):
    keys = (table[:, 0] << 44) | table[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("length", "rank"))
            row = table[np.searchsorted(keys, (length << 44) | rank, side="right") - 1]
            nth = rank - row[:, 1]
            columns = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != "rank"]
            names = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(row[:, 2] + nth // row[:, 3]), pa.array(row[:, 4] + nth % row[:, 3] * length)], names=[*names, "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, capacity: int = 2048, path: str | None = None, end: int = 0, rounds: int = 300, with_ids: bool = False, words: int | None = None) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids, little-endian bytes, if wanted).

    docs needs doc_id (an integer) and text. A document's ids end with `end`; one longer than `capacity` is cut into pieces
    of `capacity` and a rest. path: the vocabulary's file, on every machine. rounds: configurations that the linear program
    is solved with (the driver's work, whatever the input's size). words: entries of a task's word caches, WORDS if not given;
    fewer take less memory and more time, the result is the same.

    Null and empty texts are one piece that holds `end` only. Null doc_id and repeated rows are documents like any other.
    An empty table gives no rows.
    """
    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(_pieces(path or vocabulary_path(), capacity, end, with_ids, words), "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")
    deal = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 30)).cast("int").alias("deal")  # written, since a second scan may number rows otherwise
    pieces = stored((pieces if with_ids else pieces.drop("ids")).select("*", deal), "pieces")
    keep = [c for c in pieces.columns if c != "deal"]
    # a piece that fills a sequence has it for itself: its number needs no rank
    full = pieces.filter(F.col("length") == capacity).select(*keep, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = pieces.filter(F.col("length") < capacity)
    counts = np.zeros(capacity, dtype=np.int64)
    for row in rest.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():  # at most `capacity` rows
        counts[row["length"] - 1] = row["n"]
    salts = F.element_at(F.array(*[F.lit(int(n)) for n in salts_of(counts)]), F.col("length").cast("int"))
    salted = rest.withColumn("salt", F.col("deal") % salts)
    parts = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("length", "salt", before.alias("before"))  # a row for SALT_ROWS pieces of a length, one at least
    ranked = salted.withColumn("nth", F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")))
    ranked = ranked.join(broadcast_if(parts, int(salts_of(counts).sum())), ["length", "salt"]).withColumn("rank", F.col("nth") + F.col("before") - 1)
    kinds = ", ".join(f"{n} {t}" for n, t in pieces.dtypes if n != "deal")
    placed = ranked.select(*keep, "rank").mapInArrow(_placed(places(solve(counts, capacity, rounds))), f"{kinds}, sequence_id long, offset long")
    return placed.unionByName(full)


def salts_of(counts: np.ndarray) -> np.ndarray:
    """Tasks that the pieces of each length are dealt to for ranking: by their number, so that no task's share grows with the input."""
    return np.maximum(-(-counts // SALT_ROWS), 1)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ids (little-endian bytes) of each sequence, from pack(..., with_ids=True); a sequence is bounded by the capacity."""
    by = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return by.select("sequence_id", F.aggregate("parts", F.unhex(F.lit("")), lambda out, x: F.concat(out, x["ids"])).alias("ids"))
