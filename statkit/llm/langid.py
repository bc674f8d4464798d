"""Language identification by rank-order n-gram profiles.

A profile is a language's most frequent character n-grams (of 1 to 3 characters, words padded with a space) in falling
order; a document's own ranks are compared with each profile by the out-of-place distance, and an n-gram that a profile
lacks costs the profile's length. Profiles come from a bounded sample of labelled documents; every whole document is scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if, stored, unit_hash

UNKNOWN = "und"
BASE = 1 << 21  #: code points fit below; an n-gram is a number in this base

LANGUAGES = 1000  #: distinct languages that are learned at most


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams (numbers below BASE ** 3) of a text's letters and their counts; whatever is no letter is a word break."""
    low = text.lower()
    points = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    distinct = np.unique(points)
    letters = distinct[[chr(c).isalpha() for c in distinct]]
    if not len(letters):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    code = np.searchsorted(letters, points)
    code = np.where((code < len(letters)) & (letters[np.minimum(code, len(letters) - 1)] == points), code + 1, 0)
    code = np.concatenate(([0], code, [0]))  # 0: a break
    code = code[(code > 0) | np.concatenate(([True], code[:-1] > 0))]  # one break between words
    m = len(letters) + 1
    one = code[code > 0]
    two = code[:-1] * m + code[1:]
    three = (code[:-2] * m + code[1:-1]) * m + code[2:]
    three = three[code[1:-1] > 0]  # none across a break
    points_of = np.concatenate(([32], letters))
    grams, counts = [], []
    for order, found in ((1, one), (2, two), (3, three)):
        if m**order <= 1 << 17:
            n = np.bincount(found, minlength=1)
            g = np.flatnonzero(n)
            n = n[g]
        else:
            g, n = np.unique(found, return_counts=True)
        spelt = np.zeros(len(g), np.int64)
        for k in range(order):
            spelt = spelt * BASE + points_of[g // m ** (order - 1 - k) % m]
        grams.append(spelt)
        counts.append(n)
    return np.concatenate(grams), np.concatenate(counts)


def ranked(grams: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """The most frequent n-grams in falling order; ties by the n-gram."""
    if len(grams) > most:
        least = np.partition(counts, len(counts) - most)[len(counts) - most]
        near = counts >= least
        grams, counts = grams[near], counts[near]
    return grams[np.lexsort((grams, -counts))][:most]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of each batch, summed over its documents."""
    for batch in batches:
        by: dict[str, list] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            by.setdefault(lang, []).append(ngram_counts(text.as_py()))
        for lang, found in by.items():
            grams, place = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
            n = np.bincount(place, weights=np.concatenate([f[1] for f in found]), minlength=len(grams)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.int64()), pa.array(n, pa.int64())], names=["lang", "gram", "n"])


def language_profiles(labelled: DataFrame, sample: int = 4000, most: int = 400, seed: int = 3) -> DataFrame:
    """(lang, gram, rank): each language's `most` most frequent n-grams, ranks from 0.

    labelled needs doc_id, lang and text, lang not null. sample: about so many documents of each language are read (all, if
    there are fewer), by a hash of doc_id; that bounds the work.
    """
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")).withColumnRenamed("lang", "l2")
    drawn = labelled.select("doc_id", "lang", "text").join(broadcast_if(sizes, sizes.count()), F.col("lang") == F.col("l2")).filter(unit_hash(seed, F.col("doc_id")) * F.col("rows") < sample)
    counts = drawn.filter(F.col("text").isNotNull()).select("lang", "text").mapInArrow(_counted, "lang string, gram long, n long")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram")) - 1
    return counts.withColumn("rank", rank).filter(F.col("rank") < most).select("lang", "gram", "rank")


def _scored(langs: list[str], grams: np.ndarray, ranks: np.ndarray, most: int):
    """ranks[i, j]: rank of grams[j] in the profile of langs[i]; `most` where it lacks it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, scores = [], []
            for text in batch.column(1):
                own = ranked(*ngram_counts(text.as_py() or ""), most)
                if not len(own) or not len(langs):
                    found.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
                known = grams[at] == own
                places = np.where(known, ranks[:, at], most)
                distance = np.where(places == most, most, np.abs(places - np.arange(len(own)))).sum(axis=1)
                order = np.argsort(distance, kind="stable")
                best = int(distance[order[0]])
                rest = int(distance[order[1]]) if len(order) > 1 else most * len(own)
                found.append(langs[order[0]])
                scores.append(1.0 - best / max(rest, 1) if rest else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def identify_languages(docs: DataFrame, held_out, sample: int = 4000, most: int = 400) -> DataFrame:
    """A row per row of docs: doc_id, held_out, lang_pred, score.

    docs needs doc_id, lang and text. held_out: a condition on doc_id; such documents (and those without lang) teach
    nothing. lang_pred is a learned lang value, the nearest profile's (ties: the first by code point), or "und" where the
    text is null or has no letter, or nothing was learned. score: 1 - its distance / the next one's distance, 0 to 1.

    A prediction depends on the text only. Null doc_id is not held out. Repeated rows are rows like any other. An empty
    table gives no rows. The profiles (languages x most rows) are sent to the tasks. More than LANGUAGES distinct values of
    lang are an error: such a column does not name languages.
    """
    rows = docs.select(F.col("doc_id").alias("doc_id"), "lang", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    profiles = stored(language_profiles(rows.filter("lang is not null and not held_out"), sample, most), "profiles")
    known = profiles.select("lang").distinct().count()
    if known > LANGUAGES:
        raise ValueError(f"{known} values of lang; with more than {LANGUAGES} the profiles are no bounded table")
    profiles = profiles.collect()
    langs = sorted({p["lang"] for p in profiles})
    grams = np.unique(np.array([p["gram"] for p in profiles], dtype=np.int64))
    ranks, place = np.full((len(langs), max(len(grams), 1)), most, dtype=np.int64), {lang: i for i, lang in enumerate(langs)}
    for p in profiles:
        ranks[place[p["lang"]], np.searchsorted(grams, p["gram"])] = p["rank"]
    kind = dict(docs.dtypes)["doc_id"]
    return rows.select("doc_id", "text", "held_out").mapInArrow(_scored(langs, grams, ranks, most), f"doc_id {kind}, held_out boolean, lang_pred string, score double")
