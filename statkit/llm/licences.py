"""License scans with ordered signature rules.

A cheap keyword test over the raw text sends few texts on. Those are normalised to words; each rule whose keyword occurs is
matched, which gives intervals of words. A detection is suppressed if another one that comes first (by start, then longer,
then rank, then rule order) contains its interval and its rank is no worse. All of it is one projection: no shuffle.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, let, running, whole_text
from .license_rules import CONFIDENCE, rules

WORD = "0-9A-Za-z\\x{80}-\\x{10FFFF}"
#: Every rule's matches hold a word that begins with one of these, in any case.
GATE = f"(?i)[^{WORD}](?:licen[sc]|copy(?:right|left)|spdx|rights|vorbehalten|droits|derechos|public|cc0|cc[^{WORD}]+by|[al]?gpl|wtfpl|cecill|confidential|terms|bsd|sspl|mpl|eupl|creative|unlicense|aws|ofl|opensource|uganda|lppl|legal|documents|libpng|boost|attribution|mariadb)"


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _spans(words: Column, hit: Column) -> Column:
    """Array of (start, minus end, rank, order, label, base) for each match of a rule; in words, end exclusive. hit: the rule and its matches."""
    rule, found = hit["rule"], hit["matches"]
    gaps = F.transform(F.split(words, rule["regex"]), _spaces)  # one more than matches; a match begins with the space before its first word

    def placed(gaps: Column, sizes: Column) -> Column:
        before = running(F.zip_with(gaps, sizes, lambda g, m: g + F.coalesce(m, F.lit(0))), 0, lambda a, b: a + b)
        starts = F.slice(F.zip_with(before, gaps, lambda b, g: b + g), F.lit(1), F.size(sizes))
        one = lambda start, m: F.struct(start.alias("start"), (-(start + m)).alias("till"), rule["rank"].alias("rank"), rule["place"].alias("place"), rule["label"].alias("label"), rule["base"].alias("base"))
        return F.zip_with(starts, sizes, one)

    return let(gaps, lambda g: let(F.transform(found, _spaces), lambda m: placed(g, m)))


def _pattern(regex: str) -> str:
    """The rule's regex between spaces, of which only the first is part of a match; a regex without alternatives begins with its literal."""
    return f" {regex}(?= )" if "|" not in re.sub(r"\(\?:[^()]*\)", "", regex) else f" (?:{regex})(?= )"


def scan_licences(docs: DataFrame) -> DataFrame:
    """A row per row of docs: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections.

    docs needs doc_id and text. Words are runs of digits, letters and characters from U+0080 on, with A-Z lower-cased.
    labels: the base labels found and those of detections that nothing suppresses, distinct, sorted, comma-joined.
    detections: all of them, in order (start, minus end, rank, place, label, base). score: the highest confidence of a
    detection that stays, else 0. Null text counts as empty: no words, empty labels, null first_word and last_word. Null
    doc_id and repeated rows are rows like any other. An empty table gives no rows.
    """
    listed = [dict(zip(("keyword", "regex", "label", "rank", "base"), r, strict=True)) | {"place": i} for i, r in enumerate(rules())]
    listed = [rule | {"regex": _pattern(rule["regex"])} for rule in listed]
    table = F.from_json(F.lit(json.dumps(listed)), "array<struct<keyword:string,regex:string,label:string,rank:int,place:int,base:boolean>>")  # a literal, folded once
    rows = docs.select("doc_id", whole_text().alias("body"))
    words = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.translate("body", UPPER, LOWER), f"[^{WORD}]+", " ")), F.lit(" "))
    rows = rows.select("doc_id", F.regexp_count("body", F.lit(f"[{WORD}]+")).cast("long").alias("n_words"), F.when(F.concat(F.lit(" "), "body").rlike(GATE), words).alias("words"))
    words = F.col("words")
    hits = F.transform(F.filter(table, lambda r: F.contains(words, r["keyword"])), lambda r: F.struct(r.alias("rule"), F.regexp_extract_all(words, r["regex"], F.lit(0)).alias("matches")))
    found = F.flatten(F.transform(F.filter(hits, lambda hit: F.size(hit["matches"]) > 0), lambda hit: _spans(words, hit)))  # most rules match nothing: they cost one look
    rows = rows.select("doc_id", "n_words", F.coalesce(F.when(words.isNotNull(), F.sort_array(found)), F.expr("cast(array() as array<struct<start:int,till:int,rank:int,place:int,label:string,base:boolean>>)")).alias("detections"))

    none = F.expr("cast(array() as array<string>)")
    start = F.struct(F.array(*[F.lit(0)] * len(CONFIDENCE)).alias("ends"), F.lit(0).alias("n"), none.alias("base"), none.alias("labels"), F.lit(9).alias("best"), F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"))

    def step(s: Column, d: Column) -> Column:
        stays = F.element_at(s["ends"], d["rank"]) < -d["till"]
        ends = F.transform(s["ends"], lambda v, i: F.when(i + 1 >= d["rank"], F.greatest(v, -d["till"])).otherwise(v))
        return F.struct(
            ends.alias("ends"),
            (s["n"] + d["base"].cast("int")).alias("n"),
            F.when(d["base"], F.array_union(s["base"], F.array(d["label"]))).otherwise(s["base"]).alias("base"),
            F.when(stays, F.array_union(s["labels"], F.array(d["label"]))).otherwise(s["labels"]).alias("labels"),
            F.when(stays, F.least(s["best"], d["rank"])).otherwise(s["best"]).alias("best"),
            F.when(d["base"], F.least(s["first"], d["start"])).otherwise(s["first"]).alias("first"),
            F.when(d["base"], F.greatest(s["last"], d["start"])).otherwise(s["last"]).alias("last"),
        )

    rows = rows.select("doc_id", "n_words", "detections", F.aggregate("detections", start, step).alias("s"))
    score = F.coalesce(*[F.when(F.col("s.best") == rank, F.lit(value)) for rank, value in CONFIDENCE.items()], F.lit(0.0))
    joined = lambda labels: F.array_join(F.array_sort(labels), ",")
    return rows.select(
        "doc_id", "n_words",
        F.col("s.n").cast("long").alias("n_base"), F.col("s.first").cast("long").alias("first_word"), F.col("s.last").cast("long").alias("last_word"),
        joined(F.col("s.base")).alias("base_labels"),
        joined(F.array_union("s.base", "s.labels")).alias("labels"),
        score.alias("score"), "detections",
    )
