import itertools
import re
from re import _parser

import pytest

from statkit.llm import license_rules, licences, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, starts, labels = WORD.findall(low), [], set()
    for label, phrase in license_rules.BASE:
        phrase = phrase.split()
        for i in range(len(words) - len(phrase) + 1):
            if words[i : i + len(phrase)] == phrase:
                starts.append(i)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def base_of(r):
    return r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]


def test_base_places_equal_brute_force(spark, sf, docs):
    rows = {r["doc_id"]: r for r in queries.op1_license_scan(spark, sf).collect()}
    assert len(rows) == len(docs)
    for doc_id, text, *_ in docs:
        assert base_of(rows[doc_id]) == brute(text)
        assert set(filter(None, rows[doc_id]["base_labels"].split(","))) <= set(rows[doc_id]["labels"].split(","))


CASES = [
    ("Licensed under the GNU General Public License, version 3.", "gpl,gpl-3.0"),
    ("SPDX-License-Identifier: Apache-2.0", "apache-2.0"),
    ("gnu\nGENERAL public -- license", "gpl"),
    ("under the GNU Affero General Public License v3", "agpl-3.0"),
    ("Licensed under CC BY-NC 4.0. All rights reserved.", "cc-by,cc-by-nc-4.0,proprietary"),
    ("see http://www.apache.org/licenses/LICENSE-2.0", "apache-2.0"),
    ("mit license mit license", "mit"),
    ("an unlicensed text", ""),
    ("xgnu general public license", ""),
    ("égnu general public licenseé", ""),
]


@pytest.mark.parametrize(("text", "labels"), CASES)
def test_labels(spark, text, labels):
    r = licences.scan_licences(spark.createDataFrame([(1, text)], "doc_id int, text string")).first()
    assert r["labels"] == labels
    assert base_of(r) == brute(text)
    assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(labels)


def test_contained_detections_are_suppressed(spark):
    r = licences.scan_licences(spark.createDataFrame([(1, "the GNU General Public License version 2 and later the MIT License")], "doc_id int, text string")).first()
    assert r["labels"] == "gpl,gpl-2.0,mit" and len(r["detections"]) >= 4


def test_odd_rows(odd, none):
    rows = licences.scan_licences(odd).collect()
    assert len(rows) == odd.count() and licences.scan_licences(none).count() == 0
    for r, o in zip(rows, odd.collect(), strict=True):
        assert (r["doc_id"], *base_of(r)) == (o["doc_id"], *brute(o["text"]))


def test_rules_are_many_and_compile():
    rules = license_rules.rules()
    assert len(rules) > 200 and all(re.compile(r[1]) for r in rules)


def examples(pattern):
    """The shortest text of each branch of a parsed regex."""
    parts = []
    for op, value in pattern:
        if op is _parser.LITERAL:
            parts.append([chr(value)])
        elif op is _parser.IN:
            parts.append([chr(value[0][1] if value[0][0] is _parser.LITERAL else value[0][1][0])])
        elif op is _parser.BRANCH:
            parts.append([x for branch in value[1] for x in examples(branch)])
        elif op is _parser.SUBPATTERN:
            parts.append(examples(value[3]))
        elif op in (_parser.MAX_REPEAT, _parser.MIN_REPEAT, _parser.POSSESSIVE_REPEAT):
            parts.append([x * value[0] for x in examples(value[2])] if value[0] else [""])
        else:
            raise AssertionError(op)
    return ["".join(x) for x in itertools.product(*parts)]


def test_gate_passes_an_example_of_each_rule():
    gate = re.compile(licences.GATE.replace("\\x{80}-\\x{10FFFF}", "\x80-\U0010ffff"))
    missed = {(r[2], x) for r in license_rules.rules() for x in examples(_parser.parse(r[1])) if not gate.search(f" {x}")}
    assert not missed


def test_address_alone_gives_its_label(spark):
    r = licences.scan_licences(spark.createDataFrame([(1, "see https://mariadb.com/bsl11")], "doc_id int, text string")).first()
    assert r["labels"] == "busl-1.1"


def brute_labels(text):
    """Labels by the rules one by one, and the suppression pair by pair."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = f" {' '.join(WORD.findall(low))} "
    found = []
    for place, (_, pattern, label, rank, base) in enumerate(license_rules.rules()):
        for m in re.finditer(f"(?<= )(?:{pattern})(?= )", words):
            start = words[: m.start()].count(" ") - 1
            found.append((start, -(start + m.group().count(" ") + 1), rank, place, label, base))
    found.sort()
    stay = [d for i, d in enumerate(found) if not any(e[1] <= d[1] and e[2] <= d[2] for e in found[:i])]
    return ",".join(sorted({d[4] for d in stay} | {d[4] for d in found if d[5]}))


def test_suppression_equals_brute_force(spark, docs):
    texts = [t for t, _ in CASES] + [d[1] for d in docs]
    texts += [" and ".join(x for r in license_rules.rules()[i : i + 9] for x in examples(_parser.parse(r[1]))[:1]) for i in range(0, len(license_rules.rules()), 9)]
    texts += ["The GNU Lesser General Public License version 2.1 or the Mozilla Public License 1.1, MIT License (MIT), BSD 3 clause license, CC BY SA 4.0 by the Apache License, version 2.0"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r["doc_id"]: r["labels"] for r in licences.scan_licences(frame).select("doc_id", "labels").collect()}
    gate = re.compile(licences.GATE.replace("\\x{80}-\\x{10FFFF}", "\x80-\U0010ffff"))
    for i, text in enumerate(texts):
        assert got[i] == (brute_labels(text) if gate.search(f" {text}") else ""), text
        assert gate.search(f" {text}") or not brute_labels(text)


def test_patterns_find_what_rules_between_spaces_find():
    for _, rule, *_ in license_rules.rules():
        found = examples(_parser.parse(rule))
        words = f" {' '.join([*found, 'and', *found])} x{found[0]} {found[-1]}x "  # neighbours share a space; parts of words are no matches
        plain = [(m.start(), m.end()) for m in re.finditer(f"(?<= )(?:{rule})(?= )", words)]
        assert [(m.start() + 1, m.end()) for m in re.finditer(licences._pattern(rule), words)] == plain


def test_time_grows_with_the_matches_of_a_text(spark):
    """Twice the matches take about twice the time; all places are right."""
    import time

    took = []
    for n in (40_000, 40_000, 80_000):  # the first one compiles
        docs = spark.createDataFrame([(1, "under the mit license x " * n)], "doc_id long, text string")
        began = time.time()
        row = licences.scan_licences(docs).drop("detections").first()
        took.append(time.time() - began)
        assert (row["n_base"], row["first_word"], row["last_word"]) == (n, 2, 5 * n - 3)
    assert took[2] < 2.5 * took[1] + 5
