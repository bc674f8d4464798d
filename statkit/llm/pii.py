"""Personal data: overlapping candidates, boosted trees over their features, calibrated thresholds.

High-recall generators propose spans. Base kinds (email, ip, card, phone) stay whenever their check holds. The others are
judged by gradient-boosted trees, a set for each generator, over format features (size, digits, distinct characters,
separators, a checksum or form check) and context features (edges, cue words before the span). They learn from two sources:
candidates of the corpus that carry evidence (a checksum, a cue word, the form of an assigned value), and seed examples
written here as patterns, with and without cues, from which a generator learns what a bare span is worth. Features of every
labelled candidate are counted (a small table: they are few and coarse); the trees are fitted on the counts. Scores are
calibrated on a fold of their own, and each generator gets the lowest threshold that keeps the wanted precision there.
The trees are then one column expression. The texts are read once; everything is DataFrame functions.
"""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, let, piece, running, stored, whole_text

BASE = ("email", "ip", "card", "phone")
OTHER = ("secret", "hexkey", "iban", "account", "local_phone", "national_id", "masked_email")
KINDS = BASE + OTHER
#: kind: (a cheap test that every match passes, the pattern). A start inside a run is tried only where the last match ended,
#: and loops are possessive where nothing after them can match, so that no text takes quadratic time or deep recursion.
PATTERNS = {
    "email": ("@", "(?:(?<![A-Za-z0-9._%+-])|\\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++"),
    "ip": ("[0-9]\\.[0-9]++\\.[0-9]++\\.[0-9]", "(?<![0-9])[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++"),
    "card": ("[0-9](?:[ -]?[0-9]){15}", "(?<![0-9])[0-9]++(?:[ -][0-9]++)*+"),
    "phone": ("\\+[0-9]", "\\+[0-9][ ().0-9-]+[0-9]"),
    "secret": ("[=:] ?[\"']?[A-Za-z0-9_+/-]{8}", "(?i)(?<![a-z])(?:token|secret|passw(?:or)?d|api.?key|access.?key)[\"']? ?[=:] ?[\"']?[A-Za-z0-9_+/-]{8,}[\"']?"),
    "hexkey": ("[0-9a-f]{32}", "(?<![0-9A-Za-z])[0-9a-f]{32,}(?![0-9A-Za-z])"),
    "iban": ("[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4} ?[A-Z0-9]{4}", "(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Z0-9])"),
    "account": ("[0-9](?:[ -]?[0-9]){9}", "(?<![0-9])[0-9]++(?:[ -][0-9]++)*+"),
    "local_phone": ("[0-9]{3}\\)?[ .-][0-9]{3}[ .-][0-9]{4}", "(?<![0-9+])\\(?[0-9]{3}\\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"),
    "national_id": ("[0-9]{3}-[0-9]{2}-[0-9]{4}", "(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "masked_email": ("(?i)[(\\[]at[)\\]]", "(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]++ ?[(\\[]at[)\\]] ?[a-z0-9-]++(?: ?[(\\[]dot[)\\]] ?[a-z0-9-]++|\\.[a-z0-9-]++)++"),
}
IP_PARTS = "^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})){3}$"
#: words before a span that speak for its kind; and those that speak against all kinds
CUES = {
    "secret": "token|secret|passw|key",
    "hexkey": "key|token|secret|passw|bearer|auth|credential|api",
    "iban": "iban|account|acct|bank|konto|compte|cuenta|transfer|pay",
    "account": "account|acct|konto|compte|cuenta|bank|a/c",
    "local_phone": "phone|tel|call|mobile|cell|fax|ring|dial|contact|text me",
    "national_id": "ssn|social|national|tax|citizen|insurance",
    "masked_email": "mail|contact|write|reach|send|ask",
}
AGAINST = "order|isbn|invoice|part n|part:|serial|version|sku|ref[ .:]|commit|sha|md5|checksum|build|ticket|page|figure|digest|hash"
#: Seed examples: kind, whether it is one, text. A # is any digit, @ a hexadecimal one, ^ a capital, ? a small letter or digit.
SEEDS = (
    ("secret", 1, "token = ????#???a#??"), ("secret", 1, "password: ???????#a?"), ("secret", 1, "api_key=\"^^??#???????????#\""), ("secret", 1, "secret: @@@@@@@@@@@@@@@@@@@@"),
    ("secret", 0, "password: required"), ("secret", 0, "token = undefined"), ("secret", 0, "secret: something"), ("secret", 0, "access key: described below"),
    ("hexkey", 1, "@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@"), ("hexkey", 1, "use @@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@ here"), ("hexkey", 1, "the key @@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@, not to share"), ("hexkey", 1, "auth @@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@"),
    ("hexkey", 0, "commit @@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@"), ("hexkey", 0, "md5 @@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@"), ("hexkey", 0, "0000000000000000000000000000000#"), ("hexkey", 0, "sha256: @@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@"),
    ("iban", 1, "DE~~################"), ("iban", 1, "iban DE~~ #### #### #### #### ##"), ("iban", 1, "pay to DE~~ #### #### #### #### ## today"), ("iban", 1, "DE~~ #### #### #### #### ##"),
    ("iban", 0, "DE99 #### #### #### #### ##"), ("iban", 0, "part no AB12 C#D# E#F# ####"), ("iban", 0, "^^##^###^###^###"), ("iban", 0, "order DE01################"),
    ("account", 1, "account ############"), ("account", 1, "bank account no ##########"), ("account", 1, "konto #### #### ####"), ("account", 1, "acct: ###########"),
    ("account", 0, "############"), ("account", 0, "order ############"), ("account", 0, "in ########## cases"), ("account", 0, "isbn #############"),
    ("local_phone", 1, "###-###-####"), ("local_phone", 1, "call (###) ###-####"), ("local_phone", 1, "tel ###.###.####"), ("local_phone", 1, "my number is ###-###-#### if needed"),
    ("local_phone", 0, "version ###.###.####"), ("local_phone", 0, "order ###-###-####"), ("local_phone", 0, "serial ### ### ####"), ("local_phone", 0, "part no ###-###-####x"),
    ("national_id", 1, "123-45-####"), ("national_id", 1, "ssn 4##-1#-1###"), ("national_id", 1, "my social security number is 2##-3#-2###"), ("national_id", 1, "it was 5##-2#-3### all along"),
    ("national_id", 0, "000-##-####"), ("national_id", 0, "9##-##-####"), ("national_id", 0, "part no 4##-1#-1###"), ("national_id", 0, "isbn 2##-3#-2###"),
    ("masked_email", 1, "^?? (at) m??l (dot) org"), ("masked_email", 1, "write to j?e [at] ????.com"), ("masked_email", 1, "j?e.d?e(at)m??l(dot)net"), ("masked_email", 1, "???? [at] ???? [dot] de"),
    ("masked_email", 0, "look (at) figure.##"), ("masked_email", 0, "see (at) point.#.#"), ("masked_email", 0, "at noon (at) 12.##"), ("masked_email", 0, "page (at) 3.#"),
)
COPIES = 40  #: texts made of each seed example
FEATURES = ("size", "digits", "distinct", "seps", "left", "right", "cue", "check")  #: of at most 8, 5, 4, 3, 3, 3, 3 and 2 values
SPAN = "array<struct<kind:int,start:int,till:int,size:int,digits:int,distinct:int,seps:int,left:int,right:int,cue:int,check:int,valid:boolean>>"


def mod97(text: Column) -> Column:
    """The remainder by 97 of an account number in the international form, its first four characters moved to the end."""
    plain = F.regexp_replace(text, " ", "")
    letters = F.split(F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4)), "")
    value = lambda c: F.when(F.ascii(c) >= 65, F.ascii(c) - 55).otherwise(F.ascii(c) - 48)
    return F.aggregate(letters, F.lit(0), lambda acc, c: F.when(c == "", acc).otherwise(F.pmod(acc * F.when(value(c) > 9, 100).otherwise(10) + value(c), F.lit(97))))


def _edge(c: Column) -> Column:
    return F.when(c.rlike("[A-Za-z0-9]"), 2).when(c.rlike("^\\s?$"), 0).otherwise(1)


def _by_kind(kind: Column, values: dict[str, Column], other: Column) -> Column:
    """The value of the span's kind; of kinds without one, `other`."""
    out = None
    for name, value in values.items():
        is_ = kind == KINDS.index(name)
        out = F.when(is_, value) if out is None else out.when(is_, value)
    return out.otherwise(other)


def _scan(body: Column, kind: int) -> Column:
    """What a generator finds: kind, the lengths of the texts between its matches, and the matches; null where its test fails."""
    gate, pattern = PATTERNS[KINDS[kind]]
    test = F.contains(body, F.lit(gate)) if gate == "@" else body.rlike(gate)
    return F.when(test, F.struct(F.lit(kind).alias("kind"), F.transform(F.split(body, pattern), F.length).alias("gaps"), F.regexp_extract_all(body, F.lit(pattern), F.lit(0)).alias("matches")))


def _placed(scan: Column) -> Column:
    """Array of (kind, start, m) of a scan's matches; starts in code points."""
    gaps, matches = scan["gaps"], scan["matches"]
    before = running(F.zip_with(gaps, matches, lambda g, m: g + F.coalesce(F.length(m), F.lit(0))), 0, lambda a, b: a + b)
    starts = F.slice(F.zip_with(before, gaps, lambda b, g: b + g), F.lit(1), F.size(matches))
    return F.zip_with(starts, matches, lambda start, m: F.struct(scan["kind"].alias("kind"), start.alias("start"), m.alias("m"), F.regexp_replace(m, "[^0-9]", "").alias("digits")))


def _described(x: Column, cut: Column) -> Column:
    """A candidate (kind, start, m, digits, before) with its features; the text is given in chunks."""
    kind, m, start, digits, before = (x[n] for n in ("kind", "m", "start", "digits", "before"))
    size, value = F.length(m), F.regexp_replace(F.regexp_extract(m, "[=:] ?(.*)$", 1), "[\"']", "")
    check = _by_kind(kind, {  # a checksum, or the form that a true one has
        "card": F.call_function("luhn_check", digits),
        "account": F.call_function("luhn_check", digits),
        "iban": mod97(m) == 1,
        "national_id": ~m.rlike("^(?:000|666|9)|-00-|-0000$"),
        "masked_email": m.rlike("(?i)[a-z][a-z0-9-]*(?: ?[(\\[]dot[)\\]] ?|\\.)[a-z]{2,6}$"),
        "secret": value.rlike("[0-9]") & value.rlike("[A-Za-z]") | (F.length(value) >= 24),
        "hexkey": F.length(m).isin(32, 40, 64, 128),
        "local_phone": m.rlike("^\\(|([ .-])[0-9]{3}\\1"),
    }, F.lit(True))
    cued = _by_kind(kind, {name: before.rlike(words) for name, words in CUES.items()}, F.lit(False))
    cue = F.when(kind < len(BASE), 0).when(before.rlike(AGAINST), 2).when(cued, 1).otherwise(0)
    return F.struct(
        kind.alias("kind"), start.alias("start"), (start + size).alias("till"),
        F.least(F.floor(size / 6), F.lit(7)).cast("int").alias("size"),
        F.floor(4 * F.length(digits) / size).cast("int").alias("digits"),
        F.least(F.floor(F.size(F.array_distinct(F.split(m, ""))) / 5), F.lit(3)).cast("int").alias("distinct"),
        F.least(F.length(F.regexp_replace(m, "[^ .()-]", "")), F.lit(2)).alias("seps"),
        _edge(F.substring(before, -1, 1)).alias("left"),
        _edge(piece(cut, start + size, start + size + 1)).alias("right"),
        cue.alias("cue"),
        F.coalesce(check, F.lit(False)).cast("int").alias("check"),
        F.struct(m.alias("m"), F.length(digits).alias("n"), before.alias("before")).alias("seen"),
    )


def _valid(x: Column) -> Column:
    """Whether a described candidate is one of its kind, by evidence; null where there is none."""
    m, n, before, check = x["seen"]["m"], x["seen"]["n"], x["seen"]["before"], x["check"] == 1
    spoken = F.when(x["cue"] == 1, F.lit(True)).when(x["cue"] == 2, F.lit(False))
    return _by_kind(x["kind"], {
        "email": F.lit(True),
        "ip": m.rlike(IP_PARTS),
        "card": n.between(16, 19) & check,
        "phone": n.between(8, 15),
        "secret": check, "iban": check, "masked_email": check,
        "national_id": F.when(~check, F.lit(False)).otherwise(spoken),
        # what local_phone or phone proposes too is no account, and nothing is said of it here
        "account": F.when(~m.rlike(PATTERNS["local_phone"][1]) & ~before.endswith("+"), spoken),
    }, spoken)


def propose(docs: DataFrame) -> DataFrame:
    """doc_id and spans: all candidates of a row's whole text, kind by kind (a number into KINDS), by start.

    The generators' matches are placed and described by one expression for all kinds, which keeps the plan small.
    """
    rows = docs.select("doc_id", whole_text().alias("body"))
    rows = rows.select("doc_id", "body", F.col("body").rlike("[0-9@=:\\[(]").alias("any"))
    scans = F.filter(F.array(*[_scan(F.col("body"), k) for k in range(len(KINDS))]), lambda s: s.isNotNull() & (F.size(s["matches"]) > 0))
    rows = rows.select("doc_id", F.when(F.col("any"), chunks(F.col("body"))).alias("cut"), F.when(F.col("any"), scans).alias("scans"))
    count = lambda x: F.length(x["digits"])
    taken = lambda x: _by_kind(x["kind"], {"account": count(x).between(10, 19), "card": count(x).between(16, 19)}, F.lit(True))
    rows = rows.select("doc_id", "cut", F.filter(F.flatten(F.transform("scans", _placed)), taken).alias("found"))
    context = lambda x: F.lower(piece(F.col("cut"), F.greatest(x["start"] - 24, F.lit(0)), x["start"]))
    rows = rows.select("doc_id", "cut", F.transform("found", lambda x: F.struct(*[x[n].alias(n) for n in ("kind", "start", "m", "digits")], context(x).alias("before"))).alias("found"))
    rows = rows.select("doc_id", F.transform("found", lambda x: _described(x, F.col("cut"))).alias("found"))
    names = ("kind", "start", "till", *FEATURES)
    spans = F.transform("found", lambda x: F.struct(*[x[n].alias(n) for n in names], _valid(x).alias("valid"))).cast(SPAN)
    return rows.select("doc_id", F.coalesce(spans, F.expr(f"cast(array() as {SPAN})")).alias("spans"))


def seeded(spark: SparkSession) -> DataFrame:
    """(kind, label, fold, text): COPIES texts of each seed example, with other characters each; the same in every run."""
    listed = json.dumps([{"kind": KINDS.index(kind), "label": label, "text": text} for kind, label, text in SEEDS])
    rows = spark.range(1).select(F.explode(F.from_json(F.lit(listed), "array<struct<kind:int,label:int,text:string>>")).alias("s"))
    rows = rows.select("s.*", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))).alias("copy"))
    any_of = lambda letters, i: F.substring(F.lit(letters), F.pmod(F.xxhash64("text", "copy", i), F.lit(len(letters))).cast("int") + 1, F.lit(1))
    signs = {"#": "0123456789", "@": "0123456789abcdef", "^": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "?": "abcdefghijklmnopqrstuvwxyz0123456789"}

    def filled(c: Column, i: Column) -> Column:
        out = F.when(c == "#", any_of(signs["#"], i))
        for sign in "@^?":
            out = out.when(c == sign, any_of(signs[sign], i))
        return out.otherwise(c)

    rows = rows.withColumn("text", F.array_join(F.transform(F.split("text", ""), filled), ""))
    number = F.concat(F.lit("DE00"), F.regexp_replace(F.regexp_extract("text", "~~([0-9 ]*[0-9])", 1), " ", ""))
    digits = F.lpad((98 - mod97(number)).cast("string"), 2, "0")
    fold = (F.pmod(F.col("copy"), F.lit(4)) == 0).cast("int")
    return rows.select("kind", "label", fold.alias("fold"), F.replace("text", F.lit("~~"), digits).alias("text"))


def feature_counts(spans: DataFrame) -> list:
    """Labelled candidates counted by origin, kind, features, label and fold; bounded by the features' values, whatever the corpus.

    origin 0: candidates of the corpus with evidence; 1: of the seed examples. (origin, kind, *features, label, fold, n).
    """
    each = spans.select(F.pmod(F.xxhash64("doc_id"), F.lit(4)).alias("h"), F.explode("spans").alias("s")).filter(f"s.valid is not null and s.kind >= {len(BASE)}")
    each = each.select(F.lit(0).alias("origin"), "s.kind", *[f"s.{f}" for f in FEATURES], F.col("s.valid").cast("int").alias("label"), (F.col("h") == 0).cast("int").alias("fold"))
    seeds = stored(seeded(spans.sparkSession), "seeds")  # written, else their texts would be made anew for each use of them
    seeds = propose(seeds.select(F.struct("kind", "label", "fold").alias("doc_id"), "text"))
    seeds = seeds.select("doc_id", F.explode("spans").alias("s")).filter("s.kind = doc_id.kind")
    seeds = seeds.select(F.lit(1).alias("origin"), "s.kind", *[f"s.{f}" for f in FEATURES], "doc_id.label", "doc_id.fold")
    return each.unionByName(seeds).groupBy("origin", "kind", *FEATURES, "label", "fold").count().collect()


def weighed(counts: list) -> dict[int, list]:
    """By kind: (*features, label, fold, weight). Each label of each origin weighs the same in a fold, so that neither floods the other."""
    total: dict[tuple, int] = {}
    for origin, kind, *x, label, fold, n in map(tuple, counts):
        total[origin, kind, label, fold] = total.get((origin, kind, label, fold), 0) + n
    out: dict[int, dict] = {}
    for origin, kind, *x, label, fold, n in sorted(map(tuple, counts)):
        rows = out.setdefault(kind, {})
        key = (*x, label, fold)
        rows[key] = rows.get(key, 0.0) + 1000 * n / total[origin, kind, label, fold]
    return {kind: [(*key, w) for key, w in rows.items()] for kind, rows in out.items()}


def boost(counts: list, trees: int = 24, depth: int = 2, rate: float = 0.3) -> tuple[float, list, tuple[float, float]]:
    """(start, trees, (slope, offset)): logistic gradient boosting on counted feature vectors, then Platt scaling on fold 1.

    A tree is a leaf value or (feature, threshold, tree where feature <= threshold, other tree).
    """
    counts = sorted(tuple(r) for r in counts)  # rows come in any order; sums must not depend on it
    x = np.array([r[: len(FEATURES)] for r in counts], dtype=float).reshape(-1, len(FEATURES))
    y, fold, n = (np.array([r[len(FEATURES) + i] for r in counts], dtype=float) for i in range(3))
    fit, held = fold == 0, fold == 1
    if not n[fit & (y == 1)].sum() or not n[fit & (y == 0)].sum():
        return (0.0, [], (1.0, 0.0))
    w = n * fit
    start = math.log((w * y).sum() / (w * (1 - y)).sum())
    score, grown = np.full(len(y), start), []

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int):
        leaf = rate * g[rows].sum() / (h[rows].sum() + 1.0)
        best = (1e-6, None)
        if level:
            for j in range(x.shape[1]):
                for t in np.unique(x[rows, j])[:-1]:
                    low = rows & (x[:, j] <= t)
                    high = rows & ~low
                    gain = sum(g[s].sum() ** 2 / (h[s].sum() + 1.0) for s in (low, high)) - g[rows].sum() ** 2 / (h[rows].sum() + 1.0)
                    if gain > best[0]:
                        best = (gain, (j, float(t), low, high))
        if best[1] is None:
            return leaf
        j, t, low, high = best[1]
        return (j, t, grow(low, g, h, level - 1), grow(high, g, h, level - 1))

    def value(tree, rows: np.ndarray) -> np.ndarray:
        if not isinstance(tree, tuple):
            return np.full(len(rows), tree)
        return np.where(rows[:, tree[0]] <= tree[1], value(tree[2], rows), value(tree[3], rows))

    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        tree = grow(np.ones(len(y), dtype=bool), w * (y - p), w * p * (1 - p), depth)
        grown.append(tree)
        score = score + value(tree, x)
    a, b = 1.0, 0.0
    if n[held & (y == 1)].sum() and n[held & (y == 0)].sum():
        w = n * held
        for _ in range(200):
            p = 1 / (1 + np.exp(-(a * score + b)))
            a += 0.5 * (w * (y - p) * score).sum() / (w * (1 + score**2)).sum()
            b += 0.5 * (w * (y - p)).sum() / w.sum()
    return (start, grown, (a, b))


def threshold(counts: list, model: tuple, precision: float) -> float:
    """The least score at and above which `precision` of the calibration fold's weight is positive; 1.1 (nothing) if there is none."""
    start, trees, (a, b) = model

    def leaf(tree, x) -> float:
        while isinstance(tree, tuple):
            tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
        return tree

    at: dict[float, list[float]] = {}
    for *x, label, fold, n in counts:
        if fold == 1:
            score = 1 / (1 + math.exp(-(a * (start + sum(leaf(t, x) for t in trees)) + b)))
            at.setdefault(round(score, 9), [0.0, 0.0])[label] += n
    bad, good, least = 0.0, 0.0, 1.1
    for score in sorted(at, reverse=True):
        bad, good = bad + at[score][0], good + at[score][1]
        if good and good >= precision * (good + bad):
            least = score - 1e-8  # the tasks' sums may round otherwise
    return least


def score_of(span: Column, models: dict[int, tuple]) -> Column:
    """The calibrated probability of a candidate, by its kind's trees, as a column expression; 0 for a kind without."""

    def shown(tree) -> Column:
        if not isinstance(tree, tuple):
            return F.lit(float(tree))
        return F.when(span[FEATURES[tree[0]]] <= tree[1], shown(tree[2])).otherwise(shown(tree[3]))

    out = F.lit(0.0)
    for kind, (start, trees, (a, b)) in models.items():
        total = F.lit(float(start))
        for tree in trees:
            total = total + shown(tree)
        out = F.when(span["kind"] == kind, 1 / (1 + F.exp(-(total * float(a) + float(b))))).otherwise(out)
    return out


def _clusters(spans: Column) -> Column:
    """The spans (kind, start, till, score), sorted by start, in arrays: spans of different arrays do not overlap."""

    def parted(s: Column) -> Column:
        ends = running(F.transform(s, lambda x: x["till"]), 0, F.greatest)  # the furthest end before each
        first = F.zip_with(s, ends, lambda x, end: x["start"] >= end)
        heads = F.filter(F.transform(first, lambda f, i: F.when(f, i)), lambda i: i.isNotNull())
        return let(heads, lambda h: F.transform(h, lambda at, i: F.slice(s, at + 1, F.coalesce(F.get(h, i + 1), F.size(s)) - at)))

    by_start = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["till"].alias("till"), s["kind"].alias("kind"), s["score"].alias("score"))))
    return let(by_start, parted)


def _best(cluster: Column) -> Column:
    """The spans (kind, start, till, score) of no base kind that stay, of spans of which each may overlap others."""
    apart = lambda a, b: (a["till"] <= b["start"]) | (b["till"] <= a["start"])
    others = F.filter(cluster, lambda s: (s["kind"] >= len(BASE)) & ~F.exists(cluster, lambda b: (b["kind"] < len(BASE)) & ~apart(s, b)))
    shape = lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["till"].alias("till"), s["score"].alias("score"))
    ordered = F.array_sort(F.transform(others, lambda s: F.struct((-s["score"]).alias("less"), s["start"].alias("start"), s["kind"].alias("kind"), s["till"].alias("till"), s["score"].alias("score"))))
    nothing = F.expr("cast(array() as array<struct<kind:int,start:int,till:int,score:double>>)")
    chosen = F.aggregate(ordered, nothing, lambda out, s: F.when(F.forall(out, lambda o: apart(o, s)), F.concat(out, F.array(shape(s)))).otherwise(out))
    return F.when(F.size(cluster) == 1, F.transform(F.filter(cluster, lambda s: s["kind"] >= len(BASE)), shape)).otherwise(chosen)


def find_personal_data(docs: DataFrame, precision: float = 0.9) -> DataFrame:
    """A row per row of docs: doc_id, n_email, n_ip, n_card, n_phone, base, redactions.

    docs needs doc_id and text. base: spans (kind, start, till, score) of the base kinds that pass their check, by kind and
    start; redactions: these and the other candidates that the model selects, without any that overlaps a base span; of
    others that overlap, the one with the highest score stays, then the best of those that overlap none that stays, and so
    on. precision: what the selected candidates of a kind must have on the calibration fold. Null text counts as empty: no
    spans. Null doc_id and repeated rows are rows like any other. An empty table gives no rows.
    """
    spans = stored(propose(docs), "spans")
    counts = weighed(feature_counts(spans))
    models = {kind: boost(rows) for kind, rows in counts.items()}
    least = F.array(*[F.lit(float(threshold(counts[k], models[k], precision)) if k in models else 1.1) for k in range(len(KINDS))])
    slim = lambda s, score: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["till"].alias("till"), score.alias("score"))
    base = F.transform(F.filter("spans", lambda s: (s["kind"] < len(BASE)) & s["valid"]), lambda s: slim(s, F.lit(1.0)))
    rows = spans.select("doc_id", base.alias("base"), F.filter("spans", lambda s: s["kind"] >= len(BASE)).alias("more"))
    scored = F.transform("more", lambda s: slim(s, score_of(s, models)))
    rows = rows.select("doc_id", "base", F.filter(scored, lambda s: s["score"] >= F.element_at(least, s["kind"] + 1)).alias("more"))
    rows = rows.select("doc_id", "base", F.when(F.size("more") > 0, F.array_sort(F.flatten(F.transform(_clusters(F.concat("base", "more")), _best)))).otherwise(F.col("more")).alias("more"))
    of = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    counts = [of(k).alias(f"n_{name}") for k, name in enumerate(BASE)]
    return rows.select("doc_id", *counts, "base", F.concat("base", "more").alias("redactions"))


def shown(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["till"])), ",")


def redact(docs: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id and text of docs with each redaction replaced by its kind in angle brackets; docs' doc_id must be unique.

    Redactions that overlap are replaced together, from the start of the first to the furthest end, by the kind of the first.
    """
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    rows = docs.select("doc_id", whole_text().alias("body")).join(found.select("doc_id", _clusters(F.col("redactions")).alias("parts")), "doc_id")
    rows = rows.select("doc_id", "body", F.when(F.size("parts") > 0, chunks(F.col("body"))).alias("cut"), F.transform("parts", lambda c: F.struct(F.get(c, F.lit(0))["start"].alias("start"), F.array_max(F.transform(c, lambda s: s["till"])).alias("till"), F.get(c, F.lit(0))["kind"].alias("kind"))).alias("parts"))
    till = lambda i: F.coalesce(F.get("parts", i - 1)["till"], F.lit(0))
    pieces = F.transform("parts", lambda p, i: F.concat(piece(F.col("cut"), till(i), p["start"]), F.element_at(names, p["kind"] + 1)))
    rest = piece(F.col("cut"), F.element_at("parts", -1)["till"], F.length("body"))
    return rows.select("doc_id", F.when(F.size("parts") == 0, F.col("body")).otherwise(F.concat(F.array_join(pieces, ""), rest)).alias("text"))
