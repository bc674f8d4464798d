"""Text cleaning as column expressions (JVM side, no Python functions)."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: characters with a canonical decomposition into a letter and marks, up to Latin Extended Additional
_MARKED = {chr(c): "".join(x for x in unicodedata.normalize("NFD", chr(c)) if not unicodedata.combining(x)) for c in range(0xC0, 0x1F00)}
_FOLD = {k: v for k, v in _MARKED.items() if len(v) == 1 and v != k}
NULL_TOKENS = ("na", "n/a", "null", "nan", "")


def header(name: str, ascii_only: bool = True) -> str:
    """A column header in snake case: trimmed, lower, without accents."""
    flat = unicodedata.normalize("NFKD", name.strip())
    flat = flat.encode("ascii", "ignore").decode() if ascii_only else flat
    return re.sub(r"[^0-9a-zA-Z]+", "_", flat).strip("_").lower()


def with_headers(df: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Normalised headers, then a renaming dictionary."""
    return df.toDF(*[header(c) for c in df.columns]).withColumnsRenamed(dict(renames or {}))


def renamed_for(df: DataFrame, by_year: Mapping[int, Mapping[str, str]], year: int) -> DataFrame:
    """with_headers, by the dictionary of the latest year that is not after `year`."""
    years = [y for y in by_year if y <= year]
    return with_headers(df, by_year[max(years)] if years else None)


def squeezed(c: Column) -> Column:
    """Without quotes around it and zero-width characters, white space collapsed."""
    c = F.regexp_replace(c, "[\\x{200B}\\x{200C}\\x{200D}\\x{FEFF}]", "")
    c = F.regexp_replace(c, "[\\s\\x{A0}]+", " ")
    return F.trim(F.regexp_replace(F.trim(c), "^[\"']+|[\"']+$", ""))


def null_tokens(c: Column, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """Squeezed; null where it is one of the tokens in any case (P5)."""
    clean = squeezed(c)
    return F.when(~F.lower(clean).isin(*tokens), clean)


def clean_strings(df: DataFrame, tokens: Iterable[str] = NULL_TOKENS) -> DataFrame:
    """null_tokens over every string column (P5)."""
    return df.withColumns({c: null_tokens(F.col(c), tokens) for c, t in df.dtypes if t == "string"})


def accent_fold(c: Column) -> Column:
    """Without accents; other characters stay."""
    plain = F.translate(c, "".join(_FOLD), "".join(_FOLD.values()))
    return F.regexp_replace(plain, "[\\x{0300}-\\x{036F}]", "")


def ascii_key(c: Column) -> Column:
    """Lower, folded, other than ASCII dropped, each space an underscore."""
    return F.replace(F.regexp_replace(F.lower(F.trim(accent_fold(c))), "[^\\x00-\\x7F]", ""), F.lit(" "), F.lit("_"))


def match_key(c: Column) -> Column:
    """The one normaliser for joins by name: folded, lower, white space collapsed."""
    return F.lower(F.trim(F.regexp_replace(accent_fold(c), "\\s+", " ")))


def yes_no(c: Column, yes: Iterable[str] = ("SI", "S", "YES", "Y"), no: Iterable[str] = ("NO", "N")) -> Column:
    """True, false, or null for anything else."""
    up = F.upper(accent_fold(F.trim(c)))
    return F.when(up.isin(*yes), True).when(up.isin(*no), False)


def capitalised(c: Column) -> Column:
    """First character upper, the rest lower (P10)."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def sentence_case(c: Column, terms: Iterable[str] = ()) -> Column:
    """capitalised, with given terms restored to their spelling."""
    out = capitalised(c)
    for term in terms:
        out = F.regexp_replace(out, f"(?i)\\b{re.escape(term)}\\b", term.replace("$", "\\$"))
    return out


def words(c: Column) -> Column:
    return F.split(F.trim(c), "\\s+")


def title_with_particles(c: Column, particles: Iterable[str], tokens: Mapping[str, str] | None = None) -> Column:
    """Each word capitalised, particles lower except in first place, canonical tokens as given."""
    spelt = F.create_map(*[F.lit(x) for kv in (tokens or {"": ""}).items() for x in kv])

    def one(w: Column, i: Column) -> Column:
        low = F.lower(w)
        title = F.concat(F.upper(F.substring(low, 1, 1)), F.substring(low, 2, 1 << 30))
        return F.coalesce(F.try_element_at(spelt, low), F.when((i > 0) & low.isin(*particles), low).otherwise(title))

    return F.array_join(F.transform(words(c), one), " ")


def restore_accents(c: Column, spelling: Mapping[str, str]) -> Column:
    """Whole words replaced by their accented spelling, in one pass over a map (P12); case of the first letter kept."""
    known = F.create_map(*[F.lit(x) for kv in spelling.items() for x in kv])

    def one(w: Column) -> Column:
        found = F.try_element_at(known, F.lower(w))
        upper = F.substring(w, 1, 1) != F.lower(F.substring(w, 1, 1))
        return F.coalesce(F.when(upper, F.concat(F.upper(F.substring(found, 1, 1)), F.substring(found, 2, 1 << 30))).otherwise(found), w)

    return F.array_join(F.transform(words(c), one), " ")


def restore_acronyms(c: Column, listed: Iterable[str] = (), least: int = 2, most: int = 5) -> Column:
    """Listed words and words without vowels upper-cased."""
    def one(w: Column) -> Column:
        return F.when(F.lower(w).isin(*[x.lower() for x in listed]) | w.rlike(f"(?i)^[bcdfghjklmnpqrstvwxyz]{{{least},{most}}}$"), F.upper(w)).otherwise(w)

    return F.array_join(F.transform(words(c), one), " ")


def canonical_label(c: Column, rules: Iterable[tuple[str, str]]) -> Column:
    """The label of the first pattern that matches, else the text."""
    out = F
    for pattern, label in rules:
        out = out.when(c.rlike(pattern), label)
    return out.otherwise(c) if out is not F else c


def last_matching(c: Column, rules: Iterable[tuple[str, object]]) -> Column:
    """Every contained pattern assigns its value, so the last one in order wins."""
    out = F
    for part, value in reversed(list(rules)):
        out = out.when(F.contains(c, F.lit(part)), value)
    return out


def mapped(c: Column, mapping: Mapping, default: Column | None = None) -> Column:
    """A dictionary's value, else default."""
    out = F
    for k, v in mapping.items():
        out = out.when(c == k, v)
    return out.otherwise(default) if default is not None else out


def number_text(c: Column, empty: Iterable[str] = ("s/n", "sn", "-", "")) -> Column:
    """Free-text number: known fillers null, "12.0" as "12" (P37)."""
    low = F.lower(F.trim(c))
    return F.when(~low.isin(*empty), F.regexp_replace(F.trim(c), "^([0-9]+)\\.0+$", "$1"))


def percent(c: Column) -> Column:
    """A number from text with an optional percent sign; null where it is none."""
    return F.trim(F.regexp_replace(c, "%", "")).try_cast("double")
