"""Small tables for the operators' tests: what the registered queries see, and odd rows."""

import pytest

LONG = " ".join(f"w{i % 997} x{i % 13}." for i in range(20_000))
ODD = [
    # doc_id, text, lang, source, n_chars, and columns whose names operators use themselves
    (1, None, "en", "a", None, 5, "z"),
    (2, "", None, "a", 0, 5, "z"),
    (3, "  \n\t ", "en", None, 5, 5, None),
    (4, LONG, "de", "b", len(LONG), 5, "z"),
    (5, LONG, "de", "b", len(LONG), None, "z"),
    (6, "One two three four five six seven eight.", "en", "", 40, 5, "z"),
    (6, "One two three four five six seven eight.", "en", "", 40, 5, "z"),
    (7, "one two three four five six seven EIGHT.", "en", "b", 40, 5, "z"),
    (None, "a text without an id", "fr", "b", 20, 5, "z"),
    (None, "a text without an id", "fr", "b", 20, 5, "z"),
    (8, "İstanbul École ΣΣ <|endoftext|> ²½ 你好 it's é \x1c x", "fr", "c", 40, 5, "z"),
    (9, "42", "en", "c", 2, 5, "z"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, digest string"


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, sf):
    return [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
