"""A small table with everything that real ones may hold."""

import pytest

LONG = " ".join(f"w{i % 977}x{i // 977} in the long text" for i in range(9000)) + "\n" + "x" * 70_000

TEXTS = [
    (1, "the quick brown fox jumps over the lazy dog. call me at +1 (415) 555-0123 or mail bob@example.org now", "a"),
    (2, "The quick brown fox jumps over the lazy dog. call me at +1 (415) 555-0123 or mail bob@example.org now", "a"),
    (3, "", "b"),
    (4, None, "b"),
    (5, "one", None),
    (6, "two words", "a"),
    (7, LONG, "c"),
    (8, LONG + " tail", "c"),
    (9, "  \t\n ", "a"),
    (9, "  \t\n ", "a"),
    (10, "card 4111 1111 1111 1111 and 4111111111111112, ip 10.0.0.255 and 10.0.0.256, iban DE89 3704 0044 0532 0130 00", None),
    (11, "été ÉTÉ 日本 \U0001F600 licensed under the MIT License; CC BY-NC 4.0 and the Apache License, Version 2.0.", "é"),
    (11, "a second text of the same id, under the mit license under the MIT license", "a"),
    (None, "no id at all but some words here", "a"),
    (None, None, None),
    (200, "the quick brown fox jumps over the lazy dog. call me at +1 (415) 555-0123 or mail bob@example.org now", "a"),
    (300, "the quick brown fox jumps over the lazy dog. call me at +1 (415) 555-0123 or mail bob@example.org today", "a"),
]
#: Columns that the operators use themselves.
EXTRA = ["size", "start", "score", "spans", "node", "key", "part", "target", "length", "_key", "h1"]
SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, " + ", ".join(f"`{c}` string" for c in EXTRA)


@pytest.fixture(scope="session")
def docs(spark):
    rows = [(i, t, s, None, None if t is None else len(t), *["?"] * len(EXTRA)) for i, t, s in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
