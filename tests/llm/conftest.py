import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use themselves
    T.StructField("n_words", T.StringType()), T.StructField("size", T.StringType()), T.StructField("fp", T.StringType()),
    T.StructField("component", T.StringType()), T.StructField("anchor", T.StringType()), T.StructField("first", T.StringType()),
    T.StructField("kept", T.StringType()), T.StructField("target", T.StringType()), T.StructField("piece", T.StringType()),
])
EXTRA = ("a", "b", "c", "d", "e", "f", "g", "h", "i")


def prose(seed, words):
    drawn = random.Random(seed)
    parts = []
    for _ in range(words):
        parts.append("".join(drawn.choice(["ta", "ré", "on", "ing", "ß", "the", "o", "st"]) for _ in range(drawn.randint(1, 4))))
        parts.append(drawn.choice([" ", " ", " ", "\n", ". "]))
    return "".join(parts)


def texts():
    """Copies, near copies, shared passages, white space of all kinds, empty, null and long texts."""
    passage = prose("passage", 90)
    rows = [
        (0, prose(0, 120), "fr", "a"), (1, prose(0, 120), "fr", "a"), (2, prose(0, 120) + " more", "fr", "b"),
        (3, prose(1, 40) + passage + prose(2, 30), "en", "b"), (4, prose(3, 10) + passage, "en", "b"),
        (5, passage + prose(4, 70) + passage, "en", None), (6, "", "de", "a"), (7, None, "de", "a"), (8, " \t\n\x0b\x0c\r ", None, None),
        (9, "one", "en", "c"), (10, "one  two", "en", "c"), (11, "a\u00a0b\u2003c\u0085d  e\n\nf\t\tg<|endoftext|>h", "en", "c"),
        (12, prose(5, 3000), "es", "d"), (13, "x" * 700, "es", "d"), (14, "la la " * 200, "es", "d"),
        (15, prose(6, 60) + "é" * 150, "es", "a"), (16, prose(7, 25) + "é" * 150 + "end", "es", "a"),
        (None, prose(8, 80), "en", "a"), (None, prose(8, 80), "en", "a"),
        (17, prose(9, 100), "en", "a"), (17, prose(9, 100), "en", "a"), (17, prose(10, 90), "en", "a"),
        (18, prose(12, 260).upper(), "en", "a"), (19, prose(12, 260), "en", "b"),
    ]
    return [(i, t, l, s, len(t or "")) for i, t, l, s in rows]


@pytest.fixture(scope="session")
def rows():
    return texts()


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame([r + EXTRA for r in texts()], DOCS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
