import re
import string

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from matchlore.functions import labels, text as tx


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first()["x"]


def tokens(line):
    line = re.sub("[0-9]", "", line.strip().lower())
    line = "".join(c for c in line if c not in ".-:;!@#$%^&*(){}")
    return [w.strip() for w in line.split(" ") if w.strip()]


def unquoted(value):
    for _ in range(2):
        for quote in "'\"":
            value = value[1:] if value.startswith(quote) else value
            value = value[:-1] if value.endswith(quote) else value
    return value.replace("\\'", "'")


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("aB1.,'\" \t- \\#", max_size=14), min_size=1, max_size=30))
def test_text_functions(spark, samples):
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = df.select(
        "s", tx.tokenize(F.col("s")).alias("t"), tx.unquote(F.col("s")).alias("u"),
        tx.strip(F.col("s")).alias("p"), tx.last_word(F.col("s")).alias("w"),
    ).collect()
    for row in got:
        assert row["t"] == tokens(row["s"])
        assert row["u"] == unquoted(row["s"])
        assert row["p"] == row["s"].strip()
        assert row["w"] == row["s"].split(" ")[-1]


@pytest.mark.parametrize(
    "raw, want",
    [("'Messi'", "Messi"), ("\"'Messi'\"", "Messi"), ("O\\'Neil", "O'Neil"), ("", ""), ("'", "")],
)
def test_unquote(spark, raw, want):
    assert one(spark, tx.unquote(F.col("s")), s=raw) == want


@pytest.mark.parametrize(
    "raw, want", [(" [ a ]\n", "a"), ("[[a]]", "[a]"), ("[a", "[a"), ("[]", ""), ("[", "["), ("", "")]
)
def test_unwrap(spark, raw, want):
    # A lone bracket both begins and ends with itself in no case: it stays.
    assert one(spark, tx.unwrap_result(F.col("s")), s=raw) == want


def test_labels(spark):
    rows = [(1, 0), (0, 1), (2, 2), (None, 1)]
    df = spark.createDataFrame(rows, "h int, a int")
    h, a = F.col("h"), F.col("a")
    got = df.select(
        labels.result_label(h, a), labels.winner(h, a, F.lit("H"), F.lit("A"))
    ).collect()
    assert [tuple(r) for r in got] == [("home-win", "H"), ("away-win", "A"), ("tie", None), ("-", None)]


def test_age_counts_whole_years(spark):
    df = spark.sql("SELECT DATE '2000-01-01' AS b UNION ALL SELECT DATE '2025-12-31'")
    got = df.select(labels.age_in_years(F.col("b"), F.to_date(F.lit("2026-01-01")))).collect()
    assert sorted(r[0] for r in got) == [0, 26]


def test_card_colour(spark):
    cards = spark.createDataFrame([("y2",), ("r",), ("x",), (None,)], "c string")
    assert [r[0] for r in cards.select(labels.card_colour(F.col("c"))).collect()] == ["y", "r", "x", None]


def test_strip_characters_match_python():
    assert set(tx.WHITE_SPACE) == {chr(c) for c in range(0x3001) if chr(c).isspace()}
    assert not set(tx.TOKEN_STRIP) & set(string.ascii_letters)
