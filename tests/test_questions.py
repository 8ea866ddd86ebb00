import pytest
from pyspark.sql import functions as F

from matchlore.operators import questions as qs


@pytest.fixture(scope="module")
def asked(spark):
    """A hot match with two thirds of the questions; few distinct queries."""
    rows = []
    for key in range(120):
        match = 1 if key < 80 else 2 + key % 4
        rows.append((match, f"q{key:03}", f"query{key % 9}"))
    return spark.createDataFrame(rows, "match_id bigint, question_key string, query string")


@pytest.fixture(scope="module")
def answered(spark):
    rows = [(1, f"query{i}") for i in range(7)] + [(2, "query0"), (3, "query8"), (3, "none")]
    return spark.createDataFrame(rows, "match_id bigint, query string")


def allowed(asked, answered):
    results = {tuple(r) for r in answered.collect()}
    rows = [tuple(r) for r in asked.collect()]
    return {
        m: {k for own, k, q in rows if own != m and (m, q) not in results} for m in {r[0] for r in rows}
    }, {m: sum(r[0] == m for r in rows) for m in {r[0] for r in rows}}


@pytest.mark.parametrize("limit", [10**9, 10])
@pytest.mark.parametrize("repeats", [False, True])
def test_negatives_against_brute_force(asked, answered, limit, repeats):
    drawn = qs.negatives(
        asked, answered, "match_id", "question_key", "query", 7, allow_repeats=repeats, limit=limit
    ).collect()
    free, counts = allowed(asked, answered)
    for match, n in counts.items():
        mine = [r["question_key"] for r in drawn if r["match_id"] == match]
        assert set(mine) <= free[match]
        if repeats:
            assert len(mine) == (n // 4 + 1 if free[match] else 0)
        else:
            assert len(mine) == len(set(mine)) == min(n // 4 + 1, len(free[match]))


def test_pieces_and_partitions_do_not_change_the_draw(asked, answered):
    args = ("match_id", "question_key", "query", 7)
    plain = qs.negatives(asked, answered, *args).collect()
    pieces = qs.negatives(asked.repartition(13), answered, *args, limit=10).collect()
    assert sorted(plain) == sorted(pieces)
    assert sorted(plain) != sorted(qs.negatives(asked, answered, *args[:3], 8).collect())


@pytest.mark.parametrize("n, want", [(3, 1), (4, 2), (7, 2), (8, 3)])
def test_number_of_negatives(spark, n, want):
    rows = [(1, f"a{i}", "x") for i in range(n)] + [(2, f"b{i}", "y") for i in range(50)]
    asked = spark.createDataFrame(rows, "match_id bigint, question_key string, query string")
    none = asked.limit(0).select("match_id", "query")
    drawn = qs.negatives(asked, none, "match_id", "question_key", "query", 1)
    assert drawn.filter("match_id = 1").count() == want


def test_other_match_questions_skip_own(asked):
    for limit in (10**9, 10):
        drawn = qs.other_match_questions(asked, "match_id", "question_key", 7, limit=limit)
        own = drawn.join(asked.drop("query"), ["match_id", "question_key"])
        assert own.count() == 0
        assert drawn.count() == sum(n // 4 + 1 for n in allowed(asked, asked.limit(0).select("match_id", "query"))[1].values())


def test_cap():
    assert qs.event_question_cap() == 31


def test_cap_and_first_per_rule(spark):
    rows = [(1, f"r{i % 3}", i) for i in range(50)]
    df = spark.createDataFrame(rows, "match_id int, rule string, pos int")
    assert {tuple(r) for r in qs.one_per_rule(df, ["pos"]).collect()} == {(1, "r0", 0), (1, "r1", 1), (1, "r2", 2)}
    assert sorted(r["pos"] for r in qs.capped(df, ["pos"], 31).collect()) == list(range(31))


def test_empty_answers_and_categories(spark):
    rows = [("match", "", "-"), ("event", " ", "-"), ("event", "x", None)]
    df = spark.createDataFrame(rows, "level string, answer string, category string")
    kept = qs.drop_empty_answers(df)
    named = kept.select("level", qs.category_named(F.col("category")).alias("c")).collect()
    assert [tuple(r) for r in named] == [("match", "Simple"), ("event", None)]


def test_length_gate(spark):
    rows = [(1, "a\n\n" * 50), (2, "a\n \n" * 49)]
    df = spark.createDataFrame(rows, "match_id int, text string")
    assert [r[0] for r in qs.long_enough(df, "match_id").collect()] == [1]


def test_questions_without_query_count_but_are_not_put(spark):
    """Half of the queries are missing: every match still gets n div 4 + 1 negatives."""
    rows = [(m, f"{m}_{i}", f"q{m}_{i}" if i % 2 else None) for m in range(6) for i in range(8)]
    asked = spark.createDataFrame(rows, "match_id bigint, question_key string, query string")
    none = asked.limit(0).select("match_id", "query")
    drawn = qs.negatives(asked, none, "match_id", "question_key", "query", 5)
    got = drawn.groupBy("match_id").count().collect()
    assert {(r["match_id"], r["count"]) for r in got} == {(m, 3) for m in range(6)}
    assert drawn.filter("query IS NULL").count() == 0
    assert qs.shortfall(asked, drawn, "match_id").count() == 0
    assert {tuple(r) for r in qs.shortfall(asked, drawn.filter("match_id > 0"), "match_id").collect()} == {(0, 3, 3)}


@pytest.mark.parametrize("limit", [10**6, 3])
def test_matches_are_drawn_before_questions(spark, limit):
    """A match with one question is drawn as often as one with many; nothing answered or own comes out."""
    rows = [(m, f"{m}-{i}", f"q{i}" if m < 3 else f"r{m}") for m, n in ((0, 400), (1, 30), (2, 1), (3, 1), (4, 1)) for i in range(n)]
    rows.append((4, "4-none", None))
    asked = spark.createDataFrame(rows, "m long, k string, q string")
    answered = spark.createDataFrame([(0, f"q{i}") for i in range(200)] + [(1, "r3"), (2, "zzz"), (1, None)], "m long, q string")
    drawn = qs.negatives_by_match(asked, answered, "m", "k", "q", 5, limit).collect()
    per = {m: [r for r in drawn if r["m"] == m] for m in range(5)}
    assert [len(per[m]) for m in range(5)] == [101, 8, 1, 1, 1]
    assert all(not r["k"].startswith(f"{r['m']}-") and r["q"] is not None for r in drawn)
    # Match 0 has a result on all that matches 1 and 2 ask, so only 3 and 4 are left, 4 with half its weight on no query.
    hits = [r["k"].split("-")[0] for r in per[0]]
    assert set(hits) == {"3", "4"} and 50 < hits.count("3") < 85
    assert "r3" not in {r["q"] for r in per[1]}
    none = qs.negatives_by_match(asked.filter("m = 0"), answered, "m", "k", "q", 5, limit)
    assert none.count() == 0
