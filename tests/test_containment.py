import random

import numpy as np

from matchlore.operators import containment

NEEDLES = [
    (1, "two words"), (2, "the quick brown fox jumps"), (3, "x"), (4, ""), (5, None), (6, "é"), (7, "lazy dog"), (8, "a  b"),
    (9, "quick brown fox jumps over the lazy dog and runs"), (10, "\tthe quick"), (None, "fox"), (11, "nowhere to be found here"),
    (12, "ab"), (13, "abc"), (14, "fox jumps over "), (2, "lazy"), (15, "the the the the the"), (16, "𝒳y"), (17, "uick brown f"),
]
TEXTS = [
    (1, "the quick brown fox jumps over the lazy dog"), (2, "unquick brown fox jumpsuit"), (3, None), (4, ""), (5, "abcé two  words"),
    (6, "so the quick brown fox jumps over the lazy dog and runs. two words"), (7, "a  b a b"), (8, "the " * 40), (None, "fox"),
    (1, "lazy dog first"), (9, "x𝒳y abab\tthe quick"), (10, "fox jumps over\nthe"),
]


def brute(needles, texts):
    found = {}
    for i, n in needles:
        for j, t in texts:
            if i is not None and j is not None and n and t and n in t:
                found[i, j] = min(found.get((i, j), 10**9), t.index(n))
    return sorted((i, j, at) for (i, j), at in found.items())


def check(spark, needles, texts, **options):
    left = spark.createDataFrame(needles, "item long, needle string")
    right = spark.createDataFrame([(*t, "x") for t in texts], "doc long, text string, shingle string")
    found = containment.contained_in(left, right, "item", "doc", **options)
    assert found.columns == ["item", "doc", "first_position"]
    assert sorted(map(tuple, found.collect())) == brute(needles, texts)
    return found


def test_against_all_pairs(spark):
    check(spark, NEEDLES, TEXTS)
    check(spark, [], TEXTS)
    check(spark, NEEDLES, [])
    check(spark, [(1, "")], TEXTS)


def test_drawn_words(spark):
    drawn = random.Random(5)
    words = ["ab", "a", "ba", "é", "abc", "c"]

    def text(n):
        return "".join(drawn.choice(words) + drawn.choice([" ", " ", "\n", "  "]) for _ in range(n))

    texts = [(i, text(drawn.randint(0, 60))) for i in range(60)]
    needles = [(i, t[drawn.randint(0, 9) :][: drawn.randint(1, 25)]) for i, (_, t) in enumerate(texts)]
    check(spark, needles, texts, salts=3)


def test_plan_has_no_pairs(spark):
    found = check(spark, NEEDLES, TEXTS)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_a_shingle_in_every_text_is_dealt_out(spark):
    texts = [(i, f"one two three four five number {i}") for i in range(300)]
    check(spark, [(1, "one two three four five"), (2, "three four five number 7")], texts)


def test_shingles_are_found_for_whole_batches(spark):
    """Made per character by interpreted functions they took most of the time of a search for short needles."""
    texts = spark.range(1).selectExpr("id AS doc", "'one two three' AS text")
    wanted = spark.range(1).selectExpr("id AS shingle")
    plan = containment.index_of(texts, "doc", "text", wanted, containment.LEVELS)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "lambdafunction" not in plan


def test_words_and_bytes_make_the_same_shingles_anywhere():
    def shingles(level, text):
        return set(containment.Level(*level).shingles(np.frombuffer(text.encode(), np.uint8)).tolist())

    assert shingles((1, True), " \tab  cé\nab ") == shingles((1, True), "cé ab") and len(shingles((1, True), "ab cé")) == 2
    assert shingles((3, True), "x a b\n\nc d y") >= shingles((3, True), "a b c d")
    assert shingles((4, False), "xxabcdé") >= shingles((4, False), "abcdé")
    assert not shingles((3, True), "a b") and not shingles((4, False), "abc") and not shingles((1, True), " \n")
    assert not shingles((1, True), "ab ba a b") & shingles((1, True), "abb aab")
    levels = [shingles((level.size, level.words), "abcd abcd abcd") for level in containment.LEVELS]
    assert sum(map(len, levels)) == len(set().union(*levels))
