"""Ordered changes, chains of questions and carried values against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from matchlore.operators import changes
from matchlore.operators import events as ev
from matchlore.operators import facts as fx

VALUES = ("a", "b", "c", None)


def folded(facts, updates):
    found = []
    for key, value in facts:
        n = 0
        mine = [u for u in updates if u[0] == key and key is not None]
        for _, _, expected, new in sorted(mine, key=lambda u: (u[1], u[2] is not None, u[2] or "", u[3] is not None, u[3] or "")):
            if value == expected:
                value, n = new, n + 1
        found.append((key, value, n))
    return sorted(found, key=str)


@pytest.mark.parametrize("array_limit,limit", [(10_000, 10_000), (3, 10_000), (0, 4)])
def test_changes_in_order(spark, array_limit, limit):
    drawn = random.Random(7)
    facts = [(k, drawn.choice(VALUES)) for k in range(12)] + [(3, "a"), (3, "b"), (3, "a"), (None, "a"), (99, "c")]
    updates = [(drawn.choice([0, 1, 2, 3, 3, 3, 3, 5, 77]), drawn.randint(0, 30), drawn.choice(VALUES), drawn.choice(VALUES)) for _ in range(150)]
    updates += [(None, 1, "a", "b"), (3, 4, "a", "a")]
    left = spark.createDataFrame(facts, "k int, value string")
    right = spark.createDataFrame(updates, "k int, at int, expected string, new string").repartition(3)
    got = changes.compare_and_set_in_order(left, right, ["k"], ["at"], array_limit, limit)
    assert sorted(map(tuple, got.collect()), key=str) == folded(facts, updates)


def test_a_long_chain_of_one_key(spark):
    steps = [(1, i, str(i % 50), str((i + 1) % 50)) for i in range(400)]
    facts = spark.createDataFrame([(1, "0"), (1, "7"), (1, "none"), (2, "0")], "k int, value string")
    updates = spark.createDataFrame(steps, "k int, at int, expected string, new string")
    got = changes.compare_and_set_in_order(facts, updates, ["k"], ["at"], array_limit=10)
    assert sorted(map(tuple, got.collect())) == folded([(1, "0"), (1, "7"), (1, "none"), (2, "0")], steps)
    none = changes.compare_and_set_in_order(facts, updates.limit(0), ["k"], ["at"])
    assert sorted(r["value"] for r in none.collect()) == ["0", "0", "7", "none"]
    assert changes.compare_and_set_in_order(facts.limit(0), updates, ["k"], ["at"], array_limit=10).count() == 0


def test_repeated_updates_do_not_multiply(spark):
    facts = spark.createDataFrame([(1, "a"), (2, None), (3, "x")], "k int, value string")
    updates = spark.createDataFrame([(1, "a", "c"), (1, "a", "b"), (1, "b", "z"), (2, None, "n"), (3, "a", "q")], "k int, expected string, new string")
    got = fx.compare_and_set(facts, updates, ["k"])
    assert sorted(map(tuple, got.collect())) == [(1, "b"), (2, "n"), (3, "x")]


def asked_in_turn(start, steps):
    found = []
    for key, *args in start:
        value, at = None, 0
        for number, (rows, gives, takes, order) in enumerate(steps, 1):
            fitting = [
                r for r in rows
                if r["k"] == key and len(args) >= len(takes) and all(a is not None and r[c] is not None and str(r[c]) == a for c, a in zip(takes, args))
            ]
            if fitting:
                none_first = [(*[(r[c] is not None, r[c] or 0) for c in order], [(r[c] is not None, str(r[c] or "")) for c in gives]) for r in fitting]
                first = fitting[none_first.index(min(none_first))]
                value = args = [None if first[c] is None else str(first[c]) for c in gives]
                at = number
        found.append((key, value, at))
    return sorted(found)


def test_chains_of_any_length(spark):
    drawn = random.Random(3)
    names = ("p", "q", "r")
    tables = [
        [{"k": drawn.randint(0, 9), **{c: drawn.choice([None, 1, 2, 3]) for c in names}, "o": drawn.randint(0, 5)} for _ in range(40)]
        for _ in range(5)
    ]
    plan = [(["p"], []), (["q", "r"], ["q"]), (["p"], ["r", "p"]), (["r", "q", "p"], ["p"]), (["q"], ["q", "p", "r"])]
    steps, plain = [], []
    for rows, (gives, takes) in zip(tables, plan):
        df = spark.createDataFrame([tuple(r.values()) for r in rows], "k int, p int, q int, r int, o int")
        steps.append(fx.Step(df, gives, takes, ["o"]))
        plain.append((rows, gives, takes, ["o"]))
    start = spark.createDataFrame([(k, str(k % 3 + 1)) for k in range(12)], "k int, a string")
    got = sorted((r["k"], r["value"], r["step"]) for r in fx.chain(start, steps[1:], "k", ["a"]).collect())
    assert got == asked_in_turn([(k, str(k % 3 + 1)) for k in range(12)], plain[1:])
    got = sorted((r["k"], r["value"], r["step"]) for r in fx.chain(start, steps, "k").collect())
    assert got == asked_in_turn([(k,) for k in range(12)], plain)
    assert fx.chain(start, [], "k").filter("value IS NULL AND step = 0").count() == 12


def walked(rows, hold):
    """rows of one group in order: (pos, subject or None, own kind)."""
    state, found = None, {}
    for pos, subject, kind in rows:
        used = state is not None and state[0] == kind
        found[pos] = (state, used)
        own = (subject, pos) if subject is not None else None
        state = None if used else own if own or not hold else state
    return found


@pytest.mark.parametrize("hold", [True, False])
@pytest.mark.parametrize("limit", [10**6, 7])
def test_carried_values(spark, hold, limit):
    drawn = random.Random(11)
    rows = [(g, p, drawn.choice([None, "x", "x", "y"]), drawn.choice(["x", "x", "y", None])) for g in (1, 2, 3) for p in range(60)]
    rows += [(None, p, "x", "x") for p in range(9)]
    df = spark.createDataFrame(rows, "g int, p int, subject string, kind string").repartition(3)
    values = F.when(F.col("subject").isNotNull(), F.struct("subject", F.col("p").alias("source")))
    got = ev.carried_values(df, ["g"], [F.col("p")], values, lambda c: c["subject"] == F.col("kind"), hold, limit=limit)
    assert got.columns == [*df.columns, "carried", "carried_used"]
    found = {(r["g"], r["p"]): (tuple(r["carried"]) if r["carried"] else None, r["carried_used"]) for r in got.collect()}
    for g in (1, 2, 3, None):
        expected = walked([r[1:] for r in rows if r[0] == g], hold)
        assert {p: v for (h, p), v in found.items() if h == g} == expected
