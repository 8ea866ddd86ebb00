"""The piecewise path for large groups gives what a plain window gives."""

import pytest
from pyspark.sql import functions as F

from matchlore.operators.events import drop_repeats, short_form_allowed
from matchlore.operators.ordered import OrderedGroups, first_in_group, hash_ranked


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows, one key is NULL."""
    return spark.range(400).select(
        F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 == 7, None).otherwise(
            F.concat(F.lit("g"), (F.col("id") % 5).cast("string"))
        ).alias("g"),
        F.pmod(F.col("id") * 37, F.lit(400)).alias("t"),
        F.when(F.col("id") % 4 != 0, F.col("id") % 3).alias("v"),
    )


def collected(df):
    return sorted(map(tuple, df.collect()), key=repr)


def ordered_columns(df, limit):
    groups = OrderedGroups(df, ["g"], [F.col("t")], limit=limit)
    groups.number("n").previous(F.col("v"), "p").running_sum(F.col("v"), "s")
    groups.running_max(F.when(F.col("v") == 2, F.col("t")), "m")
    groups.running_max(F.when(F.col("v").isNotNull(), F.struct("t", "v")), "last")
    return groups


def test_pieces_equal_window(skewed):
    small, split = ordered_columns(skewed, 10**9), ordered_columns(skewed, 20)
    assert not small.split and split.split
    assert small.df.columns == split.df.columns
    assert collected(small.df) == collected(split.df)


def test_window_columns_by_hand(spark):
    rows = [("a", 1, None), ("a", 2, 5), ("a", 3, 2)]
    df = spark.createDataFrame(rows, "g string, t int, v int")
    got = collected(ordered_columns(df, 1).df.select("t", "n", "p", "s", "m"))
    assert got == [(1, 1, None, 0, None), (2, 2, None, 5, None), (3, 3, 5, 7, 3)]


@pytest.mark.parametrize("limit", [10**9, 15])
def test_repeats_and_short_forms_in_pieces(spark, skewed, limit):
    order = [F.col("t")]
    kept = collected(drop_repeats(skewed, ["g"], order, "v", limit=limit).select("g", "t"))
    forms = collected(
        short_form_allowed(skewed, ["g"], order, "v", limit=limit).select("g", "t", "short_form")
    )
    want_kept, want_forms = [], []
    groups = {}
    for g, t, v in collected(skewed):
        groups.setdefault(g, []).append((t, v))
    for g, rows in groups.items():
        rows.sort()
        used = False
        for i, (t, v) in enumerate(rows):
            if i == 0 or v != rows[i - 1][1]:
                want_kept.append((g, t))
            same = i > 0 and v is not None and v == rows[i - 1][1]
            used = same and not used
            want_forms.append((g, t, used))
    assert kept == sorted(want_kept, key=repr)
    assert forms == sorted(want_forms, key=repr)


@pytest.mark.parametrize("partitions", [1, 7])
def test_hash_rank_is_exact_and_stable(spark, partitions):
    import hashlib

    df = spark.range(500).repartition(partitions)
    got = {r["id"]: (r["rank"], r["n"]) for r in hash_ranked(df, ["id"], 42, "rank", "n", digits=1).collect()}
    order = sorted(range(500), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
    assert got == {key: (rank, 500) for rank, key in enumerate(order)}


def test_first_in_group(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 4, "z"), (2, 1, "c")], "k int, o int, v string")
    assert collected(first_in_group(df, ["k"], ["o"])) == [(1, 4, "z"), (2, 1, "c")]
