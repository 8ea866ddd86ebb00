"""Several changes of one fact, each seeing what the one before has left.

A change sets ``new`` where the value is still ``expected``. The changes of a key that has few of them are a sorted array,
folded in one expression. A key with very many is not put into one row: there every change is linked to
the next one that expects what it sets, and the links are followed by doubling, so that a chain of n changes
takes log n joins over rows that are spread by key and value.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlore.operators.ordered import GROUP_LIMIT, OrderedGroups
from matchlore.session import kept_table

ARRAY_LIMIT = 10_000


def _renamed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys under names of their own, so that a table can meet one that came out of it."""
    return df.withColumnsRenamed({key: f"__of_{key}" for key in keys})


def _matches(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(key) == F.col(f"__of_{key}") for key in keys])


def compare_and_set_in_order(
    facts: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    array_limit: int = ARRAY_LIMIT,
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """(keys, value, changes): every fact after all updates of its key in order, and how many of them took effect.

    ``facts`` has (keys, value), ``updates`` (keys, expected, new, order columns). NULL is a value like any other: it is expected by a
    NULL and set by one. Updates that tie in ``order`` go by expected, then new. Several facts of one key are changed each
    by itself; updates of a key without fact do nothing, nor does one that is NULL in a key.
    """
    keys, order = list(keys), list(order)
    value = facts.schema["value"].dataType
    steps = updates.select(*keys, *order, F.col("expected").cast(value).alias("expected"), F.col("new").cast(value).alias("new"))
    steps = steps.dropna(subset=keys)
    counts = kept_table(steps.groupBy(*keys).agg(F.count(F.lit(1)).alias("__updates")), "change-counts")
    many = counts.filter(F.col("__updates") > array_limit).select(*keys)
    few = steps.join(many, keys, "left_anti")
    ranked = F.array_sort(F.collect_list(F.struct(*order, "expected", "new")))
    arrays = few.groupBy(*keys).agg(ranked.alias("__steps"))
    named = facts.select(*keys, "value")
    folded = named.join(many, keys, "left_anti").join(arrays, keys, "left").select(
        *keys, _fold(F.col("value"), F.col("__steps")).alias("__end")
    )
    light = folded.select(*keys, "__end.value", "__end.changes")
    if not many.limit(1).count():
        return light
    heavy = _followed(named.join(many, keys, "left_semi"), steps.join(many, keys, "left_semi"), keys, order, limit)
    return light.unionByName(heavy)


def _fold(value: Column, steps: Column) -> Column:
    """(value, changes) after the steps of one key."""

    def step(state: Column, change: Column) -> Column:
        applies = state["value"].eqNullSafe(change["expected"])
        return F.struct(
            F.when(applies, change["new"]).otherwise(state["value"]).alias("value"),
            (state["changes"] + applies.cast("bigint")).alias("changes"),
        )

    start = F.struct(value.alias("value"), F.lit(0).cast("bigint").alias("changes"))
    return F.coalesce(F.aggregate(steps, start, step), start)


def _followed(facts: DataFrame, steps: DataFrame, keys: list[str], order: list[str], limit: int) -> DataFrame:
    """The same for keys with any number of updates."""
    by_time = [F.col(c) for c in (*order, "expected", "new")]
    timed = OrderedGroups(steps, keys, by_time, limit).number("__time").df.select(*keys, "expected", "new", "__time")
    timed = kept_table(timed, "change-steps")
    # What asks for a successor: the updates, and the different values that facts start with at time 0.
    starts = facts.select(*keys, F.col("value").alias("__holds")).distinct().withColumn("__time", F.lit(0).cast("bigint"))
    asking = timed.select(*keys, F.col("new").alias("__holds"), "__time").unionByName(starts)
    both = asking.withColumn("__offer", F.lit(0)).unionByName(
        timed.select(*keys, F.col("expected").alias("__holds"), "__time").withColumn("__offer", F.lit(1))
    )
    # From the last to the first, the offer seen last is the next one in time; an update is not its own successor.
    backwards = OrderedGroups(both, [*keys, "__holds"], [F.col("__time").desc(), F.col("__offer")], limit)
    nearest = F.when(F.col("__offer") == 1, -F.col("__time"))
    linked = backwards.running_max(nearest, "__next").df.filter("__offer = 0")
    nodes = linked.select(*keys, "__holds", "__time", (-F.col("__next")).alias("__next"))
    # Starts of one key share the time 0 and differ in what they hold.
    nodes = kept_table(nodes.withColumn("__hops", F.col("__next").isNotNull().cast("bigint")), "change-links")
    nodes = nodes.withColumn("__last", F.lit(None).cast("bigint"))
    ends = _renamed(nodes.filter("__time > 0").select(*keys, F.col("__time").alias("__to"), F.col("__holds").alias("__end")), keys)
    while nodes.filter("__next IS NOT NULL").limit(1).count():
        # A successor is an update, so its time names it. What has no successor is where a chain ends.
        onward = nodes.filter("__time > 0").select(
            *keys, F.col("__time").alias("__next"), F.col("__next").alias("__then"), F.col("__hops").alias("__more"),
            F.coalesce("__last", "__time").alias("__reached"),
        )
        jumped = nodes.join(onward, [*keys, "__next"], "left").select(
            *keys, "__time", "__holds", F.col("__then").alias("__next"),
            (F.col("__hops") + F.coalesce("__more", F.lit(0))).alias("__hops"),
            F.when(F.col("__next").isNotNull(), F.col("__reached")).otherwise(F.col("__last")).alias("__last"),
        )
        nodes = kept_table(jumped, "change-links")
    arrived = nodes.filter("__time = 0").join(ends, _matches(keys) & (F.col("__last") == F.col("__to")), "left")
    end = F.when(F.col("__last").isNull(), F.col("__holds")).otherwise(F.col("__end")).alias("__end")
    final = _renamed(arrived.select(*keys, "__holds", "__hops", end), keys)
    found = facts.join(final, _matches(keys) & F.col("value").eqNullSafe(F.col("__holds")))
    return found.select(*keys, F.col("__end").alias("value"), F.col("__hops").alias("changes"))
