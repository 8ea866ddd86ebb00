"""Ordered work inside groups (numbering, previous row, running values) that
survives a group holding a large part of the table.

A window over ``partitionBy(group)`` puts a group into one task. That is the
right plan while groups are small, so their size is checked first. Beyond the
limit the table is range-partitioned by (group, order): a large group becomes
many consecutive pieces, every piece is handled by its own window, and what a
piece needs from its predecessors comes from a table with one row per piece.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlore.functions.sampling import seed_hash
from matchlore.session import reliable

GROUP_LIMIT = 2_000_000
_PIECE, _AT, _CARRY = "__piece", "__at", "__carry"


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality of all keys: a group whose key is NULL is a group too."""
    return reduce(lambda a, b: a & b, [left[key].eqNullSafe(right[key]) for key in keys])


class OrderedGroups:
    """``OrderedGroups(df, ["match_id"], [F.col("minute")]).number("pos").df``

    ``order`` must be total within a group. ``largest`` skips the size check
    when the caller knows a bound on the rows per group.
    """

    def __init__(
        self,
        df: DataFrame,
        group: Sequence[str],
        order: Sequence[Column],
        limit: int = GROUP_LIMIT,
        largest: int | None = None,
    ) -> None:
        self.group, self.order = list(group), list(order)
        if largest is None:
            largest = largest_group(df, self.group)
        self.split = largest > limit
        if self.split:
            df = _pieces(df, self.group, self.order, -(-df.count() // limit))
        self.df_with_pieces = df
        keys = self.group + ([_PIECE] if self.split else [])
        self.window = Window.partitionBy(*keys).orderBy(*self.order)
        if self.split:
            self.df_with_pieces = df.withColumn(_AT, F.row_number().over(self.window))

    @property
    def df(self) -> DataFrame:
        return self.df_with_pieces.drop(_PIECE, _AT)

    def number(self, name: str, start: int = 1) -> OrderedGroups:
        """Consecutive BIGINT numbers from ``start``."""
        local = F.row_number().over(self.window).cast("bigint") + (start - 1)
        return self._add(
            name,
            local,
            F.count(F.lit(1)),
            lambda earlier: F.sum(_CARRY).over(earlier),
            lambda here, carried: here + F.coalesce(carried, F.lit(0)),
        )

    def running_sum(self, value: Column, name: str) -> OrderedGroups:
        """Sum up to and including the row; NULL counts as zero."""
        value = F.coalesce(value, F.lit(0))
        return self._add(
            name,
            F.sum(value).over(self._up_to_here()),
            F.sum(value),
            lambda earlier: F.sum(_CARRY).over(earlier),
            lambda here, carried: here + F.coalesce(carried, F.lit(0)),
        )

    def running_max(self, value: Column, name: str) -> OrderedGroups:
        """Largest value so far, NULLs skipped; structs compare field by field."""
        return self._add(
            name,
            F.max(value).over(self._up_to_here()),
            F.max(value),
            lambda earlier: F.max(_CARRY).over(earlier),
            lambda here, carried: F.greatest(here, carried),
        )

    def previous(self, value: Column, name: str) -> OrderedGroups:
        """The value in the row before, NULL in the first row of a group."""
        return self._add(
            name,
            F.lag(value).over(self.window),
            F.max_by(value, F.col(_AT)),
            lambda earlier: F.lag(_CARRY).over(
                Window.partitionBy(*self.group).orderBy(_PIECE)
            ),
            lambda here, carried: F.when(F.col(_AT) == 1, carried).otherwise(here),
        )

    def _up_to_here(self):
        return self.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def _add(self, name, local, piece_value, carry, combine) -> OrderedGroups:
        df = self.df_with_pieces
        if not self.split:
            self.df_with_pieces = df.withColumn(name, local)
            return self
        keys = self.group + [_PIECE]
        # One row per piece: at most as many per group as there are pieces.
        earlier = (
            Window.partitionBy(*self.group)
            .orderBy(_PIECE)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        carried = (
            df.groupBy(*keys)
            .agg(piece_value.alias(_CARRY))
            .withColumn(_CARRY, carry(earlier))
        )
        here = df.withColumn(name, local)
        joined = here.join(carried, same_keys(here, carried, keys), "left").select(
            *[here[column] for column in here.columns], carried[_CARRY]
        )
        self.df_with_pieces = joined.withColumn(
            name, combine(F.col(name), F.col(_CARRY))
        ).drop(_CARRY)
        return self


def largest_group(df: DataFrame, group: Sequence[str]) -> int:
    """Rows of the largest group: one pass over the key columns, counted before the shuffle."""
    counts = df.groupBy(*group).agg(F.count(F.lit(1)).alias("rows"))
    return counts.agg(F.max("rows").alias("largest")).first()["largest"] or 0


def _pieces(df: DataFrame, group: list[str], order: list[Column], wanted: int) -> DataFrame:
    spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(
        max(spread, wanted, 2), *[F.col(key) for key in group], *order
    ).withColumn(_PIECE, F.spark_partition_id())
    # The piece numbers are read more than once, so they must not be recomputed.
    return reliable(ranged)


def hash_ranked(
    df: DataFrame,
    keys: Sequence[str],
    seed: int,
    name: str = "rank",
    total: str | None = None,
    digits: int = 3,
) -> DataFrame:
    """0-based exact rank of every row in the seeded order of its (unique) keys.

    Rows fall into 16**digits buckets by the leading digits of their hash. The
    bucket counts are a table of that many rows at most, hence the broadcast.
    """
    hashed = df.withColumn("__hash", seed_hash(seed, *[F.col(key) for key in keys]))
    hashed = hashed.withColumn("__bucket", F.substring("__hash", 1, digits))
    by_bucket = Window.orderBy("__bucket")
    before = by_bucket.rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        hashed.groupBy("__bucket")
        .agg(F.count(F.lit(1)).alias("__rows"))
        .select(
            "__bucket",
            F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"),
            F.sum("__rows").over(Window.partitionBy()).alias("__total"),
        )
    )
    inside = Window.partitionBy("__bucket").orderBy("__hash", *keys)
    ranked = hashed.join(F.broadcast(counts), "__bucket").withColumn(
        name, F.col("__before") + F.row_number().over(inside) - 1
    )
    if total:
        ranked = ranked.withColumn(total, F.col("__total"))
    return ranked.drop("__hash", "__bucket", "__before", "__total")


def first_in_group(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first by ``order``, then by all other columns.

    An aggregate, not a window: every task keeps one row per key before the shuffle.
    """
    order = [column for column in order if column not in keys]
    rest = [column for column in df.columns if column not in keys and column not in order]
    ranked = F.min(F.struct(*order, *rest)).alias("__first")
    return df.groupBy(*keys).agg(ranked).select(*keys, "__first.*").select(*df.columns)
