"""Mixing sources to target weights by capped water-filling.

Sources share a total in proportion to their weights. A source stops at a number
of epochs of its own size, and what it leaves is shared among the others by
weight: the level at which this settles is read off one running sum over the
sources in the order in which they fill up. Each document is then repeated a
whole number of times, and the rest of a target is filled by further repetitions
in a seeded order of documents, so reruns agree. Only DataFrame functions are used.

The seeded order is by md5 of seed and id. Running sums over it are taken in two
steps, over counts of 65,536 hash ranges and then inside the one range in which
a source reaches its target, so no task sees all rows of a source.

Defined results: a null text has size 0, a null source is a source of its own and
sorts last; documents of size 0 are taken 0 times; repeated rows each count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from matchlore.llm.shared import small, stored

WEIGHTS = (5.0, 2.0, 1.0)
_RANGE_DIGITS = 4


def text_size(text: str = "text") -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, share: float = 1.5, epochs: float = 2.0, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """One row per source: its size, weight and target.

    ``sizes`` has ``source`` and ``source_size``. Sources by code point, null last, take the
    weights in turn. With the sources in order of cap / weight, one is clamped as long as its
    cap is below its part of what the ones before it leave.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place + 1)
    listed = sizes.withColumn("weight", weight).withColumn("cap", epochs * F.col("source_size"))
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    onward = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum(
        "weight"
    ).over(onward)
    levelled = listed.withColumn("level", level)
    clamped = F.col("cap") <= F.col("weight") * F.col("level")
    # the first source that is not clamped has the final level
    final = F.min(F.when(~clamped, F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(everything)
    return levelled.select(
        "source", "source_size", "weight",
        F.when(clamped, F.col("cap")).otherwise(F.col("weight") * final["level"]).alias("target"),
    )


def _key(seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def cuts(sized: DataFrame, seed: int = 42, share: float = 1.5, epochs: float = 2.0,
         weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """One row per source: its size and target, and what decides its repetitions.

    Every document is taken ``_whole`` times; those whose seeded key comes before ``_cut`` once
    more; at the key ``_cut``, where documents of ``_peers`` words stand, ``_left`` words are missing.
    ``sized`` (doc_id, source, size) is read twice, so pass a stored table.
    """
    keyed = sized.select("source", "size", _key(seed).alias("_key"))
    keyed = keyed.withColumn("_range", F.substring("_key", 1, _RANGE_DIGITS))
    ranges = stored(keyed.groupBy("source", "_range").agg(F.sum("size").alias("range_size")), "mixing-ranges")
    per_source = targets(ranges.groupBy("source").agg(F.sum("range_size").alias("source_size")), share, epochs, weights)
    rate = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    goals = stored(
        per_source.select(
            F.col("source").alias("_source"), "source_size", "target", rate.cast("long").alias("_whole"),
            F.round(F.col("target") - rate * F.col("source_size")).cast("long").alias("_rest"),
        ),
        "mixing-goals",
    )
    running = ranges.withColumn("_upto", F.sum("range_size").over(Window.partitionBy("source").orderBy("_range")))
    edges = running.join(goals, running["source"].eqNullSafe(goals["_source"])).where(
        (F.col("_upto") >= F.col("_rest")) & (F.col("_upto") - F.col("range_size") < F.col("_rest"))
    ).select(
        F.col("_source").alias("_edge_source"), F.col("_range").alias("_edge"),
        (F.col("_rest") - F.col("_upto") + F.col("range_size")).alias("_want"),
    )
    edges = small(stored(edges, "mixing-edges"), 10_000)
    near = keyed.join(edges, keyed["source"].eqNullSafe(edges["_edge_source"]) & (keyed["_range"] == edges["_edge"]))
    keys = near.groupBy("_edge_source", "_key", "_want").agg(F.sum("size").alias("_peers"))
    upto = F.sum("_peers").over(Window.partitionBy("_edge_source").orderBy("_key"))
    first = (
        keys.withColumn("_upto", upto).where("_upto >= _want").groupBy("_edge_source")
        .agg(F.min(F.struct("_key", "_peers", (F.col("_want") - F.col("_upto") + F.col("_peers")).alias("_left"))).alias("_at"))
    )
    return goals.join(first, goals["_source"].eqNullSafe(first["_edge_source"]), "left").select(
        "_source", "source_size", "target", "_whole",
        F.col("_at._key").alias("_cut"), F.col("_at._peers").alias("_peers"), F.col("_at._left").alias("_left"),
    )


def mix(sized: DataFrame, seed: int = 42, **options) -> DataFrame:
    """``sized`` (doc_id, source, size) with source_size, target and taken words.

    A source takes every document floor(target / size) times and, in seeded order, further
    ones until the target is reached; the last gives only the words that are missing (a
    fractional repetition). Among rows of the same id that stand there, shorter ones come first.
    """
    goals = small(stored(cuts(sized, seed, **options), "mixing-cuts"), 10_000)
    joined = sized.withColumn("_key", _key(seed)).join(goals, sized["source"].eqNullSafe(goals["_source"]), "left")
    at_cut = F.coalesce(F.col("_key") == F.col("_cut"), F.lit(False))
    inside = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    missing = F.col("_left") - (F.sum("size").over(inside) - F.col("size"))
    partly = joined.where(at_cut).withColumn("_part", F.greatest(F.lit(0), F.least("size", missing)))
    apart = joined.where(~at_cut).withColumn("_part", F.when(F.col("_key") < F.col("_cut"), F.col("size")).otherwise(0))
    taken = (F.col("_whole") * F.col("size") + F.col("_part")).cast("long")
    return partly.unionByName(apart).select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))


def mixed_sizes(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target and taken of every document."""
    sized = stored(docs.select("doc_id", "source", text_size().alias("size")), "mixing-sizes")
    return mix(sized, **options).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, seed: int = 42, **options) -> DataFrame:
    """The documents of the mix with all their columns; one row per repetition.

    Documents stay whole: those at the cut are taken if that brings the source nearer
    to its target. Each row is decided by itself against its source's cut, so no text is shuffled.
    """
    names = docs.columns
    sized = stored(docs.select("doc_id", "source", text_size().alias("size")), "mixing-sizes")
    goals = small(stored(cuts(sized, seed, **options), "mixing-cuts"), 10_000)
    goals = goals.select("_source", "_whole", "_cut", "_peers", "_left")
    joined = docs.withColumn("_key", _key(seed)).join(goals, docs["source"].eqNullSafe(goals["_source"]), "left")
    more = (F.col("_key") < F.col("_cut")) | ((F.col("_key") == F.col("_cut")) & (2 * F.col("_left") >= F.col("_peers")))
    times = F.col("_whole") + F.coalesce(more, F.lit(False)).cast("long")
    repeated = joined.where(times > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), times)))
    return repeated.select(*names)
