"""Histograms and term counts over events and texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlore.functions.text import count_filled_lines, tokenize


def histogram(df: DataFrame, value: Column, name: str = "value") -> DataFrame:
    return df.groupBy(value.cast("bigint").alias(name)).agg(F.count(F.lit(1)).alias("n"))


def events_per_match(matches: DataFrame, events: DataFrame, key: str = "match_id") -> DataFrame:
    """Histogram of events per match; matches without events count as zero.

    Events are counted per match before they meet the matches.
    """
    counts = events.groupBy(key).agg(F.count(F.lit(1)).alias("__events"))
    joined = matches.select(key).join(counts, key, "left")
    return histogram(joined, F.coalesce("__events", F.lit(0)), "events")


def line_histogram(documents: DataFrame, text: str = "text") -> DataFrame:
    return histogram(documents, count_filled_lines(F.col(text)), "lines")


def token_histogram(documents: DataFrame, text: str = "text") -> DataFrame:
    return histogram(documents, F.size(tokenize(F.col(text))), "tokens")


def unique_token_histogram(documents: DataFrame, text: str = "text") -> DataFrame:
    return histogram(documents, F.size(F.array_distinct(tokenize(F.col(text)))), "tokens")


def term_frequency(documents: DataFrame, text: str = "text") -> DataFrame:
    # The outer form: the plain one makes Spark tokenize once more to filter by size.
    terms = documents.select(F.explode_outer(tokenize(F.col(text))).alias("term"))
    return terms.filter(F.col("term").isNotNull()).groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def top_and_rest(counts: DataFrame, key: str, count: str = "n", top: int = 10) -> DataFrame:
    """The ``top`` largest counts (ties by key) and one row ``rest`` with the sum of the others."""
    best = counts.select(F.col(key).cast("string").alias(key), count).orderBy(
        F.desc(count), key
    ).limit(top)
    rest = (
        counts.agg(F.sum(count).alias(count))
        .unionByName(best.agg((-F.sum(count)).alias(count)))
        .agg(F.coalesce(F.sum(count), F.lit(0)).alias(count))
        .select(F.lit(None).cast("string").alias(key), count)
    )
    return best.withColumn("is_rest", F.lit(False)).unionByName(
        rest.withColumn("is_rest", F.lit(True))
    )
