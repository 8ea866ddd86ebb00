"""Which texts of one table occur in which texts of another, without comparing all pairs.

An inverted index over shingles finds candidates by equi-join. A needle that occurs in a text brings the
words inside it along unchanged, so every run of words that is bounded by white space on both sides within the
needle is a run of whole words of the text as well. Needles too short for that are looked up by runs of
bytes. Each needle is looked up by the one of its shingles that the fewest texts have; if
some shingle is in no text, neither is the needle. What is found is verified by an exact search.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlore.session import kept_table

_SPACE = r"[\x20\x09-\x0D]+"


# Rows of postings a task hands over at once.
_BATCH = 1 << 18
# Odd numbers: words are hashed by powers of one, modulo 2**64, and put together and mixed by the others.
_BASE, _NEXT, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xBF58476D1CE4E5B9)
_IS_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


@dataclass(frozen=True)
class Level:
    """Shingles of ``size`` words (inside a needle) or of ``size`` bytes, eight at most, of the text in UTF-8."""

    size: int
    words: bool

    def fits(self, needle: Column) -> Column:
        """Whether a needle can be looked up at this level: it takes two more words, as its outer words may be parts."""
        return F.size(F.split(needle, _SPACE, -1)) >= self.size + 2 if self.words else F.octet_length(needle) >= self.size

    def inner(self, needle: Column) -> Column:
        """The part of a needle whose shingles a text holding it must have."""
        tokens = F.split(needle, _SPACE, -1)
        return F.array_join(F.slice(tokens, 2, F.size(tokens) - 2), " ") if self.words else needle

    def shingles(self, data: np.ndarray) -> np.ndarray:
        """Hashes of the different runs of ``size`` tokens; the level goes into them as well."""
        tokens = _word_hashes(data) if self.words else data.astype(np.uint64)
        runs = max(len(tokens) - self.size + 1, 0)
        factor = _NEXT if self.words else np.uint64(256)
        hashed = np.zeros(runs, np.uint64)
        for at in range(self.size):
            hashed = hashed * factor + tokens[at : at + runs]
        hashed = (hashed ^ (hashed >> np.uint64(31))) * _MIX + np.uint64(2 * self.size + self.words)
        return np.unique(hashed).view(np.int64)


# Longest first: a needle is looked up at the first level it is long enough for.
LEVELS = (Level(3, True), Level(1, True), Level(4, False), Level(3, False), Level(2, False), Level(1, False))


def _word_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of each word: the difference of two running sums, divided by the power the word starts with."""
    edges = np.flatnonzero(np.diff(_IS_SPACE[data].astype(np.int8), prepend=1, append=1))
    starts, ends = edges[::2], edges[1::2]
    powers = np.cumprod(np.full(len(data), _BASE), dtype=np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers, dtype=np.uint64)])
    inverse = np.cumprod(np.full(len(data), pow(int(_BASE), -1, 1 << 64), np.uint64), dtype=np.uint64)
    hashed = (sums[ends] - sums[starts]) * inverse[starts]
    return (hashed ^ (hashed >> np.uint64(29))) * _MIX


def _postings(texts: DataFrame, key: str, text: str, levels: Sequence[Level]) -> DataFrame:
    """(key, shingle): the different shingles of each row's text, on all levels."""
    rows = texts.select(key, F.col(text).alias("__text")).filter(F.col("__text").isNotNull())

    def batch(keys: pa.Array, at: list[int], found: list[np.ndarray]) -> pa.RecordBatch:
        repeated = keys.take(pa.array(np.repeat(at, [len(hashes) for hashes in found]), pa.int64()))
        return pa.RecordBatch.from_arrays([repeated, pa.array(np.concatenate(found))], names=[key, "shingle"])

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            keys, at, found, size = given.column(0), [], [], 0
            for number, value in enumerate(given.column(1)):
                data = np.frombuffer(value.as_buffer(), np.uint8)
                for level in levels:
                    at.append(number)
                    found.append(level.shingles(data))
                    size += len(found[-1])
                if size >= _BATCH:
                    yield batch(keys, at, found)
                    at, found, size = [], [], 0
            if size:
                yield batch(keys, at, found)

    return rows.mapInArrow(shingled, T.StructType([rows.schema[key], T.StructField("shingle", T.LongType())]))


def _with_level(needles: DataFrame, text: str, levels: Sequence[Level]) -> DataFrame:
    """Adds ``__level`` (the index of the needle's level) and ``__inner``; empty needles have no level."""
    number, inner = F.lit(None).cast("int"), F.lit(None).cast("string")
    for at in reversed(range(len(levels))):
        fits = levels[at].fits(F.col(text)) & (F.length(text) > 0)
        number = F.when(fits, at).otherwise(number)
        inner = F.when(fits, levels[at].inner(F.col(text))).otherwise(inner)
    return needles.withColumn("__level", number).withColumn("__inner", inner)


def index_of(texts: DataFrame, key: str, text: str, wanted: DataFrame, levels: Sequence[Level]) -> DataFrame:
    """(shingle, key): in which texts the ``wanted`` (shingle) occur. Other postings never leave their task
    if ``wanted`` is small enough to be broadcast. A posting comes once for each row of its key that has the shingle."""
    postings = _postings(texts.filter(F.col(key).isNotNull()), key, text, levels)
    return postings.join(wanted, "shingle", "left_semi")


def contained_in(
    needles: DataFrame,
    texts: DataFrame,
    needle_key: str,
    text_key: str,
    needle: str = "needle",
    text: str = "text",
    salts: int = 16,
) -> DataFrame:
    """(needle_key, text_key, first_position): where each needle first occurs in each text, 0-based.

    Null and empty needles occur nowhere; rows without a key are left out. Rows of one key are alternatives: a pair is found if any
    needle of its key occurs in any text of its key, and has the least position.

    The postings are kept, as they give both the frequencies and the candidates. A shingle that is the rarest one
    of a needle and yet in very many texts meets its needles in ``salts`` tasks instead of one.
    """
    given = _with_level(
        needles.select(F.col(needle_key).alias("__needle_key"), F.col(needle).alias("__needle")).filter(
            F.col("__needle_key").isNotNull()
        ).distinct(),
        "__needle", LEVELS,
    ).filter(F.col("__level").isNotNull())
    given = kept_table(given.withColumn("__id", F.xxhash64("__needle_key", "__needle")), "containment-needles")
    used = sorted(row[0] for row in given.select("__level").distinct().collect())
    levels = [LEVELS[at] for at in used or [0]]
    of_level = [_postings(given.filter(F.col("__level") == LEVELS.index(level)), "__id", "__inner", [level]) for level in levels]
    of_needles = kept_table(reduce(DataFrame.union, of_level), "containment-postings")
    wanted = kept_table(of_needles.select("shingle").distinct(), "containment-shingles")
    index = kept_table(index_of(texts, text_key, text, wanted, levels), "containment-index")

    frequency = index.groupBy("shingle").agg(F.count(F.lit(1)).alias("texts"))
    looked_up = of_needles.join(frequency, "shingle", "left")
    rarest = looked_up.groupBy("__id").agg(
        F.min(F.struct("texts", "shingle")).alias("rarest"), F.bool_and(F.col("texts").isNotNull()).alias("complete")
    )
    chosen = rarest.filter("complete").select(
        "__id", F.col("rarest.shingle").alias("shingle"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("__salt")
    )
    salted = index.withColumn("__salt", F.pmod(F.xxhash64(text_key), F.lit(salts)).cast("int"))
    candidates = salted.join(chosen, ["shingle", "__salt"]).select(text_key, "__id").distinct()
    # Kept, so that texts are shuffled only where the candidates are too many to be broadcast.
    pairs = kept_table(candidates.join(given.select("__id", "__needle_key", "__needle"), "__id").drop("__id"), "containment-pairs")
    at = F.instr(F.col("__text"), F.col("__needle")).cast("bigint")
    searched = texts.select(text_key, F.col(text).alias("__text")).join(pairs, text_key).withColumn("__at", at)
    found = searched.filter("__at > 0").groupBy("__needle_key", text_key).agg((F.min("__at") - 1).alias("first_position"))
    return found.select(F.col("__needle_key").alias(needle_key), text_key, "first_position")

