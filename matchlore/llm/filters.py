"""How filters act together: every order of five filters, audited from one pass over the texts.

The pass is a byte transducer. It has two states, between words and in a word, and a table
that gives for every state and byte the next state and what is emitted: a word begins, a word
ends, a capital, a code point, a symbol. UTF-8 needs no further states: bytes above 0x7F are
always part of a word, and a code point is emitted at every byte but continuations. The next
state depends on the byte alone, so a whole batch runs through the table by two gathers.
Word spans go into a hash table (open addressing) that compares the bytes behind equal hashes,
so the count of distinct words is exact.

Copies are found by SHA-256 of the whole text; the least doc_id of a text is the original.
What is left are counts per part and set of failed filters, and all 120 orders follow from these.

Defined results: a null text is empty, which fails the length filter alone; a null language is the
part ''; a null doc_id is neither an original nor a copy; rows that repeat a doc_id with the same text
are not copies of each other; several labels of one document count as the largest; no rows give no parts.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from matchlore.llm import kernels
from matchlore.llm.shared import stored

FILTERS = "ABCDE"
COUNTS = ("n_words", "n_distinct", "n_capitals", "n_points", "n_symbols")
_BETWEEN, _WITHIN = 0, 1
_BEGIN, _END, _CAPITAL, _POINT, _MARK = 1, 2, 4, 8, 16


def transducer(symbols: bytes = b"#$%&*|") -> tuple[np.ndarray, np.ndarray]:
    """``following[byte]`` and ``emitted[state, byte]``."""
    byte = np.arange(256)
    following = np.where(kernels.SPACE, _BETWEEN, _WITHIN).astype(np.uint8)
    emitted = np.zeros((2, 256), np.uint8)
    emitted[_BETWEEN, following == _WITHIN] |= _BEGIN
    emitted[_WITHIN, following == _BETWEEN] |= _END
    emitted[:, (byte >= ord("A")) & (byte <= ord("Z"))] |= _CAPITAL
    emitted[:, byte >> 6 != 0b10] |= _POINT
    emitted[:, list(symbols)] |= _MARK
    return following, emitted


def _same(data: np.ndarray, words: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether words of equal length that start at ``a`` and ``b`` have the same bytes.

    ``words`` holds the eight bytes that follow each position; only words beyond 64 bytes are compared one by one.
    """
    equal, at = np.ones(len(a), bool), np.flatnonzero(lengths <= 64)
    for step in range(0, 64, 8):
        at = at[equal[at] & (lengths[at] > step)]
        if not len(at):
            break
        unused = (8 * np.maximum(0, step + 8 - lengths[at])).astype(np.uint64)
        apart = words[a[at] + step] ^ words[b[at] + step]
        equal[at] = apart << unused == 0
    for i in np.flatnonzero(lengths > 64):
        x, y, n = a[i], b[i], lengths[i]
        equal[i] = data[x : x + n].tobytes() == data[y : y + n].tobytes()
    return equal


def distinct_words(data: np.ndarray, text: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: int) -> np.ndarray:
    """How many different words each text has.

    All words of the piece enter one table with at least twice as many slots, keyed by text and word.
    In each round every open word looks at its slot: the first to claim an empty one stays, a word equal to
    the one that holds the slot (same text, length and bytes) is a repeat, all others go to the next slot.
    """
    hashes = kernels.RunHashes(data)(starts, ends)
    hashes = kernels.mix(hashes + text.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    slots = 1 << max(4, int(2 * len(starts)).bit_length())
    table = np.full(slots, -1, np.int64)
    slot = (hashes & np.uint64(slots - 1)).astype(np.int64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    # bytes beyond a word's end are shifted out, the least significant byte being the first
    open_, lengths = np.arange(len(starts)), ends - starts
    while len(open_):
        empty = open_[table[slot[open_]] < 0]
        table[slot[empty[::-1]]] = empty[::-1]
        holder = table[slot[open_]]
        alike = (text[holder] == text[open_]) & (lengths[holder] == lengths[open_]) & (hashes[holder] == hashes[open_])
        other = alike & (holder != open_)
        same = holder == open_
        same[other] = _same(data, words, starts[holder[other]], starts[open_[other]], lengths[open_[other]])
        open_ = open_[~same]
        slot[open_] = (slot[open_] + 1) & (slots - 1)
    return np.bincount(text[table[table >= 0]], minlength=rows)


def count_piece(data: np.ndarray, offsets: np.ndarray, symbols: bytes) -> np.ndarray:
    """The five counts of each text of a piece, one row a text."""
    rows = len(offsets) - 1
    counts = np.zeros((rows, len(COUNTS)), np.int64)
    if not len(data):
        return counts
    following, emitted = transducer(symbols)
    after = following[data]
    before = np.empty_like(after)
    before[0], before[1:] = _BETWEEN, after[:-1]
    first = offsets[:-1][np.diff(offsets) > 0]
    before[first] = _BETWEEN
    out = emitted[before, data]
    starts = np.flatnonzero(out & _BEGIN)
    # a word also ends with its text
    last = offsets[1:][np.diff(offsets) > 0] - 1
    ends = np.sort(np.concatenate([np.flatnonzero(out & _END), last[after[last] == _WITHIN] + 1]))
    text = np.searchsorted(offsets, starts, "right") - 1
    counts[:, 0] = np.bincount(text, minlength=rows)
    counts[:, 1] = distinct_words(data, text, starts, ends, rows)
    for column, flag in ((2, _CAPITAL), (3, _POINT), (4, _MARK)):
        counts[:, column] = kernels.per_text(out & flag != 0, offsets)
    return counts


def text_counts(text: str | Column = "text", symbols: bytes = b"#$%&*|") -> Column:
    """Words, different words, capitals A-Z, code points and symbols of a text column, as a struct."""

    @F.arrow_udf("struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">")
    def of(texts: pa.Array) -> pa.Array:
        found = [count_piece(data, offsets, symbols) for _, _, data, offsets in kernels.pieces(texts)]
        found = np.concatenate([np.zeros((0, len(COUNTS)), np.int64), *found])
        return pa.StructArray.from_arrays([pa.array(c) for c in found.T], list(COUNTS))

    return of(text)


def failures(docs: DataFrame, labels: DataFrame, min_words: int = 200, min_distinct: int = 50,
             max_capitals: int = 3, symbols: bytes = b"#$%&*|") -> DataFrame:
    """part, failed (the letters of the filters that fail), quality, toxic and n, the documents alike in these.

    A: under ``min_words`` words; B: under ``min_distinct`` percent of the words are different; C: over
    ``max_capitals`` percent capitals; D: a symbol; E: the whole text is that of a smaller doc_id.
    """
    counted = docs.select(
        "doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"),
        text_counts("text", symbols).alias("c"),
    )
    c = F.col("c")
    failing = {
        "A": c.n_words < min_words,
        "B": 100 * c.n_distinct < min_distinct * c.n_words,
        "C": 100 * c.n_capitals > max_capitals * c.n_points,
        "D": c.n_symbols > 0,
    }
    letters = F.concat(*[F.when(fails, letter).otherwise("") for letter, fails in failing.items()])
    judged = stored(counted.select("doc_id", "part", "digest", letters.alias("failed")), "filter-failures")
    said = labels.groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("quality"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    # null ids match no label; left out of the join, they do not meet in one task
    known = judged.where("doc_id is not null").join(said.where("doc_id is not null"), "doc_id", "left")
    named = known.select(*judged.columns, F.coalesce("quality", F.lit(0)).alias("quality"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    unnamed = judged.where("doc_id is null").select("*", F.lit(0).alias("quality"), F.lit(0).alias("toxic"))
    alike = ["digest", "part", "failed", "quality", "toxic"]
    # rows of one document first, so that the second sum meets an original's rows as one; both shrink before they shuffle
    by_id = named.union(unnamed).groupBy(*alike, "doc_id").agg(F.count("*").alias("rows"))
    by_text = by_id.groupBy(*alike).agg(
        F.sum("rows").alias("rows"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("rows")).otherwise(0)).alias("without_id"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "rows"))).alias("least"),
    )
    original = F.min("least.doc_id").over(Window.partitionBy("digest"))
    placed = by_text.withColumn("original", original)
    first = F.col("without_id") + F.when(F.col("least.doc_id") == F.col("original"), F.col("least.rows")).otherwise(0)
    split = placed.select("part", "failed", "quality", "toxic", "rows", first.alias("first"))
    groups = split.select("part", "quality", "toxic", F.explode(F.array(
        F.struct(F.col("failed"), F.col("first").alias("n")),
        F.struct(F.concat("failed", F.lit("E")).alias("failed"), (F.col("rows") - F.col("first")).alias("n")),
    )).alias("g")).select("part", "quality", "toxic", "g.*")
    return groups.groupBy("part", "failed", "quality", "toxic").agg(F.sum("n").alias("n")).where("n > 0")


def audit(groups: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Effect of every step of every order of ``filters`` in each part of ``failures``."""
    orders = F.split(F.lit(",".join(map("".join, permutations(filters)))), ",")
    each = groups.select("part", "failed", "quality", "toxic", "n", F.explode(orders).alias("filter_order"))
    at = each.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(filters)))).alias("step"))
    at = at.withColumn("_filter", F.expr("substring(filter_order, step, 1)"))
    fails, alone = F.expr("contains(failed, _filter)"), F.col("failed") == F.col("_filter")
    before = F.expr("translate(failed, substring(filter_order, 1, step - 1), '') <> failed")

    def total(which: Column) -> Column:
        return F.sum(F.when(which, F.col("n")).otherwise(0))

    found = at.groupBy("part", "filter_order", "step", "_filter").agg(
        total(~fails & ~before).alias("kept"),
        total(fails & ~before).alias("removed"),
        total(fails & before).alias("redundant"),
        total(alone).alias("unique_fails"),
        total(fails & ~before & (F.col("quality") == 1)).alias("good_lost"),
        total(fails & ~before & (F.col("toxic") == 1)).alias("toxic_lost"),
    )
    everywhere = F.sum("removed").over(Window.partitionBy("part", "_filter"))
    return found.withColumn("shapley", everywhere).drop("_filter")


def interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over all documents."""
    return audit(stored(failures(docs, labels), "filter-groups"))
