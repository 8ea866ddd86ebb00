"""Substring dedup with a compressed FM-index per shard.

A shard holds the segments of a range of anchors (``repeats``), so all places where a
window may occur are in one shard, and shards are of bounded size. Its index is the
Burrows-Wheeler transform of the segments' words in a wavelet matrix: one packed bit
vector per bit of a word's number, with counts per 64 bits; the order of suffixes and the numbered words are
dropped once it is built. The segments then stream
through as queries, all in lockstep: backward search extends a match to the left as long
as the interval still holds a suffix from a document of smaller id (a range minimum over the
documents in suffix order, by their rank in the shard). Matches of at least a window are reported; the
search then goes on from the last end at which a longer reach to the left is possible.

Defined results: null counts as empty; a null id counts as the largest; repeated rows have one id, so
they do not remove each other's words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlore.llm import repeats
from matchlore.llm.shared import stored

WINDOW, GRAM = 50, 20


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols (doubling)."""
    rank, n, step = text.astype(np.int64), len(text), 1
    order = np.argsort(rank, kind="stable")
    while step < depth:
        following = np.zeros(n, np.int64)
        following[:-step] = rank[step:] + 1
        key = rank * (n + 2) + following
        order = np.argsort(key, kind="stable")
        fresh = np.diff(key[order], prepend=key[order[0]]) != 0
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh)
        step *= 2
        if fresh[1:].all():
            break
    return order


class Bits:
    """A packed bit vector with the number of ones before every 64 bits."""

    def __init__(self, flags: np.ndarray):
        padded = np.zeros(-(-(len(flags) + 1) // 64) * 64, np.uint8)
        padded[: len(flags)] = flags
        self.blocks = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.r_[0, np.cumsum(np.bitwise_count(self.blocks).astype(np.int64))].astype(np.int32)
        self.zeros = len(flags) - int(self.before[-1])

    def ones(self, upto: np.ndarray) -> np.ndarray:
        block = upto >> 6
        below = (np.uint64(1) << (upto & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.blocks[block] & below)


class WaveletMatrix:
    """Counts of a symbol before a position, in one step per bit of the symbols."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.levels, left = [], symbols
        for shift in range(max(1, int(size - 1).bit_length()) - 1, -1, -1):
            flags = (left >> shift) & 1
            self.levels.append((shift, Bits(flags)))
            left = np.concatenate([left[flags == 0], left[flags == 1]])
        self.starts = self._follow(np.arange(size), np.zeros(size, np.int64))

    def _follow(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, bits in self.levels:
            ones = bits.ones(at)
            at = np.where((symbols >> shift) & 1, bits.zeros + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, upto: np.ndarray) -> np.ndarray:
        return self._follow(symbols, upto) - self.starts[symbols]


class RangeMinima:
    """Least values of intervals: minima of up to a block from every place, and from every block on.

    For n values of 32 bits these are 5 n numbers for runs within blocks of 16 and about n for the rest, not
    n log n.
    """

    _LOG = 4

    def __init__(self, values: np.ndarray):
        self.short = self._doubled(values.astype(np.int32), self._LOG + 1)
        size = 1 << self._LOG
        # every block's least value is the minimum of its length from its first place; the last block may be shorter
        edges = np.arange(0, len(values), size)
        self.long = self._doubled(np.minimum.reduceat(self.short[0], edges), 32)

    @staticmethod
    def _doubled(values: np.ndarray, most: int) -> list[np.ndarray]:
        levels = [values]
        while len(levels) < most and 2 << (len(levels) - 1) <= len(values):
            last, half = levels[-1], 1 << (len(levels) - 1)
            levels.append(np.minimum(last[:-half], last[half:]))
        return levels

    @staticmethod
    def _least(levels: list[np.ndarray], low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Intervals that are not empty, of a length below twice that of the last level."""
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(low), np.int32)
        for k in np.unique(level):
            some = level == k
            out[some] = np.minimum(levels[k][low[some]], levels[k][high[some] - (1 << k)])
        return out

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least value in each interval; none is empty."""
        block = 1 << self._LOG
        out = np.empty(len(low), np.int32)
        far = high - low >= 2 * block
        out[~far] = self._least(self.short, low[~far], high[~far])
        if far.any():
            low, high = low[far], high[far]
            ends = np.minimum(self.short[-1][low], self.short[-1][high - block])
            # whole blocks lie between, at least one
            out[far] = np.minimum(ends, self._least(self.long, -(-low // block), high // block))
        return out


class FMIndex:
    """Backward search over several texts, each known by the id of its document."""

    def __init__(self, texts: list[np.ndarray], documents: np.ndarray, longest: int):
        bounds = np.r_[0, np.cumsum([len(t) + 1 for t in texts])]
        # 0 parts the texts; words are numbered from 1
        joined = np.concatenate([x for t in texts for x in (t, [0])]).astype(np.int64)
        order = suffix_array(joined, longest + 1)
        counts = np.bincount(joined)
        self.size = len(joined)
        self.tree = WaveletMatrix(joined[order - 1], len(counts))
        self.before = np.r_[0, np.cumsum(counts)][:-1]
        #: the ids of documents by rank
        self.ids, ranks = np.unique(documents, return_inverse=True)
        self.least = RangeMinima(np.repeat(ranks.astype(np.int32), np.diff(bounds))[order])

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the matches with one more symbol at their left."""
        both = self.before[np.r_[symbols, symbols]] + self.tree.rank(np.r_[symbols, symbols], np.r_[low, high])
        return both[: len(low)], both[len(low) :]

    def smallest(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least document in intervals that are not empty."""
        return self.ids[self.least.least(low, high)]


def matches(index: FMIndex, texts: list[np.ndarray], documents: np.ndarray, window: int) -> list[list[tuple[int, int]]]:
    """For each text the maximal runs of words, ``window`` or longer, that an indexed text of a smaller document has.

    Runs are found from their right end. A run from ``f + 1`` to ``e`` that cannot be extended leaves
    only windows that start at ``f`` or before and end before ``e``.
    """
    length = np.array([len(t) for t in texts], np.int64)
    streamed, base = np.concatenate(texts).astype(np.int32), np.cumsum(length) - length
    found: list[list[tuple[int, int]]] = [[] for _ in texts]
    who = np.flatnonzero(length >= window)
    end = length[who] - 1
    while len(who):
        at = end.copy()
        low, high = np.zeros(len(who), np.int64), np.full(len(who), index.size)
        going = np.arange(len(who))
        while len(going):
            symbols = streamed[base[who[going]] + at[going]]
            lo, hi = index.extend(symbols, low[going], high[going])
            some = np.flatnonzero(hi > lo)
            earlier = index.smallest(lo[some], hi[some]) < documents[who[going[some]]]
            some = some[earlier]
            going, lo, hi = going[some], lo[some], hi[some]
            low[going], high[going] = lo, hi
            at[going] -= 1
            going = going[at[going] >= 0]
        for q in np.flatnonzero(end - at >= window).tolist():
            found[who[q]].append((int(at[q]) + 1, int(end[q]) + 1))
        end = np.minimum(end - 1, at + window - 1)
        more = (at >= 0) & (end >= window - 1)
        who, end = who[more], end[more]
    return found


def class_spans(contents: list[bytes], documents: np.ndarray, window: int) -> list[list[dict]]:
    """For each class of segments the spans of words that a document before its first one has."""
    numbers: dict[bytes, int] = {}
    texts = [np.array([numbers.setdefault(w, len(numbers) + 1) for w in c.split()], np.int64) for c in contents]
    index = FMIndex(texts, documents, max(map(len, texts)))
    return [
        [{"_from": a, "_to": b} for a, b in repeats.merged(spans)] for spans in matches(index, texts, documents, window)
    ]


def _cut(text: bytes, firsts: list[int], ns: list[int]) -> list[bytes]:
    words = text.split()
    return [b" ".join(words[f : f + n + WINDOW - 1]) for f, n in zip(firsts, ns)]


_SPANS = "array<struct<_from:int,_to:int>>"


def repeated_spans(texts: DataFrame, most: int = 20_000, batch: int = 4_000) -> DataFrame:
    """One row per text with words to remove: its name and ``_spans`` of words (not merged).

    Anchors with more than ``most`` classes of segments, which no task should hold at once, have the
    windows of their classes compared by two hashes instead; the rows are the same.
    """
    hits = repeats.repeated(texts, repeats.word_occurrences(WINDOW, GRAM), several_texts=True)
    classes = hits.groupBy("anchor", "segment").agg(F.min(repeats.place()).alias("place"))
    segments = stored(repeats.with_segments(classes.withColumn("first_id", F.col("place._id")), texts, _cut), "segments")
    crowd = stored(
        segments.groupBy("anchor").agg(F.count("*").alias("c")).where(f"c > {most}").select("anchor"), "crowded-anchors"
    )
    kind = pa.list_(pa.struct([("_from", pa.int32()), ("_to", pa.int32())]))
    schema = pa.schema([("anchor", pa.int64()), ("segment", pa.int64()), ("first_id", pa.int64()), ("_spans", kind)])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in repeats.whole_groups(batches, "anchor", batch):
            spans = class_spans(table["content"].to_pylist(), table["first_id"].to_numpy(), WINDOW)
            columns = [table[c].combine_chunks() for c in ("anchor", "segment", "first_id")] + [pa.array(spans, kind)]
            yield from pa.table(columns, schema=schema).to_batches()

    dealt = segments.join(crowd, "anchor", "left_anti").select("anchor", "segment", "first_id", "content")
    dealt = dealt.repartition("anchor").sortWithinPartitions("anchor")
    spans = dealt.mapInArrow(search, f"anchor bigint, segment bigint, first_id bigint, _spans {_SPANS}")
    if crowd.limit(1).count():
        spans = spans.union(_crowded_spans(segments.join(crowd, "anchor", "left_semi")))
    spans = stored(spans, "class-spans")
    everything = F.array(F.struct(F.lit(0).alias("_from"), (F.col("n") + WINDOW - 1).cast("int").alias("_to")))
    met = hits.join(spans, ["anchor", "segment"]).withColumn(
        # all documents of a class but the first have it from the first
        "_spans", F.when(F.col("_id") > F.col("first_id"), everything).otherwise(F.col("_spans"))
    )
    covered = met.select(*repeats.TEXT, "first", F.explode("_spans").alias("s"))
    return repeats.span_lists(covered.select(
        *repeats.TEXT, (F.col("first") + F.col("s._from")).alias("_from"), (F.col("first") + F.col("s._to")).alias("_to")
    ))


def _crowded_spans(segments: DataFrame) -> DataFrame:
    """Spans of classes under crowded anchors: windows by anchor, place and two hashes, with their least id."""

    @F.arrow_udf("array<binary>")
    def windows(content: pa.Array) -> pa.Array:
        rows = []
        for c in content:
            words = c.as_py().split()
            rows.append([b" ".join(words[a : a + WINDOW]) for a in range(len(words) - WINDOW + 1)])
        return pa.array(rows, pa.list_(pa.binary()))

    every = segments.select("anchor", "segment", "first_id", "left", F.posexplode(windows("content")).alias("at", "w"))
    every = every.select(
        "anchor", "segment", "first_id", "at", (F.col("left") - F.col("at")).alias("to_anchor"),
        F.xxhash64("w").alias("h1"), F.xxhash64("w", F.lit(1)).alias("h2"),
    )
    same = ["anchor", "to_anchor", "h1", "h2"]
    least = every.groupBy(*same).agg(F.min("first_id").alias("least"))
    span = F.struct(F.col("at").alias("_from"), (F.col("at") + WINDOW).alias("_to"))
    met = every.join(least, same).groupBy("anchor", "segment", "first_id")
    return met.agg(F.collect_list(F.when(F.col("least") < F.col("first_id"), span)).alias("_spans"))


_DIGEST = "struct<n_words:bigint,n_removed:bigint,kept_sha256:string>"


def _digest(text: pa.Array, spans: pa.Array) -> pa.Array:
    sizes, removed, digests = [], [], []
    for t, s in zip(text, spans):
        words = (t.as_py() or "").encode().split()
        cuts = repeats.merged([(x["_from"], x["_to"]) for x in s.as_py() or []])
        edges = [0, *[x for c in cuts for x in c], len(words)]
        kept = [w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]]
        sizes.append(len(words))
        removed.append(len(words) - len(kept))
        digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
    columns = [pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
    return pa.StructArray.from_arrays(columns, ["n_words", "n_removed", "kept_sha256"])


def word_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every document."""
    texts = repeats.keyed(docs.select("doc_id", "text"))
    joined = texts.join(repeated_spans(texts), list(repeats.TEXT), "left")
    return joined.select("doc_id", F.arrow_udf(_digest, _DIGEST)("text", "_spans").alias("d")).select("doc_id", "d.*")
