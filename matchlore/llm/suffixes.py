"""Suffix-array dedup: bytes covered by a 200-byte string that also starts elsewhere.

Segments of all texts that share an anchor (``repeats``) are aligned at it, and the
suffix order of a collection of them is built column by column, from the last to the first. Each
round inserts one symbol per segment: the symbols in the current suffix order are the new column of the
collection's Burrows-Wheeler transform, a stable sort by them is the next suffix order, and
the common prefix of neighbours is one more than the least common prefix between them
before. Columns are read one after the other and never again, so they may as well be
files. Neighbours whose common prefix reaches the window have a repeated window at
that column. Only suffixes that start at the same distance from the anchor are ordered, as
others cannot be equal windows; so a round costs one pass over the segments,
not one over everything inserted so far.

Defined results: null counts as empty; repeated rows are each other's repeats; texts shorter than the
window stay whole.
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

WINDOW, GRAM = 200, 50
_ABSENT = 256


def columns_of(contents: list[bytes], left: np.ndarray, window: int, gram: int) -> np.ndarray:
    """One row per column: the symbol of every segment there, aligned at the anchors."""
    width = 2 * window - gram
    table = np.full((len(contents), width), _ABSENT, np.uint16)
    for row, (content, shift) in enumerate(zip(contents, left.tolist())):
        at = window - gram - shift
        table[row, at : at + len(content)] = np.frombuffer(content, np.uint8)
    return np.ascontiguousarray(table.T)


def repeated_starts(columns: np.ndarray, window: int, starts: int) -> np.ndarray:
    """Which segments (columns of the result) have a window that another one has, by start column."""
    rows = columns.shape[1]
    order, common = np.arange(rows), np.zeros(rows, np.int32)
    found = np.zeros((starts, rows), bool)
    for c in range(len(columns) - 1, -1, -1):
        symbols = columns[c][order]
        moved = np.argsort(symbols, kind="stable")
        ranked = symbols[moved]
        after = np.zeros(rows, np.int32)
        begins = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
        ends = np.r_[begins[1:], rows]
        for s, e in zip(begins.tolist(), ends.tolist()):
            if e - s > 1 and ranked[s] != _ABSENT:
                here = moved[s:e]
                # the least common prefix between each occurrence of the symbol and the next
                after[s + 1 : e] = 1 + np.minimum.reduceat(common[: here[-1] + 1], here[:-1] + 1)
        order, common = order[moved], after
        if c < starts:
            equal = np.flatnonzero(common >= window)
            found[c, order[equal]] = True
            found[c, order[equal - 1]] = True
    return found


def _runs(flags: np.ndarray) -> Iterator[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.r_[0, flags.view(np.int8), 0]))
    yield from zip(edges[::2].tolist(), edges[1::2].tolist())


def class_spans(contents: list[bytes], left: np.ndarray, times: np.ndarray, window: int, gram: int) -> list[list[dict]]:
    """For each class of segments the spans, from its first byte, that repeated windows cover."""
    found = repeated_starts(columns_of(contents, left, window, gram), window, window - gram + 1)
    out = []
    for row, content in enumerate(contents):
        shift = window - gram - int(left[row])
        n = len(content) - window + 1
        flags = np.ascontiguousarray(found[shift : shift + n, row]) | (times[row] > 1)
        spans = repeats.merged([(a, b - 1 + window) for a, b in _runs(flags)])
        out.append([{"_from": a, "_to": b} for a, b in spans])
    return out


def _cut(text: bytes, firsts: list[int], ns: list[int]) -> list[bytes]:
    return [text[f : f + n + WINDOW - 1] for f, n in zip(firsts, ns)]


_SPANS = "array<struct<_from:int,_to:int>>"


def repeated_spans(texts: DataFrame, most: int = 50_000, batch: int = 20_000) -> DataFrame:
    """One row per text that repeats anything: its name and ``_spans`` of removed bytes (not merged).

    Anchors with more than ``most`` classes of segments, which no task should hold at once, have the
    windows of their classes counted by two hashes instead; the rows are the same.
    """
    hits = repeats.repeated(texts, repeats.byte_occurrences(WINDOW, GRAM), several_texts=False)
    classes = hits.groupBy("anchor", "segment").agg(F.count("*").alias("times"), F.min(repeats.place()).alias("place"))
    segments = stored(repeats.with_segments(classes, texts, _cut), "segments")
    crowded = segments.groupBy("anchor").agg(F.count("*").alias("c")).where(f"c > {most}").select("anchor")
    fields = [("anchor", pa.int64()), ("segment", pa.int64()),
              ("_spans", pa.list_(pa.struct([("_from", pa.int32()), ("_to", pa.int32())])))]
    schema = pa.schema(fields)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in repeats.whole_groups(batches, "anchor", batch):
            spans = class_spans(table["content"].to_pylist(), table["left"].to_numpy(), table["times"].to_numpy(), WINDOW, GRAM)
            columns = [table["anchor"].combine_chunks(), table["segment"].combine_chunks(), pa.array(spans, schema.field(2).type)]
            yield from pa.table(columns, schema=schema).to_batches()

    crowd = stored(crowded, "crowded-anchors")
    spread = segments.join(crowd, "anchor", "left_anti").select("anchor", "segment", "times", "left", "content")
    spread = spread.repartition("anchor").sortWithinPartitions("anchor")
    spans = spread.mapInArrow(build, f"anchor bigint, segment bigint, _spans {_SPANS}")
    if crowd.limit(1).count():
        spans = spans.union(_crowded_spans(segments.join(crowd, "anchor", "left_semi")))
    spans = stored(spans.where(F.size("_spans") > 0), "class-spans")
    covered = hits.join(spans, ["anchor", "segment"]).select(*repeats.TEXT, "first", F.explode("_spans").alias("s"))
    return repeats.span_lists(covered.select(
        *repeats.TEXT, (F.col("first") + F.col("s._from")).alias("_from"), (F.col("first") + F.col("s._to")).alias("_to")
    ))


def _crowded_spans(segments: DataFrame) -> DataFrame:
    """The spans of classes under crowded anchors: windows counted by anchor, place and two hashes."""
    starts = F.sequence(F.lit(0), F.col("n") - 1)
    windows = segments.select("anchor", "segment", "times", "left", "content", F.explode(starts).alias("at"))
    part = F.substring("content", F.col("at") + 1, F.lit(WINDOW))
    windows = windows.select(
        "anchor", "segment", "times", "at", (F.col("left") - F.col("at")).alias("to_anchor"),
        F.xxhash64(part).alias("h1"), F.xxhash64(part, F.lit(1)).alias("h2"),
    )
    same = ["anchor", "to_anchor", "h1", "h2"]
    again = windows.groupBy(*same).agg(F.sum("times").alias("c")).where("c > 1").select(*same)
    met = windows.join(again, same)
    span = F.struct(F.col("at").cast("int").alias("_from"), (F.col("at") + WINDOW).cast("int").alias("_to"))
    return met.groupBy("anchor", "segment").agg(F.collect_list(span).alias("_spans"))


def _marked(text: pa.Scalar, spans: pa.Scalar) -> tuple[bytes, list[list[int]]]:
    return (text.as_py() or "").encode(), repeats.merged([(s["_from"], s["_to"]) for s in spans.as_py() or []])


def _kept(data: bytes, spans: list[list[int]]) -> bytes:
    edges = [0, *[x for s in spans for x in s], len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))


_DIGEST = "struct<n_bytes:bigint,n_removed:bigint,n_spans:bigint,kept_sha256:string>"


def _digest(text: pa.Array, spans: pa.Array) -> pa.Array:
    rows = []
    for t, s in zip(text, spans):
        data, cuts = _marked(t, s)
        rows.append((len(data), sum(b - a for a, b in cuts), len(cuts), hashlib.sha256(_kept(data, cuts)).hexdigest()))
    columns = list(zip(*rows)) or [()] * 4
    kinds = [pa.int64()] * 3 + [pa.string()]
    return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _cleaned(text: pa.Array, spans: pa.Array) -> pa.Array:
    """What is left of each text; a character that a span cuts in two stays whole."""
    rows = []
    for t, s in zip(text, spans):
        data, cuts = _marked(t, s)
        whole = []
        for a, b in cuts:
            while a < b and data[a] & 0xC0 == 0x80:
                a += 1
            while b < len(data) and b > a and data[b] & 0xC0 == 0x80:
                b -= 1
            if a < b:
                whole.append([a, b])
        rows.append(_kept(data, whole).decode())
    return pa.array(rows, pa.string())


def _with_spans(texts: DataFrame) -> DataFrame:
    return texts.join(repeated_spans(texts.select(*repeats.TEXT, "text")), list(repeats.TEXT), "left")


def byte_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""
    texts = repeats.keyed(docs.select("doc_id", "text"))
    return _with_spans(texts).select("doc_id", F.arrow_udf(_digest, _DIGEST)("text", "_spans").alias("d")).select("doc_id", "d.*")


def without_repeats(docs: DataFrame) -> DataFrame:
    """Every document with its repeated passages taken out; all columns stay."""
    names = docs.columns
    joined = _with_spans(repeats.keyed(docs))
    text = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(F.arrow_udf(_cleaned, "string")("text", "_spans"))
    return joined.withColumn("text", text).select(*names)
