"""SimHash near-duplicates by an inverted index over byte positions.

A 64-bit fingerprint is eight (position, byte) entries. Two fingerprints that
differ in at most three bits share at least five of them. Of any five positions
at least three lie in one half of the eight, so every such pair meets in a posting
of three positions of one half: the index has 2 * 4 such postings per fingerprint
instead of eight single bytes whose lists would hold a 256th of all fingerprints.
Where two fingerprints meet, the shared positional bytes are tallied, pairs that
reach five are kept, and their bits are compared.

Pairs never leave a task: each posting gives only the edges of a spanning
forest. Postings longer than a block are cut into blocks, and every two blocks
meet in a task of their own. Equal fingerprints are one node from the start.
Components are joined by alternating stars over stored tables.

Defined results: a null, empty or blank text has fingerprint zero and links like
any other; repeated rows share their fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from matchlore.llm.shared import stored

_HASHES_AT_ONCE = 1 << 15


def fingerprint(text: str, size: int = 3, seed: int = 42) -> int:
    """SimHash of lower-cased (A-Z) word shingles, by majority of the bits of XXH64."""
    words = text.encode().lower().split()
    if not words:
        return 0
    size = min(size, len(words))
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = (ends - lengths + 1)[: len(words) - size + 1].tolist()
    ends = ends[size - 1 :].tolist()
    digest, set_bits = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), _HASHES_AT_ONCE):
        some = [digest(line[a:b], seed) for a, b in zip(starts[at : at + _HASHES_AT_ONCE], ends[at : at + _HASHES_AT_ONCE])]
        bits = np.unpackbits(np.array(some, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int32)
    chosen = np.packbits(2 * set_bits > len(starts), bitorder="little")
    return int(chosen.view("<u8")[0])


def fingerprints(text: str | Column = "text", size: int = 3, seed: int = 42) -> Column:
    """The fingerprint of a text column as a (signed) long."""

    @F.arrow_udf("bigint")
    def of(texts: pa.Array) -> pa.Array:
        values = np.fromiter((fingerprint(t.as_py() or "", size, seed) for t in texts), np.uint64, len(texts))
        return pa.array(values.view(np.int64))

    return of(text)


def hex16(fp: str | Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


#: Position masks of the postings: three of the four bytes of one half.
_MASKS = tuple(
    sum(0xFF << 8 * p for p in chosen) for half in ((0, 1, 2, 3), (4, 5, 6, 7)) for chosen in combinations(half, 3)
)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return parent
        parent = up


def linked(left: np.ndarray, right: np.ndarray, matches: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that share ``matches`` positional bytes and differ in at most ``bits`` bits."""
    apart = left[:, None] ^ right[None, :]
    tally = (apart.view(np.uint8).reshape(*apart.shape, 8) == 0).sum(axis=2, dtype=np.uint8)
    a, b = np.nonzero(tally >= matches)
    near = np.bitwise_count(apart[a, b]) <= bits
    return a[near], b[near]


def forest(values: np.ndarray, left: np.ndarray, right: np.ndarray, matches: int, bits: int,
           rows: int = 1 << 18) -> np.ndarray:
    """Root index of each of ``values``, with those joined that link across ``left`` and ``right``.

    Compared in strips of about ``rows`` pairs, so memory is bounded.
    """
    parent = np.arange(len(values))
    strip = max(1, rows // max(1, len(right)))
    for at in range(0, len(left), strip):
        a, b = linked(values[left[at : at + strip]], values[right], matches, bits)
        a, b = left[at + a], right[b]
        while len(a):  # hook larger roots onto smaller ones until the strip's pairs agree
            ra, rb = parent[a], parent[b]
            low, high = np.minimum(ra, rb), np.maximum(ra, rb)
            open_ = low != high
            if not open_.any():
                break
            a, b = a[open_], b[open_]
            np.minimum.at(parent, high[open_], low[open_])
            parent = _roots(parent)
    return parent


def links(prints: DataFrame, bits: int = 3, block: int = 2048) -> DataFrame:
    """Edges (a, b) between nodes whose fingerprints differ in at most ``bits`` bits, up to connection.

    ``prints`` has distinct ``fp`` and a ``node`` each. Each posting contributes a spanning
    forest of its links; nothing is emitted for every pair.
    """
    matches = 8 - bits
    if matches < 5:
        raise ValueError("three positions of a half are only sure to be shared up to three bits")
    postings = prints.select(
        "node", "fp",
        F.explode(F.array(*[
            F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bytes"))
            for i, m in enumerate(_MASKS)
        ])).alias("posting"),
    ).select("node", "fp", "posting.*")
    sizes = postings.groupBy("mask", "bytes").agg(F.count("*").alias("n")).where("n > 1")
    shared = postings.join(sizes, ["mask", "bytes"])
    # a posting of k blocks has k * (k + 1) / 2 tasks; a row goes to the k of them that hold its block
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    dealt = shared.withColumn("blocks", blocks).withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    dealt = dealt.select(
        "node", "fp", "mask", "bytes", "own",
        F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
    )
    keys = ["mask", "bytes", "low", "high"]

    def meet(groups: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by group; groups go over batches, so the last one is kept back."""
        rest = None
        for frame in groups:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            where = frame[keys].to_numpy()
            starts = np.flatnonzero(np.r_[True, (where[1:] != where[:-1]).any(axis=1)]) if len(frame) else np.zeros(0, int)
            if len(starts) > 1:
                yield _edges(frame.iloc[: starts[-1]], starts[:-1])
            rest = frame.iloc[starts[-1] :] if len(starts) else frame
        if rest is not None and len(rest):
            yield _edges(rest, np.zeros(1, int))

    def _edges(frame: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        node, fp = frame["node"].to_numpy(), frame["fp"].to_numpy().view(np.uint64)
        own, low, high = (frame[c].to_numpy() for c in ("own", "low", "high"))
        ends, a, b = np.r_[starts[1:], len(frame)], [], []
        for s, e in zip(starts.tolist(), ends.tolist()):
            if e - s == 2:
                if int(fp[s] ^ fp[s + 1]).bit_count() <= bits:
                    a.append(node[s : s + 1])
                    b.append(node[s + 1 : s + 2])
                continue
            every = np.arange(e - s)
            left = every if low[s] == high[s] else every[own[s:e] == low[s]]
            right = every if low[s] == high[s] else every[own[s:e] == high[s]]
            root = forest(fp[s:e], left, right, matches, bits)
            moved = np.flatnonzero(root != every)
            a.append(node[s:e][moved])
            b.append(node[s:e][root[moved]])
        none = np.zeros(0, np.int64)
        return pd.DataFrame({"a": np.concatenate([none, *a]), "b": np.concatenate([none, *b])})

    grouped = dealt.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)
    return grouped.mapInPandas(meet, "a bigint, b bigint").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its least node.

    Alternating stars: every node's larger neighbours are joined to its least one, then its
    smaller ones; edges never grow in number beyond nodes plus edges. Each round is stored.
    """
    edges = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "links")
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (
            both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a < b").distinct()
        )
        large = stored(large, "large-star")
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").select(F.col("a"), F.col("b"), "m")
        small = small.select(F.explode(F.array(F.struct("m", F.col("a").alias("n")), F.struct("m", F.col("b").alias("n")))).alias("e"))
        after = stored(small.select(F.col("e.m").alias("a"), F.col("e.n").alias("b")).where("a < b").distinct(), "small-star")
        # settled: stars only, so no centre is a leaf and no leaf has two centres
        open_ = after.groupBy("b").agg(F.count("*").alias("n")).where("n > 1").limit(1).count() or (
            after.join(after.select(F.col("b").alias("a")).distinct(), "a", "left_semi").limit(1).count()
        )
        edges = after
        if not open_:
            leaves = edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
            return leaves.union(edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())


def near_duplicates(docs: DataFrame, bits: int = 3, size: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, fp and component_id (the least id reachable) of every document."""
    printed = stored(docs.select("doc_id", fingerprints("text", size, seed).alias("fp")), "fingerprints")
    return classes(printed, bits)


def classes(printed: DataFrame, bits: int = 3) -> DataFrame:
    """``printed`` (doc_id, fp and any more columns) with the component_id of each row's fingerprint."""
    nodes = stored(printed.groupBy("fp").agg(F.min("doc_id").alias("node")), "fingerprint-nodes")
    found = components(links(nodes.where("node is not null"), bits))
    named = nodes.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return printed.join(named, "fp").select(*printed.columns, "component_id")


def deduplicated(docs: DataFrame, bits: int = 3, size: int = 3, seed: int = 42) -> DataFrame:
    """One document of each component, with all its columns.

    It is the row whose id leads the component. Of several rows with that id in the component the one whose
    columns have the least digest stays, so the choice does not depend on the partitioning. Rows that share an
    id but no component stay one each where they lead. Rows without an id cannot be named and stay.
    """
    names = docs.columns
    digest = F.md5(F.to_json(F.struct(*[docs[c] for c in names])))
    own = docs.where("doc_id is not null").select("*", digest.alias("__digest"))
    printed = stored(own.select("doc_id", fingerprints("text", size, seed).alias("fp"), "__digest"), "fingerprints")
    leading = classes(printed, bits).where("component_id = doc_id")
    kept = stored(leading.groupBy("doc_id").agg(F.min("__digest").alias("__digest")), "kept-documents")
    joined = own.join(kept, ["doc_id", "__digest"], "left_semi")
    nth = F.row_number().over(Window.partitionBy("doc_id", "__digest").orderBy("doc_id"))
    once = joined.withColumn("__nth", nth).where("__nth = 1")
    return once.select(*names).union(docs.where("doc_id is null"))
