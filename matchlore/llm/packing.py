"""Best-fit decreasing packing of tokenised documents into sequences.

Lengths are whole numbers up to the capacity, so all that best-fit decreasing needs
to know is how many pieces of each length there are: at most ``capacity`` counts,
whatever the number of documents. A segment tree over remaining capacities finds
the tightest open sequences for a length in logarithmic time, and equal pieces are
placed many at once: the plan is a table of runs (pieces r to r + n of a length go, q
each, to consecutive sequences). It is exactly what placing piece by piece would give.
The pieces themselves then find their place by their exact rank among pieces of
their length, counted in two steps so that a length that most pieces have (the
full one) is not ranked in one task.

Defined results: a null or empty text is one piece, the end token; repeated rows are packed each, rows without an id as well;
a text of any length and kind is encoded whole; an empty table gives no pieces. Other columns are not read.
"""

from __future__ import annotations

import base64
import os
import zlib
from bisect import insort

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from matchlore.llm.shared import stored

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
_encoders: dict[str, Encoder] = {}


class Encoder:
    """Token ids of texts as little-endian bytes.

    The rank file beside the tokenizer's file holds the same vocabulary and gives the same ids several
    times faster (tests compare them); without one, and for texts whose runs of white space are too long for
    its pattern, the tokenizer itself is used.
    """

    def __init__(self, path: str):
        self.tokenizer, self.ranked = Tokenizer.from_file(path), None
        ranks = path.removesuffix(".json") + ".tiktoken"
        if os.path.exists(ranks):
            with open(ranks, "rb") as lines:
                table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
            self.ranked = tiktoken.Encoding(
                ranks, pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens=special
            )

    def __call__(self, text: str) -> bytes:
        if self.ranked is not None:
            try:
                return self.ranked.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()
            except ValueError:  # the pattern's stack, which about half a million blanks in a row exceed
                pass
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def piece_bounds(total: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces; only the first may be shorter than ``capacity``."""
    first = total % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, total, capacity)]


def tokenised(docs: DataFrame, capacity: int = 2048, path: str = VOCABULARY, end: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, in pieces of at most ``capacity`` tokens."""

    @F.arrow_udf("array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint>>")
    def cut(text: pa.Array) -> pa.Array:
        encode, stop = encoder(path), np.array([end], "<u4").tobytes()
        rows = []
        for value in text:
            ids = encode(value.as_py() or "") + stop
            rows.append([
                {"piece": n, "start": at, "length": size, "ids_crc32": zlib.crc32(ids[4 * at : 4 * (at + size)])}
                for n, (at, size) in enumerate(piece_bounds(len(ids) // 4, capacity))
            ])
        fields = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
        return pa.array(rows, pa.list_(pa.struct(fields)))

    # named before the explode, so the texts are encoded once
    cuts = docs.select("doc_id", cut("text").alias("_pieces"))
    return cuts.select("doc_id", F.explode("_pieces").alias("_p")).select("doc_id", "_p.*")


class _Open:
    """Open sequences by remaining capacity: runs of numbers, and a segment tree over capacities."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.tree = bytearray(2 * self.leaves)
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def _mark(self, room: int) -> None:
        node = self.leaves + room
        self.tree[node] = bool(self.runs.get(room))
        while node > 1:
            node //= 2
            self.tree[node] = self.tree[2 * node] | self.tree[2 * node + 1]

    def add(self, room: int, first: int, count: int) -> None:
        if room:
            insort(self.runs.setdefault(room, []), (first, count))
            self._mark(room)

    def tightest(self, size: int) -> int:
        """The least remaining capacity of at least ``size`` that is open, or 0."""
        node = self.leaves + size
        if self.tree[node]:
            return size
        while node > 1:
            if not node & 1 and self.tree[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.tree[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return 0

    def take(self, room: int, most: int) -> tuple[int, int]:
        """Up to ``most`` sequences with consecutive numbers out of those with ``room`` left."""
        first, count = self.runs[room].pop(0)
        if count > most:
            self.runs[room].insert(0, (first + most, count - most))
        self._mark(room)
        return first, min(count, most)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first_rank, pieces, each, first_sequence, offset) of best-fit decreasing.

    ``each`` pieces of a run go one behind the other into the same sequence. The number of runs
    depends on the capacity alone: a length uses up whole classes of open sequences and
    splits one at most.
    """
    opened, sequences, runs = _Open(capacity), 0, []
    for size in sorted((s for s in counts if counts[s]), reverse=True):
        rank, left = 0, counts[size]
        while left:
            room = opened.tightest(size)
            if not room:
                room, need = capacity, -(-left // (capacity // size))
                opened.add(room, sequences, need)
                sequences += need
            each = min(room // size, left)
            first, n = opened.take(room, left // each)
            runs.append((size, rank, n * each, each, first, capacity - room))
            opened.add(room - each * size, first, n)
            rank, left = rank + n * each, left - n * each
    return runs


def packed(pieces: DataFrame, capacity: int = 2048, block: int = 100_000) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ids_crc32) with sequence_id and offset.

    ``pieces`` is read twice, so pass a stored table. Pieces of one length are ranked in blocks of
    about ``block`` rows: by block of a hash, and by order inside it. The plan that every task
    gets has a number of runs that the capacity bounds.
    """
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = np.array(plan(counts, capacity), np.int64).reshape(-1, 6)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    shared = pieces.sparkSession.sparkContext.broadcast(runs)

    @F.arrow_udf("struct<sequence_id:bigint,offset:bigint>")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        table, size, nth = shared.value, length.to_numpy(), rank.to_numpy()
        # ranks stay below 2**48 and lengths below 2**15
        at = np.searchsorted(table[:, 0] << 48 | table[:, 1], size << 48 | nth, "right") - 1
        _, first_rank, _, each, first, start = table[at].T
        into, behind = np.divmod(nth - first_rank, each)
        return pa.StructArray.from_arrays(
            [pa.array(first + into), pa.array(start + behind * size)], ["sequence_id", "offset"]
        )

    blocks = max(1, sum(counts.values()) // block)
    dealt = pieces.withColumn("_block", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(blocks)))
    sizes = dealt.groupBy("length", "_block").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_block")) - F.col("_n")
    offsets = sizes.select("length", "_block", before.alias("_before"))
    inside = Window.partitionBy("length", "_block").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = dealt.withColumn("_in", F.row_number().over(inside) - 1).join(offsets, ["length", "_block"])
    placed = ranked.withColumn("_at", place("length", F.col("_in") + F.col("_before")))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "_at.*")


def packed_documents(docs: DataFrame, capacity: int = 2048, path: str = VOCABULARY, end: int = 0) -> DataFrame:
    """Tokenise, cut and pack all documents."""
    return packed(stored(tokenised(docs, capacity, path, end), "packing-pieces"), capacity)
