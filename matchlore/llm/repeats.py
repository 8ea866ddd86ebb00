"""Where windows of fixed length may repeat: anchors shared by both substring operators.

A window is ``window`` consecutive units (bytes or words). Its anchor is the run of
``gram`` units inside it whose hash is least, the leftmost if several are. Equal windows
have equal anchors at equal places, so a window can only repeat where its anchor does. All windows
of one text that share an anchor occurrence lie side by side; what they cover is a
segment. Segments with the same anchor are aligned at it, and whether their windows
repeat is decided among them alone.

Equal segments of one anchor (by two independent 64-bit hashes, of anchor and of segment)
form a class, so a passage that thousands of texts share is one row with its number of
occurrences. Both hashes have to collide before two classes could be confused.

A text is known by its id and a hash of its content, so repeated rows share what is found
for them and different texts of the same or a null id do not.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlore.llm import kernels
from matchlore.llm.shared import stored

#: Columns that name a text.
TEXT = ("_id", "_hash")
_AT_ONCE = 1 << 18
_PLACE = (1 << 24) - 1
_TEXTS = 200
OCCURRENCES = "array<struct<anchor:bigint,segment:bigint,first:int,n:int,left:int>>"


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns that name a text; a null id counts as the largest."""
    return docs.withColumns({
        "_id": F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)),
        "_hash": F.xxhash64(F.coalesce("text", F.lit("")), F.col("doc_id").isNull()),
    })


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, from running minima of blocks in both directions."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    onward = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], onward[width - 1 : width - 1 + n])


def anchors(units: np.ndarray, bounds: np.ndarray, window: int, gram: int) -> dict[str, np.ndarray]:
    """Anchor occurrences of the texts that lie at ``bounds`` in ``units``.

    Each has the hash of its anchor, the hash of its segment, the first window's place in the
    text, the number of windows and how far right of the first window's start the anchor stands.
    Long sequences are worked on in stretches of windows, so memory is bounded.
    """
    names, found = ("text", "anchor", "segment", "first", "n", "left"), []
    for begin in range(0, max(0, len(units) - window + 1), _AT_ONCE):
        stretch = units[begin : begin + _AT_ONCE + window - 1]
        starts = np.arange(len(stretch) - window + 1)
        text = np.searchsorted(bounds, starts + begin, "right") - 1
        inside = starts + begin + window <= bounds[text + 1]
        if not inside.any():
            continue
        run = kernels.RunHashes(stretch)
        grams = np.arange(len(stretch) - gram + 1)
        hashes = run(grams, grams + gram)
        # the place breaks ties, so the leftmost wins; a stretch is shorter than 2**24 units
        order = (hashes & ~np.uint64(_PLACE)) | grams.astype(np.uint64)
        at = (_least(order, window - gram + 1) & np.uint64(_PLACE)).astype(np.int64)
        starts, text, at = starts[inside], text[inside], at[inside]
        first = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (text[1:] != text[:-1])])
        n = np.diff(np.r_[first, len(starts)])
        lo, at, text = starts[first], at[first], text[first]
        left = at - lo
        segment = kernels.mix(run(lo, lo + n + window - 1) + left.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
        found.append((text, hashes[at], segment, lo + begin - bounds[text], n, left))
    if not found:
        return {k: np.zeros(0, np.int64) for k in names}
    return dict(zip(names, map(np.concatenate, zip(*found))))


def as_lists(found: list[dict[str, np.ndarray]], rows: list[int]) -> pa.Array:
    """Occurrences of consecutive pieces of ``rows`` texts each, as one list per text."""
    counts = [np.bincount(f["text"], minlength=n) for f, n in zip(found, rows)]
    offsets = np.r_[0, np.cumsum(np.concatenate([np.zeros(0, np.int64), *counts]))].astype(np.int32)
    join = lambda k, kind: pa.array(np.concatenate([np.zeros(0, kind), *[f[k].astype(np.uint64).view(np.int64) for f in found]]).astype(kind))
    fields = [join("anchor", np.int64), join("segment", np.int64), *[join(k, np.int32) for k in ("first", "n", "left")]]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(fields, ["anchor", "segment", "first", "n", "left"]))


def byte_occurrences(window: int, gram: int) -> Callable[[pa.Array], pa.Array]:
    def of(text: pa.Array) -> pa.Array:
        found, rows = [], []
        for row, end, data, offsets in kernels.pieces(text):
            found.append(anchors(data, offsets, window, gram))
            rows.append(end - row)
        return as_lists(found, rows)

    return of


def word_occurrences(window: int, gram: int) -> Callable[[pa.Array], pa.Array]:
    def of(text: pa.Array) -> pa.Array:
        found, rows = [], []
        for row, end, data, offsets in kernels.pieces(text):
            starts, ends = kernels.words(data, offsets)
            hashes = kernels.RunHashes(data)(starts, ends)
            found.append(anchors(hashes, np.searchsorted(starts, offsets), window, gram))
            rows.append(end - row)
        return as_lists(found, rows)

    return of


def repeated(texts: DataFrame, occurrences: Callable[[pa.Array], pa.Array], several_texts: bool) -> DataFrame:
    """Occurrences (anchor, segment, first, n, left, name of text) of anchors that occur more than once.

    With ``several_texts`` the anchor has to occur under more than one id. Stored.
    """
    find = F.arrow_udf(occurrences, OCCURRENCES)
    found = texts.select(*TEXT, find(F.coalesce("text", F.lit(""))).alias("_o"))
    every = stored(found.select(*TEXT, F.explode("_o").alias("o")).select(*TEXT, "o.*"), "occurrences")
    per_anchor = every.groupBy("anchor")
    if several_texts:
        again = per_anchor.agg(F.min("_id").alias("a"), F.max("_id").alias("b")).where("a < b").select("anchor")
    else:
        again = per_anchor.agg(F.count("*").alias("c")).where("c > 1").select("anchor")
    # stored first: a join of two plain shuffles is one that Spark can split where an anchor is hot
    return stored(every.join(stored(again, "anchors-again"), "anchor"), "repeated-anchors")


def with_segments(classes: DataFrame, texts: DataFrame, cut: Callable[[bytes, int, int], bytes]) -> DataFrame:
    """``classes`` (anchor, segment, others, place: struct of name of text, first, n, left) with ``content``.

    The places are gathered per text (as many as its length allows), so each text is met once.
    ``cut(text, first, n)`` gives a segment's content.
    """
    others = [c for c in classes.columns if c != "place"]
    wanted = classes.groupBy(*[F.col(f"place.{c}").alias(c) for c in TEXT]).agg(
        F.collect_list(F.struct(*others, "place.first", "place.n", "place.left")).alias("_wanted")
    )

    @F.arrow_udf("array<binary>")
    def contents(text: pa.Array, firsts: pa.Array, ns: pa.Array) -> pa.Array:
        # in runs of texts: as Python objects the contents take several times their size
        kind, parts = pa.list_(pa.binary()), []
        for at in range(0, len(text), _TEXTS):
            rows = zip(text[at : at + _TEXTS], firsts[at : at + _TEXTS].to_pylist(), ns[at : at + _TEXTS].to_pylist())
            parts.append(pa.array([cut((t.as_py() or "").encode(), first, n) for t, first, n in rows], kind))
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    joined = texts.join(wanted, list(TEXT)).select(
        "_wanted", contents("text", F.col("_wanted.first"), F.col("_wanted.n")).alias("_contents")
    )
    zipped = F.explode(F.arrays_zip("_wanted", "_contents")).alias("z")
    out = joined.select(zipped).select("z._wanted.*", F.col("z._contents").alias("content"))
    # rows that repeat an id and a text have given the same segments again
    return out.dropDuplicates(["anchor", "segment"])


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, rows: int) -> Iterator[pa.Table]:
    """Tables of about ``rows`` rows that hold whole groups of ``key``, from rows sorted by it."""
    waiting: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        waiting.append(batch)
        held += batch.num_rows
        if held < rows:
            continue
        table = pa.Table.from_batches(waiting).combine_chunks()
        values = table[key].to_numpy()
        border = int(np.searchsorted(values, values[-1]))
        if border:
            yield table.slice(0, border)
        rest = table.slice(border)
        waiting, held = rest.to_batches(), rest.num_rows
    if held:
        yield pa.Table.from_batches(waiting).combine_chunks()


def merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Overlapping or touching spans as one, in order."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def span_lists(covered: DataFrame) -> DataFrame:
    """One row per text with all its spans (``_from``, ``_to``), merged later inside the text's row."""
    return covered.groupBy(*TEXT).agg(F.collect_set(F.struct("_from", "_to")).alias("_spans"))


def place() -> Column:
    return F.struct(*TEXT, "first", "n", "left")
