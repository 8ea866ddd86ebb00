"""Importance resampling of documents towards the texts of a target table.

Features are runs of words, hashed to buckets by CRC-32. A bucket's gain is the logarithm of how much
more frequent it is in the target than in all documents; a document weighs the sum of its gains, and
Gumbel noise from a hash of its id turns the highest weights into a draw without replacement.

The features of a batch come from Arrow kernels: ``ascii_lower``, ``split_pattern_regex``,
``list_flatten`` and ``dictionary_encode`` give one index per word; indices beside each other form
n-grams, CRCs are computed once per distinct word or pair (a CRC continues from that of the run before its
last word), ``take`` spreads them over the features and gains are added up per document.

Defined results: a null or empty text has no features and weight 0; a null doc_id takes part under the empty
name and comes last among ties; repeated rows are drawn each; rows beyond the share have no rank; with no
target texts or no documents all counts are 0 and the formulas hold as they are.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from matchlore.llm import kernels
from matchlore.llm.shared import stored

#: What separates words: every ASCII character that is no letter or digit.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
_PIECE = 1 << 21


def features(texts: pa.Array, longest: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows and CRCs of all runs of 1 to ``longest`` words, and the words of each row."""
    lists = pc.split_pattern_regex(pc.ascii_lower(texts), BETWEEN)
    words, row = pc.list_flatten(lists), pc.list_parent_indices(lists)
    filled = pc.greater(pc.binary_length(words), 0)
    words, row = words.filter(filled), row.filter(filled).to_numpy().astype(np.int64)
    coded = pc.dictionary_encode(words)
    index, known = coded.indices.to_numpy().astype(np.int64), [w.encode() for w in coded.dictionary.to_pylist()]
    crcs = np.fromiter(map(zlib.crc32, known), np.int64, len(known))
    run, rows, found = index, [row], [crcs.take(index)]
    for size in range(2, longest + 1):
        # run[i] names the words from i on, so the next longer run is (run[i], last word)
        whole = row[: len(row) - size + 1] == row[size - 1 :]
        pairs, run = np.unique(run[: len(whole)] * max(1, len(known)) + index[size - 1 :], return_inverse=True)
        before, last = np.divmod(pairs, max(1, len(known)))
        crcs = np.fromiter((zlib.crc32(b" " + known[w], c) for c, w in zip(crcs[before].tolist(), last.tolist())), np.int64, len(pairs))
        rows.append(row[: len(whole)][whole])
        found.append(crcs.take(run)[whole])
    return np.concatenate(rows), np.concatenate(found), np.bincount(row, minlength=len(texts))


def _pieces(column: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Runs of texts of about ``_PIECE`` bytes, nulls empty."""
    column = pc.fill_null(column, "")
    for first, end, _, _ in kernels.pieces(column, _PIECE):
        yield first, column.slice(first, end - first)


def bucket_counts(docs: DataFrame, longest: int = 1, buckets: int = BUCKETS) -> dict[int, int]:
    """Features in each bucket, over all texts; at most ``buckets`` numbers leave each task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, texts in _pieces(batch.column(0)):
                sums += np.bincount(features(texts, longest)[1] % buckets, minlength=buckets)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some])], ["bucket", "n"])

    counted = docs.select("text").mapInArrow(count, "bucket bigint, n bigint")
    return {r["bucket"]: r["n"] for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}


def gains(everywhere: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 * ln((t + 1) * (S + buckets) / ((s + 1) * (T + buckets)))) of each bucket."""
    total, aim = sum(everywhere.values()), sum(target.values())
    found = []
    for bucket in range(buckets):
        s, t = everywhere.get(bucket, 0), target.get(bucket, 0)
        found.append(math.floor(1000 * math.log(float(t + 1) * (total + buckets) / (float(s + 1) * (aim + buckets)))))
    return np.array(found, np.int64)


def weights(text: str | Column, table: np.ndarray, longest: int = 1) -> Column:
    """n_words, n_features and weight (the sum of gains) of a text column, as a struct."""
    buckets = len(table)

    @F.arrow_udf("struct<n_words:bigint,n_features:bigint,weight:bigint>")
    def of(column: pa.Array) -> pa.Array:
        sums = np.zeros((3, len(column)), np.int64)
        for first, texts in _pieces(column):
            row, crcs, n_words = features(texts, longest)
            part = sums[:, first : first + len(texts)]
            part[0], part[1] = n_words, np.bincount(row, minlength=len(texts))
            order = np.argsort(row, kind="stable")
            upto = np.concatenate([[0], np.cumsum(table.take(crcs[order] % buckets))])
            part[2] = np.diff(upto[np.concatenate([[0], np.cumsum(part[1])])])
        return pa.StructArray.from_arrays([pa.array(s) for s in sums], ["n_words", "n_features", "weight"])

    return of(text)


def noise(doc_id: str | Column = "doc_id", seed: int = 2024) -> Column:
    """floor(-1000 * ln(-ln(u))), u from the first 32 bits of the SHA-256 of ``seed:doc_id``."""
    name = F.coalesce((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string"), F.lit(""))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), name), 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")


def ranked(scored: DataFrame, share: int = 10) -> DataFrame:
    """``scored`` (doc_id, score, eligible, ...) with the rank of the drawn rows.

    Drawn are floor(``share`` percent) of the eligible rows, by falling score, ties by doc_id. Rows are dealt to
    tasks by ranges of that order; a range's ranks start behind the rows of the ranges before it.
    """
    # equal rows get a number of their own before they are dealt out, so that ranges can cut between them
    table = stored(scored.withColumn("_nth", F.monotonically_increasing_id()), "resampling-scores")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_nth")]
    dealt = table.where("eligible").repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    dealt = stored(dealt, "resampling-ranges")
    sizes = dealt.groupBy("_range").agg(F.count("*").alias("_n"))
    # one row per range, at most the number of shuffle partitions
    before = F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")
    ahead = sizes.select("_range", before.alias("_before"), F.sum("_n").over(Window.partitionBy()).alias("_all"))
    nth = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) + F.col("_before")
    placed = dealt.join(F.broadcast(ahead), "_range").withColumn("rank", nth)
    drawn = F.floor(F.col("_all") * share / 100)
    placed = placed.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank").cast("bigint")))
    others = table.where("not eligible").withColumn("rank", F.lit(None).cast("bigint"))
    return placed.select(*scored.columns, "rank").union(others.select(*scored.columns, "rank"))


def resampled(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = BUCKETS, min_words: int = 20,
              share: int = 10, seed: int = 2024) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document; drawn are those with a rank."""
    table = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets), buckets)
    weighed = docs.select("doc_id", weights("text", table, longest).alias("w"))
    scored = weighed.select(
        "doc_id", "w.n_features", "w.weight", (F.col("w.weight") + noise("doc_id", seed)).alias("score"),
        (F.col("w.n_words") >= min_words).alias("eligible"),
    )
    return ranked(scored, share).drop("eligible")
