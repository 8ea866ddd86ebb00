"""Quality rules with thresholds that adapt to language and source.

Base counts come from one pass over whole texts. Four ratios of them are
summarised per language and source in quantile sketches whose buckets grow
geometrically (counts of a bounded number of buckets, so sketches merge by
addition and do not depend on the order of rows). Fences of each group's
quartiles replace fixed cut-offs; a join brings them back to the documents.

Defined results: a null or empty text has zero counts and fails the base rule;
null languages and sources form groups of their own; repeated rows count each.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from matchlore.llm import kernels
from matchlore.llm.shared import small, stored

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
_TYPE = "struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Ratio:
    """A ratio that is judged; ``spread`` is the least distance between quartiles."""

    name: str
    top: str
    bottom: str
    spread: float
    low: bool


RATIOS = (
    Ratio("symbols", "n_symbols", "n_words", 0.08, False),
    Ratio("dup_lines", "n_dup_lines", "n_lines", 0.15, False),
    Ratio("repeat_words", "n_repeat_words", "n_words", 0.12, False),
    Ratio("word_length", "word_chars", "n_words", 0.75, True),
)


def _distinct(text: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """One key per (text, hash) pair."""
    return kernels.mix(hashes + text.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def count_piece(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The base counts of each text of a piece."""
    rows = len(offsets) - 1
    starts, ends = kernels.words(data, offsets)
    bounds = np.searchsorted(starts, offsets)
    text = np.repeat(np.arange(rows), np.diff(bounds))
    run = kernels.RunHashes(data)
    out = {"n_words": np.diff(bounds)}
    code_points = (data & 0xC0) != 0x80
    out["word_chars"] = kernels.per_text(code_points & ~kernels.SPACE[data], offsets)
    out["n_symbols"] = kernels.per_text(_SYMBOL[data], offsets)
    line_starts = np.union1d(np.flatnonzero(data == 10) + 1, offsets[:-1])
    line_starts = line_starts[line_starts < len(data)]
    line_text = np.searchsorted(offsets, line_starts, "right") - 1
    line_ends = np.append(line_starts[1:], len(data))
    broken = np.zeros(len(line_starts), bool)
    if len(data):
        broken = (data[line_ends - 1] == 10) & (line_ends > line_starts)
    line_ends = line_ends - broken
    worded = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_text, line_starts, line_ends = line_text[worded], line_starts[worded], line_ends[worded]
    out["n_lines"] = np.bincount(line_text, minlength=rows)
    _, kept = np.unique(_distinct(line_text, run(line_starts, line_ends)), return_index=True)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(line_text[kept], minlength=rows)
    covered = np.zeros(len(starts), bool)
    if len(starts) > 3:
        word_run = kernels.RunHashes(run(starts, ends))
        first = np.flatnonzero(text[:-2] == text[2:])
        keys = _distinct(text[first], word_run(first, first + 3))
        order = np.argsort(keys)
        same = keys[order[1:]] == keys[order[:-1]]
        twice = np.zeros(len(first), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        for step in range(3):
            covered[first[twice] + step] = True
    out["n_repeat_words"] = np.diff(np.concatenate(([0], np.cumsum(covered)))[bounds])
    return out


def _counted(text: pa.Array) -> pa.Array:
    parts = [count_piece(data, offsets) for _, _, data, offsets in kernels.pieces(text)]
    columns = [np.concatenate([p[c] for p in parts] or [np.zeros(0)]).astype(np.int64) for c in COUNTS]
    return pa.StructArray.from_arrays([pa.array(c) for c in columns], list(COUNTS))


def base_counts(text: str = "text") -> Column:
    """A struct of ``COUNTS`` for a text column."""
    return F.arrow_udf(_counted, _TYPE)(text)


def base_failed(min_words: int = 50, repeat_percent: int = 50) -> Column:
    words, repeated = F.col("_counts.n_words"), F.col("_counts.n_repeat_words")
    return (words < min_words) | (100 * repeated > repeat_percent * words)


def _ratio(ratio: Ratio) -> Column:
    top, bottom = F.col(f"_counts.{ratio.top}"), F.col(f"_counts.{ratio.bottom}")
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def sketches(counted: DataFrame, accuracy: float = 0.01) -> DataFrame:
    """Quantile sketches: rows (lang, source, ratio, bucket, n).

    Bucket b holds the values in (g**(b-1), g**b] with g = (1 + a) / (1 - a), so
    a quantile is off by the relative ``accuracy`` at most; values up to 1e-4 share
    one bucket. Adding up n merges sketches.
    """
    growth = math.log((1 + accuracy) / (1 - accuracy))
    values = F.array(*[F.struct(F.lit(r.name).alias("ratio"), _ratio(r).alias("value")) for r in RATIOS])
    bucket = F.ceil(F.log(F.greatest("entry.value", F.lit(1e-4))) / growth).cast("int")
    return (
        counted.select("lang", "source", F.explode(values).alias("entry"))
        .groupBy("lang", "source", F.col("entry.ratio").alias("ratio"), bucket.alias("bucket"))
        .agg(F.count("*").alias("n"))
    )


def _quartiles(sketch: DataFrame, keys: list[str], accuracy: float) -> DataFrame:
    growth = math.log((1 + accuracy) / (1 - accuracy))
    group = Window.partitionBy(*keys, "ratio")
    merged = sketch.groupBy(*keys, "ratio", "bucket").agg(F.sum("n").alias("n"))
    ranked = merged.select(
        *keys, "ratio", "bucket",
        F.sum("n").over(group.orderBy("bucket")).alias("upto"),
        F.sum("n").over(group).alias("total"),
    )
    # the middle of a bucket in the relative sense
    value = F.exp(F.col("bucket") * growth) * (1 - accuracy)
    at = lambda q: F.min(F.when(F.col("upto") >= q * F.col("total"), value))
    return ranked.groupBy(*keys, "ratio").agg(at(0.25).alias("q1"), at(0.75).alias("q3"), F.first("total").alias("total"))


def fences(sketch: DataFrame, width: float = 3.0, least_rows: int = 100, accuracy: float = 0.01) -> DataFrame:
    """One row per language and source with the allowed range of each ratio.

    A range reaches ``width`` quartile distances (at least the ratio's spread) beyond
    the quartiles. Groups of fewer than ``least_rows`` documents take the merged sketch of
    their language, and beyond that the one of all documents.
    """
    by_source = _quartiles(sketch, ["lang", "source"], accuracy)
    by_lang = _quartiles(sketch, ["lang"], accuracy).selectExpr("lang as l_lang", "ratio as l_ratio", "q1 as l1", "q3 as l3", "total as lt")
    over_all = _quartiles(sketch, [], accuracy).selectExpr("ratio as a_ratio", "q1 as a1", "q3 as a3")
    joined = by_source.join(
        by_lang, F.col("lang").eqNullSafe(F.col("l_lang")) & (F.col("ratio") == F.col("l_ratio"))
    ).join(over_all, F.col("ratio") == F.col("a_ratio"))
    pick = lambda own, lang, all_: F.when(F.col("total") >= least_rows, F.col(own)).when(
        F.col("lt") >= least_rows, F.col(lang)).otherwise(F.col(all_))
    picked = joined.select("lang", "source", "ratio", pick("q1", "l1", "a1").alias("q1"), pick("q3", "l3", "a3").alias("q3"))
    bounds = []
    for r in RATIOS:
        reach = width * F.greatest(F.col("q3") - F.col("q1"), F.lit(r.spread))
        mine = F.col("ratio") == r.name
        bounds.append(F.max(F.when(mine, F.col("q3") + reach)).alias(f"max_{r.name}"))
        if r.low:
            bounds.append(F.max(F.when(mine, F.col("q1") - reach)).alias(f"min_{r.name}"))
    return picked.groupBy("lang", "source").agg(*bounds)


def _verdict() -> Column:
    fine = F.lit(True)
    for r in RATIOS:
        fine = fine & (_ratio(r) <= F.col(f"_fence.max_{r.name}"))
        if r.low:
            fine = fine & (_ratio(r) >= F.col(f"_fence.min_{r.name}"))
    return F.coalesce(fine, F.lit(False))


def judge(counted: DataFrame, fence: DataFrame, min_words: int = 50, repeat_percent: int = 50) -> DataFrame:
    """Documents with ``_counts`` get ``_base_failed`` and ``_kept``; all other columns stay."""
    names = fence.columns
    bounds = small(
        fence.select(F.struct(*names).alias("_fence"), F.col("lang").alias("_lang"), F.col("source").alias("_source")), 10_000
    )
    joined = counted.join(
        bounds, counted["lang"].eqNullSafe(bounds["_lang"]) & counted["source"].eqNullSafe(bounds["_source"]), "left"
    )
    failed = base_failed(min_words, repeat_percent)
    return joined.withColumns({"_base_failed": failed, "_kept": ~failed & _verdict()}).drop("_fence", "_lang", "_source")


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed and kept of every document."""
    narrow = docs.select("doc_id", "lang", "source", base_counts("text").alias("_counts"))
    counted = stored(narrow, "quality-counts")
    judged = judge(counted, stored(fences(sketches(counted)), "quality-fences"))
    return judged.select("doc_id", *[f"_counts.{c}" for c in COUNTS if c != "n_lines"],
                         F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"))


def quality_filter(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns.

    The counts are made anew for the filter instead of being joined by id, so no text is shuffled.
    """
    names = docs.columns
    counted = stored(docs.select("lang", "source", base_counts("text").alias("_counts")), "quality-counts")
    fence = stored(fences(sketches(counted)), "quality-fences")
    judged = judge(docs.select("*", base_counts("text").alias("_counts")), fence)
    return judged.where("_kept").select(*names)
