"""Registered queries of the operators for training data, with SQL where SQL can express them."""

from __future__ import annotations

import math
import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from matchlore.llm import (
    filters, fmindex, html, languages, links, mixing, packing, quality, resampling, secrets, simhash, suffixes, vantage,
)


def _table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


def op1_html_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return html.extracted(_table(spark, folder, "pages", "page_id", "url", "html"))


def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed_documents(_table(spark, folder, "documents", "doc_id", "text"))


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, folder, "documents", "doc_id", "text"))
    return found.select("doc_id", simhash.hex16("fp").alias("fingerprint"), "component_id")


def op4_suffix_array(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.byte_digests(_table(spark, folder, "documents", "doc_id", "text"))


def op5_fm_index(spark: SparkSession, folder: str) -> DataFrame:
    return fmindex.word_digests(_table(spark, folder, "documents", "doc_id", "text"))


def op6_language_codes(spark: SparkSession, folder: str) -> DataFrame:
    return languages.identified(_table(spark, folder, "documents", "doc_id", "text", "lang"))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed_sizes(_table(spark, folder, "documents", "doc_id", "text", "source"))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_verdicts(_table(spark, folder, "documents", "doc_id", "text", "lang", "source"))


def op9_vantage_trees(spark: SparkSession, folder: str) -> DataFrame:
    return vantage.nearest(_table(spark, folder, "embeddings", "vec_id", "embedding"))


def op10_url_trust(spark: SparkSession, folder: str) -> DataFrame:
    return links.judged(_table(spark, folder, "pages", "page_id", "url", "html"))


def op11_grammar_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digests(_table(spark, folder, "documents", "doc_id", "text"))


def op12_importance(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.resampled(_table(spark, folder, "documents", "doc_id", "text"), _table(spark, folder, "benchmark", "text"))


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents", "doc_id", "text", "lang")
    return filters.interactions(docs, _table(spark, folder, "labels", "doc_id", "quality", "toxic"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_blocks": op1_html_blocks,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_simhash": op3_simhash,
    "op4_suffix_array": op4_suffix_array,
    "op5_fm_index": op5_fm_index,
    "op6_language_codes": op6_language_codes,
    "op7_mixing": op7_mixing,
    "op8_quality": op8_quality,
    "op9_vantage_trees": op9_vantage_trees,
    "op10_url_trust": op10_url_trust,
    "op11_grammar_secrets": op11_grammar_secrets,
    "op12_importance": op12_importance,
    "op13_filter_audit": op13_filter_audit,
}

_BLACK = r"[^\x20\x09-\x0D]"
_WORDS = f"regexp_extract_all(coalesce(text, ''), '{_BLACK}+')"

_OP5 = f"""WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
 windows AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS k FROM w, unnest(range(1, len(ws) - 48)) AS t(i)),
 firsts AS (SELECT k, min(doc_id) AS f FROM windows GROUP BY k),
 covered AS (SELECT DISTINCT doc_id, i + o AS p FROM windows JOIN firsts USING (k), unnest(range(50)) AS t(o) WHERE f < doc_id),
 each AS (SELECT doc_id, p, ws[p] AS word FROM w, unnest(range(1, len(ws) + 1)) AS t(p)),
 kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS words
   FROM each ANTI JOIN covered USING (doc_id, p) GROUP BY 1)
 SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
   sha256(coalesce(words, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)"""

_FILLING = "ORDER BY cap / weight, source IS NULL, encode(source)"

_OP7 = f"""WITH d AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size,
   md5('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k FROM documents),
 s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
 w AS (SELECT *, CASE (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3
     WHEN 0 THEN 5::DOUBLE WHEN 1 THEN 2::DOUBLE ELSE 1::DOUBLE END AS weight, 2::DOUBLE * source_size AS cap FROM s),
 v AS (SELECT *, (1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE)
     - coalesce(sum(cap) OVER ({_FILLING} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0::DOUBLE))
   / sum(weight) OVER ({_FILLING} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
 t AS (SELECT source, source_size, CASE WHEN cap <= weight * level THEN cap ELSE weight *
     (SELECT arg_min(level, cap / weight) FROM v WHERE cap > weight * level) END AS target FROM v),
 r AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
 q AS (SELECT *, CAST(round(target - whole * source_size) AS BIGINT) AS rest FROM r)
 SELECT doc_id, size, source_size, target, CAST(whole * size + greatest(0, least(size, rest - sum(size) OVER (
   PARTITION BY d.source ORDER BY k, size ROWS UNBOUNDED PRECEDING) + size)) AS BIGINT) AS taken
 FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source"""

_GROWTH = repr(math.log(1.01 / 0.99))
_PICK = "CASE WHEN g.total >= 100 THEN g.{0} WHEN l.total >= 100 THEN l.{0} ELSE a.{0} END AS {0}"


def _quartiles(keys: str) -> str:
    comma = ", " if keys else ""
    return f"""SELECT {keys}{comma}ratio, min(CASE WHEN upto >= 0.25 * total THEN v END) AS q1,
     min(CASE WHEN upto >= 0.75 * total THEN v END) AS q3, min(total) AS total
   FROM (SELECT {keys}{comma}ratio, exp(bucket * {_GROWTH}::DOUBLE) * 0.99::DOUBLE AS v,
       sum(n) OVER (PARTITION BY {keys}{comma}ratio ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY {keys}{comma}ratio) AS total
     FROM (SELECT {keys}{comma}ratio, bucket, count(*) AS n FROM sketch GROUP BY ALL)) GROUP BY ALL"""


_OP8 = f"""WITH d AS (SELECT doc_id, lang, source, {_WORDS} AS ws,
   list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_BLACK}')) AS ls,
   len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS n_symbols FROM documents),
 windows AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 2], ' ')) AS k FROM d, unnest(range(1, len(ws) - 1)) AS t(i)),
 again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
 covered AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM again, unnest(range(3)) AS t(o) GROUP BY 1),
 c AS (SELECT doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words,
   CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
   CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
   len(ls) AS n_lines FROM d LEFT JOIN covered USING (doc_id)),
 x AS (SELECT *, CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbols,
   CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_lines,
   CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END AS repeat_words,
   CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS word_length FROM c),
 sketch AS (SELECT lang, source, ratio, ceil(ln(greatest(value, 0.0001::DOUBLE)) / {_GROWTH}::DOUBLE) AS bucket
   FROM (UNPIVOT x ON symbols, dup_lines, repeat_words, word_length INTO NAME ratio VALUE value)),
 g AS ({_quartiles("lang, source")}), l AS ({_quartiles("lang")}), a AS ({_quartiles("")}),
 p AS (SELECT g.lang, g.source, g.ratio, {_PICK.format("q1")}, {_PICK.format("q3")}
   FROM g JOIN l ON g.lang IS NOT DISTINCT FROM l.lang AND g.ratio = l.ratio JOIN a ON a.ratio = g.ratio),
 f AS (SELECT lang, source, max(q3 + 3 * greatest(q3 - q1, 0.08)) FILTER (ratio = 'symbols') AS max_symbols,
   max(q3 + 3 * greatest(q3 - q1, 0.15)) FILTER (ratio = 'dup_lines') AS max_dup_lines,
   max(q3 + 3 * greatest(q3 - q1, 0.12)) FILTER (ratio = 'repeat_words') AS max_repeat_words,
   max(q3 + 3 * greatest(q3 - q1, 0.75)) FILTER (ratio = 'word_length') AS max_word_length,
   max(q1 - 3 * greatest(q3 - q1, 0.75)) FILTER (ratio = 'word_length') AS min_word_length FROM p GROUP BY 1, 2)
 SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
   n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
   NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND symbols <= max_symbols AND dup_lines <= max_dup_lines
     AND repeat_words <= max_repeat_words AND word_length <= max_word_length AND word_length >= min_word_length AS kept
 FROM x JOIN f ON x.lang IS NOT DISTINCT FROM f.lang AND x.source IS NOT DISTINCT FROM f.source"""

_LOWERED = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
_TOKENS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
#: The remainders of all bytes, and a word's checksum as a fold over its bytes.
_HALVE = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
_CRC_TABLE = f"list_transform(range(256), lambda b: list_reduce([b] || range(8), lambda c, i: {_HALVE}))"
_CRC = """xor(list_reduce([4294967295::BIGINT] || list_transform(range(strlen(word)),
     lambda i: CAST('0x' || hex(word)[2 * i + 1 : 2 * i + 2] AS BIGINT)),
   lambda c, b: xor(c >> 8, remainders[(xor(c, b) & 255) + 1])), 4294967295)"""

_OP12 = f"""WITH remainder AS (SELECT {_CRC_TABLE} AS remainders),
 d AS (SELECT doc_id, {_TOKENS} AS ws FROM documents), b AS (SELECT {_TOKENS} AS ws FROM benchmark),
 dw AS (SELECT doc_id, word, count(*) AS n FROM d, unnest(ws) AS t(word) GROUP BY ALL),
 bw AS (SELECT word, count(*) AS n FROM b, unnest(ws) AS t(word) GROUP BY ALL),
 c AS (SELECT word, {_CRC} % 10000 AS bucket FROM (SELECT word FROM dw UNION SELECT word FROM bw), remainder),
 s AS (SELECT bucket, sum(n) AS s FROM dw JOIN c USING (word) GROUP BY 1),
 t AS (SELECT bucket, sum(n) AS t FROM bw JOIN c USING (word) GROUP BY 1),
 gain AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)::DOUBLE
   / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)::DOUBLE))) AS BIGINT) AS g
   FROM s FULL JOIN t USING (bucket)),
 w AS (SELECT doc_id, sum(n * g) AS w FROM dw JOIN c USING (word) JOIN gain USING (bucket) GROUP BY 1),
 x AS (SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_features, CAST(coalesce(w, 0) AS BIGINT) AS weight,
   CAST('0x' || sha256('2024:' || d.doc_id)[1:8] AS BIGINT) AS h FROM d LEFT JOIN w ON d.doc_id = w.doc_id),
 y AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM x),
 z AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM y WHERE n_features >= 20)
 SELECT y.doc_id, n_features, weight, score, CASE WHEN r <= floor(10 * n / 100) THEN r END AS rank
 FROM y LEFT JOIN z ON y.doc_id = z.doc_id"""

_ORDERS = """orders AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM fs a, fs b, fs c, fs d, fs e
   WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
 steps AS (SELECT filter_order, step, filter_order[step] AS f, filter_order[1:step - 1] AS earlier
   FROM orders, unnest(range(1, 6)) AS t(step))"""

_OP13 = f"""WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, {_WORDS} AS ws FROM documents),
 l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS quality, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY 1),
 j AS (SELECT part, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic,
     CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END
     || CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END
     || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t) THEN 'C' ELSE '' END
     || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
     || CASE WHEN min(d.doc_id) OVER (PARTITION BY t) < d.doc_id THEN 'E' ELSE '' END AS failed
   FROM d LEFT JOIN l ON d.doc_id = l.doc_id),
 g AS (SELECT part, failed, quality, toxic, count(*) AS n FROM j GROUP BY ALL),
 fs AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f), {_ORDERS},
 x AS (SELECT part, filter_order, step, f, n, quality, toxic, failed = f AS alone, contains(failed, f) AS fails,
   translate(failed, earlier, '') <> failed AS before FROM g, steps)
 SELECT part, filter_order, CAST(step AS INT) AS step, CAST(coalesce(sum(n) FILTER (NOT fails AND NOT before), 0) AS BIGINT) AS kept,
   CAST(coalesce(sum(n) FILTER (fails AND NOT before), 0) AS BIGINT) AS removed,
   CAST(coalesce(sum(n) FILTER (fails AND before), 0) AS BIGINT) AS redundant,
   CAST(coalesce(sum(n) FILTER (alone), 0) AS BIGINT) AS unique_fails,
   CAST(coalesce(sum(n) FILTER (fails AND NOT before AND quality = 1), 0) AS BIGINT) AS good_lost,
   CAST(coalesce(sum(n) FILTER (fails AND NOT before AND toxic = 1), 0) AS BIGINT) AS toxic_lost,
   CAST(sum(coalesce(sum(n) FILTER (fails AND NOT before), 0)) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
 FROM x GROUP BY part, filter_order, step, f"""

SQL: dict[str, str] = {"op5_fm_index": _OP5, "op7_mixing": _OP7, "op8_quality": _OP8, "op12_importance": _OP12, "op13_filter_audit": _OP13}
