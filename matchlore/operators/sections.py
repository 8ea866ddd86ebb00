"""Line logs: sections of a text and records of a trace."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlore.functions.text import strip
from matchlore.operators.ordered import GROUP_LIMIT, OrderedGroups, largest_group

# Marks of section heads, comments and trace lines.
SECTION_MARK = ";;# "
COMMENT_MARK = ";; "
DEFAULT_SECTION = "data"
_STRICT = {"mode": "FAILFAST"}
TRACE_MARKS = {"query": "IM_QUERY:", "args": "IM_ARGS:", "result": "IM_RESULT:"}


def numbered_lines(texts: DataFrame, key: str, text: str, keep_blank: bool = True) -> DataFrame:
    """(key, line_no, line): the stripped lines of a text, counted from 0 before blanks go."""
    exploded = texts.select(key, F.posexplode_outer(F.split(F.col(text), "\n")).alias("line_no", "line"))
    clean = exploded.filter(F.col("line_no").isNotNull()).withColumn("line", strip(F.col("line")))
    return clean if keep_blank else clean.filter(F.col("line") != "")


def most_lines(texts: DataFrame, text: str) -> int:
    """Lines of the longest text: its line feeds are counted, nothing is split or shuffled."""
    feeds = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    return (texts.agg(F.max(feeds).alias("feeds")).first()["feeds"] or 0) + 1


def labelled_lines(
    lines: DataFrame,
    key: str,
    order: str = "line_no",
    limit: int = GROUP_LIMIT,
    largest: int | None = None,
) -> DataFrame:
    """(key, line_no, section, line) without section heads and comments.

    ``largest`` is a bound on the lines of a text, see :func:`most_lines`.
    """
    if largest is None:
        largest = largest_group(lines, [key])
    low = strip(F.lower("line"))
    head = F.when(low.startswith(SECTION_MARK), F.substring(low, len(SECTION_MARK) + 1, 1 << 30))
    marked = F.when(head.isNotNull(), F.struct(F.col(order), head.alias("name")))
    labelled = OrderedGroups(lines, [key], [F.col(order)], limit, largest).running_max(marked, "__head").df
    comment = strip(F.col("line")).startswith(COMMENT_MARK)
    return labelled.filter(head.isNull() & ~comment).select(
        key, order, F.coalesce("__head.name", F.lit(DEFAULT_SECTION)).alias("section"), "line"
    )


def section_texts(labelled: DataFrame, key: str, order: str = "line_no") -> DataFrame:
    """(key, section, text): lines of one section put together, in order.

    A section is not longer than the text it comes from, which is one row.
    """
    return (
        labelled.groupBy(key, "section")
        .agg(F.array_sort(F.collect_list(F.struct(order, "line"))).alias("lines"))
        .select(
            key,
            "section",
            strip(F.array_join(F.transform("lines", lambda x: x["line"]), "\n")).alias("text"),
        )
    )


def trace_records(
    lines: DataFrame, key: str, order: Sequence[str] = ("line_no",), limit: int = GROUP_LIMIT
) -> DataFrame:
    """(key, record, query, args, result): trace lines as records.

    A record begins at each query line; of several values the last one counts.
    Lines before the first query and unmarked lines are no part of any record.
    """
    line = strip(F.col("line"))
    is_query = line.startswith(TRACE_MARKS["query"])
    relevant = lines.filter(line.startswith("IM_"))
    numbered = OrderedGroups(relevant, [key], [F.col(c) for c in order], limit).running_sum(
        is_query.cast("bigint"), "record"
    ).df.filter(F.col("record") > 0)

    def last(mark: str) -> Column:
        value = F.when(line.startswith(mark), F.substring(line, len(mark) + 1, 1 << 30))
        at = F.when(value.isNotNull(), F.struct(*order))
        return F.max_by(value, at)

    values = numbered.groupBy(key, "record").agg(
        *[last(mark).alias(name) for name, mark in TRACE_MARKS.items()]
    )
    return values.select(
        key,
        "record",
        F.from_json(F.concat(F.lit('{"v":'), F.col("query"), F.lit("}")), "v STRING", _STRICT)["v"].alias("query"),
        F.from_json("args", "ARRAY<STRING>", _STRICT).alias("args"),
        "result",
    )
