"""Text reports: a header line, a blank line and one line per event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlore.functions.text import minute_line, strip
from matchlore.operators.events import drop_repeats, short_form_allowed
from matchlore.operators.ordered import GROUP_LIMIT, OrderedGroups, largest_group
from matchlore.operators.rules import Rule, any_applies, render

# Fields an event dump shows in its own places.
HEADLINE_FIELDS = ("type", "team", "minute", "player1", "player2", "elapsed", "elapsed_plus")
NO_VALUE = "None"


def event_dump(kind: Column, minute: Column, team: Column, p1: Column, p2: Column, rest: Column) -> Column:
    """Headline, ``p1 => p2`` if there is a player, then the other fields.

    ``rest`` is an array of (name, value) structs; fields without value are left out.
    """

    def shown(value: Column) -> Column:
        return F.coalesce(value.cast("string"), F.lit(NO_VALUE))

    head = F.concat(
        F.lit("Event "), shown(kind), F.lit(" @ minute "),
        F.coalesce(minute.cast("string"), F.lit("0")),
        F.lit(" (team: "), shown(team), F.lit(")\n"),
    )
    players = F.when(
        p1.isNotNull() | p2.isNotNull(),
        F.concat(F.lit("\t"), shown(p1), F.lit(" => "), shown(p2), F.lit("\n")),
    ).otherwise("")
    filled = F.filter(rest, lambda field: field["value"].isNotNull())
    fields = F.array_join(
        F.transform(filled, lambda field: F.concat_ws(": ", field["name"], field["value"])), ", "
    )
    return F.concat(head, players, F.when(F.size(filled) > 0, F.concat(F.lit("\t"), fields)).otherwise(""))


def report_lines(
    events: DataFrame,
    rules: Sequence[Rule],
    seed: int,
    group: Sequence[str] = ("match_id",),
    order: Sequence[Column] = (),
    keys: Sequence[str] = ("match_id", "pos"),
    subject: str | None = None,
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Event rows to numbered lines (group, minute, line, line_no).

    Rules may use ``short_form`` when a subject column is given. A line equal to
    the one before is left out after rendering, as the carry-over state runs
    over all events.
    """
    order = list(order) or [F.col("pos")]
    # No later step has more rows per group than the events.
    largest = largest_group(events, group)
    if subject:
        events = short_form_allowed(events, group, order, subject, limit=limit, largest=largest)
    rendered = render(events.filter(any_applies(rules)), rules, keys, seed)
    lines = rendered.withColumn("line", minute_line(F.col("minute"), F.col("rule.body")))
    kept = drop_repeats(lines, group, order, "line", limit, largest)
    numbered = OrderedGroups(kept, group, order, limit, largest).number("line_no")
    return numbered.df.select(*group, "minute", "line", "line_no")


def with_header(lines: DataFrame, headers: DataFrame, key: str = "match_id") -> DataFrame:
    """Report lines (key, line_no, line) with the header as line -1 and a blank line as line 0.

    ``headers`` has (key, header). Matches without events keep their header.
    """
    top = headers.select(
        key,
        F.explode(
            F.array(
                F.struct(F.lit(-1).cast("bigint").alias("line_no"), strip(F.col("header")).alias("line")),
                F.struct(F.lit(0).cast("bigint").alias("line_no"), F.lit("").alias("line")),
            )
        ).alias("top"),
    ).select(key, "top.line_no", "top.line")
    return top.unionByName(lines.select(key, F.col("line_no").cast("bigint"), "line"))


def joined_lines(lines: DataFrame, key: str = "match_id", order: str = "line_no") -> DataFrame:
    """(key, context): the lines of a report as text, one row per report."""
    return (
        lines.groupBy(key)
        .agg(F.array_sort(F.collect_list(F.struct(order, "line"))).alias("lines"))
        .select(key, F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("context"))
    )


def unfinished(df: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key has no output yet."""
    return df.join(done.select(*keys).distinct(), list(keys), "left_anti")


def next_batch(df: DataFrame, done: DataFrame, key: str, size: int = 500) -> DataFrame:
    """The next ``size`` unfinished rows by key: one run of the report job."""
    return unfinished(df, done, [key]).orderBy(key).limit(size)
