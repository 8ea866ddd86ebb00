"""Answer spans: where in the context an answer stands.

Rows are question-answer pairs with their context. Results are rows
(keys, text, answer_start) with 0-based starts, and a reason for every pair
that has none. Nothing raises on a bad pair.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlore.functions.sampling import seed_hash
from matchlore.functions.text import last_word, position, unquote
from matchlore.operators.ordered import GROUP_LIMIT, OrderedGroups, largest_group

# A numeric answer is padded to this many choices from 0..100.
MIN_CHOICES = 5
MAX_DISTRACTOR = 100
NUMBER_MARK = "NUM"

_SPAN = "array<struct<text:string,answer_start:int>>"


def contained(pairs: DataFrame, answer: str = "answer", context: str = "context") -> DataFrame:
    """Pairs whose answer occurs in their context."""
    return pairs.filter(F.contains(F.col(context), F.col(answer)))


def _span(text: Column, found: Column) -> Column:
    """``found`` is a 1-based position, 0 if absent (giving -1)."""
    return F.struct(text.alias("text"), (found - 1).cast("int").alias("answer_start"))


def minute_start(context: Column, minute: Column) -> Column:
    """1-based position of the line of a minute, 0 if there is none (or it is the first line)."""
    line_end = position(F.concat(F.lit("\n"), minute.cast("string"), F.lit(": ")), context)
    # Past the line end, and 0 where there is none.
    return line_end + F.signum(line_end).cast("int")


def _minute_spans(answer: Column, onset: Column) -> Column:
    both = F.array(_span(answer, onset), _span(F.concat(answer, F.lit(":")), onset))
    return F.when((answer != "") & (onset > 0), both)


def _first_span(context: Column, answer: Column) -> Column:
    at = position(answer, context)
    return F.when((answer != "") & (at > 0), F.array(_span(answer, at)))


def _with_anchored(pairs: DataFrame, text: Column, query: Column) -> DataFrame:
    """Adds ``__anchored``: spans searched from the minute's line on, then the last
    word from there, then the answer anywhere.

    A player's name of several words found this way also gives its last word,
    with start -1 if that does not occur from the line on. Each step is a column
    of its own, so that no search is written out twice in the generated code.
    """
    clean, onset = F.col("clean_answer"), F.col("__onset")
    full, short, anywhere = F.col("__full"), F.col("__short"), F.col("__anywhere")
    is_player = F.contains(query, F.lit(":event/player")) & ~F.contains(query, F.lit(":event/team"))
    found, surname = F.col("__text"), F.col("__surname")
    one = F.array(_span(found, F.col("__at")))
    two = F.array(_span(found, F.col("__at")), _span(surname, position(surname, text, onset)))
    return (
        pairs.withColumn("__full", position(clean, text, onset))
        .withColumn("__short", position(last_word(clean), text, onset))
        .withColumn("__anywhere", position(clean, text))
        .withColumn(
            "__text",
            F.when(full > 0, clean).when(short > 0, last_word(clean)).when(anywhere > 0, clean),
        )
        .withColumn("__at", F.when(full > 0, full).when(short > 0, short).otherwise(anywhere))
        .withColumn("__surname", F.when(is_player & F.contains(found, F.lit(" ")), last_word(found)))
        .withColumn(
            "__anchored",
            F.when(
                (clean != "") & (onset > 0) & found.isNotNull(),
                F.when(surname.isNull(), one).otherwise(two),
            ),
        )
        .drop("__full", "__short", "__anywhere", "__text", "__at", "__surname")
    )


def with_spans(
    pairs: DataFrame,
    context: str = "context",
    answer: str = "answer",
    answertype: str = "answertype",
    minute: str | None = "minute",
    query: str = "datalog",
) -> DataFrame:
    """Adds ``clean_answer``, ``spans``, ``pieces`` and ``reason``. The context is not
    needed after this, so it need not travel with the rows.

    Numeric pairs get no spans here but the reason ``numeric``: their places are
    known once all of a document's are, see ``numeric_spans``. A text pair of
    which only the last word occurs gets the reason ``last_word``, see
    ``last_word_spans``. Every other pair without spans has the reason of its skip.
    """
    text, clean, onset, kind = F.col(context), F.col("clean_answer"), F.col("__onset"), F.col(answertype)
    at_minute = F.col(minute).cast("string") if minute else F.lit(None).cast("string")
    spans = F.when(kind == "minute", _minute_spans(clean, onset))
    if minute:
        anchored = (kind == "text") & at_minute.isNotNull()
        spans = spans.when(anchored, F.col("__anchored"))
    spans = spans.when(kind == "text", _first_span(text, clean))
    reason = (
        F.when(kind.isNull() | ~kind.isin("minute", "text", "numeric"), "unknown_answertype")
        .when(clean.isNull() | (clean == ""), "empty_answer")
        .when(kind == "numeric", F.when(clean.try_cast("bigint").isNull(), "no_number").otherwise("numeric"))
        .when(((kind == "minute") | at_minute.isNotNull()) & (onset == 0), "minute_not_found")
        .when(
            at_minute.isNull() & (last_word(clean) != "") & F.contains(text, last_word(clean)), "last_word"
        )
        .otherwise("answer_not_found")
    )
    sought = F.when(kind == "minute", clean).otherwise(at_minute)
    located = pairs.withColumn("clean_answer", unquote(F.col(answer))).withColumn(
        "__onset", F.coalesce(minute_start(text, sought), F.lit(0))
    )
    if minute:
        located = _with_anchored(located, text, F.col(query))
    return (
        located.withColumn("spans", spans)
        .withColumn("reason", F.when(F.col("spans").isNull(), reason))
        .withColumn(
            "pieces",
            F.when(F.col("reason") == "last_word", occurrence_pieces(text, last_word(clean))),
        )
        .drop("__onset", "__anchored")
    )


def span_rows(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, no, text, answer_start) of the pairs that have spans.

    The outer form: the plain one makes Spark repeat all searches in a filter.
    """
    exploded = pairs.select(*keys, F.posexplode_outer("spans").alias("no", "span"))
    return exploded.filter(F.col("span").isNotNull()).select(*keys, "no", "span.*")


def occurrence_pieces(context: Column, needle: Column) -> Column:
    """STRUCT<lengths, at_start>: the lengths of the pieces of a text cut in front of
    each occurrence, overlapping ones included, and whether it begins with one.

    Starts are running sums of the lengths. That stays linear in the text where
    probing each position would not.
    """
    quoted = F.replace(needle, F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
    before_each = F.concat(F.lit("(?s)(?=\\Q"), quoted, F.lit("\\E)"))
    lengths = F.transform(F.split(context, before_each), lambda piece: F.length(piece))
    return F.when(
        (needle != "") & F.contains(context, needle),
        F.struct(lengths.alias("lengths"), context.startswith(needle).alias("at_start")),
    )


def occurrence_rows(pairs: DataFrame, keys: Sequence[str], text: str, pieces: str) -> DataFrame:
    """(keys, text, answer_start) per occurrence. ``keys`` is unique, so a window holds
    the pieces of one row."""
    exploded = pairs.select(
        *keys,
        F.col(text).alias("text"),
        F.col(f"{pieces}.at_start").alias("__at_start"),
        F.posexplode_outer(f"{pieces}.lengths").alias("__no", "__length"),
    ).filter(F.col("__no").isNotNull())
    in_row = Window.partitionBy(*keys).orderBy("__no")
    start = F.sum("__length").over(in_row) - F.col("__length")
    return (
        exploded.withColumn("answer_start", start.cast("int"))
        .filter((F.col("__no") > 0) | F.col("__at_start"))
        .select(*keys, "text", "answer_start")
    )


def every_occurrence(
    pairs: DataFrame, keys: Sequence[str], needle: Column, context: str = "context"
) -> DataFrame:
    """(keys, text, answer_start) for every occurrence of ``needle`` in the context."""
    cut = pairs.withColumn("__needle", needle).withColumn(
        "__pieces", occurrence_pieces(F.col(context), F.col("__needle"))
    )
    return occurrence_rows(cut, keys, "__needle", "__pieces")


def last_word_spans(located: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every occurrence of the answer's last word, for the pairs ``with_spans`` left to this."""
    left = located.filter(F.col("pieces").isNotNull()).withColumn(
        "__word", last_word(F.col("clean_answer"))
    )
    return occurrence_rows(left, keys, "__word", "pieces")


def numeric_choices(
    numeric: DataFrame,
    doc_key: str,
    seed: int,
    value: str = "value",
    limit: int = GROUP_LIMIT,
    largest: int | None = None,
) -> DataFrame:
    """The choices appended to a document: (doc_key, value, copies, is_answer, offset).

    Equal answers are kept as copies. Documents with fewer than five answers get
    distractors from 0..100 that are no answers. ``offset`` is the 0-based place
    of the number in the line of ``NUM`` marks, counted from the line's start.
    """
    counted = numeric.groupBy(doc_key, F.col(value).cast("bigint").alias("value")).agg(
        F.count(F.lit(1)).alias("copies")
    )
    totals = counted.groupBy(doc_key).agg(F.sum("copies").alias("answers"))
    few = totals.filter(F.col("answers") < MIN_CHOICES)
    # At most four answers each, so the collected sets are small.
    known = counted.join(few, doc_key).groupBy(doc_key, "answers").agg(
        F.collect_set("value").alias("known")
    )
    candidates = F.sequence(F.lit(0).cast("bigint"), F.lit(MAX_DISTRACTOR).cast("bigint"))
    free = F.array_except(candidates, F.col("known"))
    shuffled = F.array_sort(
        F.transform(
            free,
            lambda number: F.struct(
                seed_hash(seed, F.col(doc_key), number).alias("draw"), number.alias("value")
            ),
        )
    )
    missing = (F.lit(MIN_CHOICES) - F.col("answers")).cast("int")
    # The outer form: the plain one makes Spark draw once more to filter by size.
    padding = known.select(
        doc_key, F.explode_outer(F.slice(shuffled, 1, missing)).alias("drawn")
    ).select(
        doc_key, "drawn.value", F.lit(1).cast("bigint").alias("copies"), F.lit(False).alias("is_answer")
    )
    if largest is None:
        largest = largest_group(counted, [doc_key]) + MIN_CHOICES
    choices = counted.withColumn("is_answer", F.lit(True)).unionByName(padding)
    width = F.length(F.concat(F.lit(NUMBER_MARK), F.col("value").cast("string"))) + 1
    summed = OrderedGroups(choices, [doc_key], [F.col("value")], limit, largest).running_sum(
        F.col("copies") * width, "__end"
    ).df
    offset = F.col("__end") - F.col("copies") * width + len(NUMBER_MARK)
    return summed.withColumn("offset", offset.cast("bigint")).drop("__end")


def choice_line(choices: DataFrame, doc_key: str) -> DataFrame:
    """(doc_key, numbers): the ``NUM`` marks of a document in ascending order."""
    mark = F.concat(F.lit(NUMBER_MARK), F.col("value").cast("string"))
    marks = F.array_join(F.array_repeat(mark, F.col("copies").cast("int")), " ")
    return (
        choices.withColumn("marks", marks)
        .groupBy(doc_key)
        .agg(F.array_sort(F.collect_list(F.struct("offset", "marks"))).alias("line"))
        .select(doc_key, F.array_join(F.transform("line", lambda piece: piece["marks"]), " ").alias("numbers"))
    )


def numeric_spans(
    numeric: DataFrame, choices: DataFrame, doc_key: str, value: str = "value", length: str = "context_length"
) -> DataFrame:
    """Adds ``answer_start``: behind the context, a blank line and the ``NUM`` mark."""
    found = choices.filter("is_answer").select(
        doc_key, F.col("value").alias("__value"), "offset"
    )
    keyed = numeric.withColumn("__value", F.col(value).cast("bigint"))
    return keyed.join(found, [doc_key, "__value"]).withColumn(
        "answer_start", (F.col(length) + 2 + F.col("offset")).cast("bigint")
    ).drop("__value", "offset")
