"""Questions: gate, selection, answers for all matches at once, and negatives."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlore.functions.sampling import hash_number, seed_hash
from matchlore.functions.text import count_filled_lines
from matchlore.operators.ordered import GROUP_LIMIT, OrderedGroups, first_in_group

# Fixed values of question generation.
MIN_LINES = 50
MATCH_ATTEMPTS = 20
MAX_GENERATED = 50
NEGATIVE_SHARE = 4
# The weight of a match in a draw, shared out among its questions; 2**33 matches fit a BIGINT.
MATCH_SHARE = 1 << 30


def long_enough(
    documents: DataFrame, key: str, text: str = "text", min_lines: int = MIN_LINES
) -> DataFrame:
    """Keys of texts with at least ``min_lines`` lines that are not blank."""
    return documents.filter(count_filled_lines(F.col(text)) >= min_lines).select(key)


def gated(
    matches: DataFrame, key: str, *documents: tuple[DataFrame, str], min_lines: int = MIN_LINES
) -> DataFrame:
    """Matches whose text is long enough in each (documents, text column)."""
    for table, text in documents:
        matches = matches.join(long_enough(table, key, text, min_lines), key, "left_semi")
    return matches


def drop_empty_answers(questions: DataFrame) -> DataFrame:
    """Event questions need an answer; match questions stay either way."""
    return questions.filter((F.col("level") == "match") | (F.trim("answer") != ""))


def one_per_rule(
    questions: DataFrame, order: Sequence[str], keys: Sequence[str] = ("match_id", "rule")
) -> DataFrame:
    """The first question of every (match, rule)."""
    return first_in_group(questions, keys, order)


def event_question_cap(
    max_generated: int = MAX_GENERATED, match_attempts: int = MATCH_ATTEMPTS
) -> int:
    """Event questions a match may have: generation stops once the limit is passed,
    and every match-level attempt counts, repeats included."""
    return max(max_generated + 1 - match_attempts, 0)


def capped(
    questions: DataFrame, order: Sequence[str], cap: int | None = None, key: str = "match_id"
) -> DataFrame:
    """At most ``cap`` questions per match.

    A constant bound on ``row_number`` lets every task keep that many rows per
    match before the shuffle.
    """
    window = Window.partitionBy(key).orderBy(*order)
    limit = event_question_cap() if cap is None else cap
    return (
        questions.withColumn("__no", F.row_number().over(window))
        .filter(F.col("__no") <= limit)
        .drop("__no")
    )


def answer_from(questions: DataFrame, answers: DataFrame, on: Sequence[str]) -> DataFrame:
    """Adds ``answer`` by an equi-join on match and query parameters; empty where none is found.

    ``answers`` holds the results of one rule family over all matches and is
    unique on the join columns.
    """
    found = answers.select(*on, F.col("answer").alias("__answer"))
    return questions.join(found, list(on), "left").withColumn(
        "answer", F.coalesce("__answer", F.lit(""))
    ).drop("__answer")


def category_named(category: Column) -> Column:
    """``-`` becomes Simple; a missing category stays missing."""
    return F.when(category == "-", "Simple").otherwise(category)


def unanswered(candidates: DataFrame, answers: DataFrame, on: Sequence[str]) -> DataFrame:
    """Candidates whose query has no result on the match they are put to."""
    return candidates.join(answers.select(*on).distinct(), list(on), "left_anti")


def negatives_wanted(questions: Column) -> Column:
    return F.floor(questions / NEGATIVE_SHARE).cast("bigint") + 1


def _starts(counts: DataFrame, key: str, seed: int, digits: int = 3) -> DataFrame:
    """Adds ``start`` and ``total`` to (key, questions): running totals over the
    seeded order of the keys, taken per hash bucket and then inside it. There
    are 16**digits buckets at most, hence the broadcast."""
    hashed = counts.withColumn("__hash", seed_hash(seed, F.col(key)))
    hashed = hashed.withColumn("__bucket", F.substring("__hash", 1, digits))
    buckets = Window.orderBy("__bucket")
    totals = (
        hashed.groupBy("__bucket")
        .agg(F.sum("questions").alias("__n"))
        .select(
            "__bucket",
            (F.sum("__n").over(buckets) - F.col("__n")).alias("__before"),
            F.sum("__n").over(Window.partitionBy()).alias("total"),
        )
    )
    inside = Window.partitionBy("__bucket").orderBy("__hash", key)
    before = F.sum("questions").over(inside) - F.col("questions")
    return (
        hashed.join(F.broadcast(totals), "__bucket")
        .withColumn("start", F.col("__before") + before)
        .drop("__bucket", "__before", "__hash")
    )


def _numbered(
    questions: DataFrame, group: str, question_key: str, seed: int, limit: int, largest: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """All questions numbered so that those of a group are consecutive.

    Returns the groups (group, questions, start, total) and the questions with
    ``within`` (number in the group) and ``question_no``.
    """
    counts = questions.groupBy(group).agg(F.count(F.lit(1)).alias("questions"))
    groups = _starts(counts, group, seed)
    within = OrderedGroups(questions, [group], [F.col(question_key)], limit, largest).number(
        "within", start=0
    ).df
    numbered = within.join(groups.select(group, "start"), group)
    return groups, numbered.withColumn("question_no", F.col("start") + F.col("within")).drop("start")


@dataclass(frozen=True)
class GroupSizes:
    """Rows in all and in the largest group."""

    rows: int
    largest: int


def _group_sizes(**tables: tuple[DataFrame, str]) -> dict[str, GroupSizes]:
    """Sizes of several tables by a column each, counted in one pass over all of them."""
    groups = [
        table.select(F.lit(name).alias("name"), F.col(key).cast("string").alias("group"))
        for name, (table, key) in tables.items()
    ]
    counted = reduce(DataFrame.union, groups).groupBy("name", "group").agg(F.count(F.lit(1)).alias("n"))
    rows = counted.groupBy("name").agg(F.sum("n").alias("n"), F.max("n").alias("m")).collect()
    sizes = {row["name"]: GroupSizes(row["n"], row["m"]) for row in rows}
    return {name: sizes.get(name, GroupSizes(0, 0)) for name in tables}


def shortfall(questions: DataFrame, drawn: DataFrame, key: str) -> DataFrame:
    """(key, wanted, missing) of the matches that got fewer negatives than wanted."""
    wanted = questions.groupBy(key).agg(negatives_wanted(F.count(F.lit(1))).alias("wanted"))
    got = drawn.groupBy(key).agg(F.count(F.lit(1)).alias("got"))
    missing = F.col("wanted") - F.coalesce("got", F.lit(0))
    return wanted.join(got, key, "left").select(key, "wanted", missing.alias("missing")).filter("missing > 0")


def _slots(counts: DataFrame, numbered: DataFrame, key: str) -> DataFrame:
    """(key, slot) for the n div 4 + 1 negatives of a match with n questions.

    Every fourth question stands for a slot, and one more where n is a multiple
    of four: rows that exist already, so no long array is built for any match.
    """
    each = numbered.filter(F.col("within") % NEGATIVE_SHARE == 0).select(
        key, F.floor(F.col("within") / NEGATIVE_SHARE).alias("slot")
    )
    last = counts.filter(F.col("questions") % NEGATIVE_SHARE == 0).select(
        key, F.floor(F.col("questions") / NEGATIVE_SHARE).alias("slot")
    )
    return each.unionByName(last)


def _draw(seed: int, key: str, size: Column) -> Column:
    return F.pmod(hash_number(seed_hash(seed, F.col(key), F.col("slot"))), size)


def other_match_questions(
    questions: DataFrame, key: str, question_key: str, seed: int, limit: int = GROUP_LIMIT
) -> DataFrame:
    """For each slot of a match one question of another match: (key, slot, question_key).

    The questions of a match have consecutive numbers; a draw skips that range,
    so none of the match's own is drawn and no pairs are formed.
    """
    narrow = questions.select(key, question_key)
    groups, numbered = _numbered(narrow, key, question_key, seed, limit)
    others = F.col("total") - F.col("questions")
    skip = F.when(F.col("draw") >= F.col("start"), F.col("questions")).otherwise(F.lit(0))
    drawn = (
        _slots(groups, numbered, key)
        .join(groups.filter(others > 0), key)
        .withColumn("draw", _draw(seed, key, others))
        .select(key, "slot", (F.col("draw") + skip).alias("question_no"))
    )
    return drawn.join(numbered.select("question_no", question_key), "question_no").drop(
        "question_no"
    )


def _blocked(results: DataFrame, ranges: DataFrame, numbered: DataFrame, key: str, query: str) -> DataFrame:
    """(key, start, questions): the numbers a match may not be asked, as ranges that do not overlap.

    The range of every query with a result on the match (``questions`` numbers from ``start``), and ``width`` numbers from
    ``question_no`` for each question of its own besides.
    """
    own = numbered.join(results, [key, query], "left_anti")
    return results.join(ranges, query).select(key, "start", "questions").unionByName(
        own.select(key, F.col("question_no").alias("start"), F.col("width").alias("questions"))
    )


def _past_blocked(blocked: DataFrame, draws: DataFrame, key: str, limit: int, largest: int) -> DataFrame:
    """``draws`` (key, slot, at) among the numbers that are left over, as numbers among all."""
    # Where a blocked range lies among the numbers that are left over.
    summed = OrderedGroups(blocked, [key], [F.col("start")], limit, largest).running_sum(
        F.col("questions"), "shift"
    ).df
    placed = summed.select(
        key,
        F.lit(0).alias("is_draw"),
        (F.col("start") - F.col("shift") + F.col("questions")).alias("at"),
        "shift",
        F.lit(None).cast("bigint").alias("slot"),
    )
    named = draws.select(
        key, F.lit(1).alias("is_draw"), "at", F.lit(None).cast("bigint").alias("shift"), "slot"
    )
    order = [F.col(column) for column in ("at", "is_draw", "shift", "slot")]
    moved = OrderedGroups(placed.unionByName(named), [key], order, limit, largest).running_max(
        F.col("shift"), "shift"
    ).df
    return moved.filter(F.col("is_draw") == 1).select(
        key, "slot", (F.col("at") + F.coalesce("shift", F.lit(0))).alias("at")
    )


def negatives(
    questions: DataFrame,
    answered: DataFrame,
    key: str,
    question_key: str,
    query: str,
    seed: int,
    allow_repeats: bool = False,
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Unanswerable questions for every match: (key, slot, question_key, query).

    A match with n questions gets n div 4 + 1 questions of other matches whose
    query has no result on it; ``answered`` lists (key, query) with a result.

    Drawing again until a query comes up empty is done in one step. Questions
    are numbered by query, so what a match may not be asked is a set of number
    ranges: one per answered query, and one per question of its own besides. A
    draw among the remaining numbers is moved past the ranges below it. Without
    repeats the remaining numbers are cut into as many stretches as there are
    slots, one draw each. A match gets fewer negatives only where fewer exist.
    """
    asked = questions.select(key, question_key, query)
    # A question without a query cannot be put to another match, but counts for its own.
    narrow = asked.filter(F.col(query).isNotNull())
    results = answered.select(key, query).filter(F.col(query).isNotNull()).distinct()
    # Sizes are checked once; those of the later steps follow from them.
    sizes = _group_sizes(asked=(asked, key), queries=(narrow, query), results=(results, key))
    most_questions, total = sizes["asked"].largest, sizes["queries"].rows
    most_blocked = sizes["results"].largest + most_questions
    ranges, numbered = _numbered(narrow, query, question_key, seed, limit, sizes["queries"].largest)
    blocked = _blocked(results, ranges, numbered.withColumn("width", F.lit(1).cast("bigint")), key, query)
    counts = questions.groupBy(key).agg(F.count(F.lit(1)).alias("questions"))
    within = OrderedGroups(asked, [key], [F.col(question_key)], limit, most_questions).number(
        "within", start=0
    ).df
    gone = blocked.groupBy(key).agg(F.sum("questions").alias("gone"))
    free = counts.join(gone, key, "left").select(
        key,
        (F.lit(total) - F.coalesce("gone", F.lit(0))).alias("free"),
        negatives_wanted(F.col("questions")).alias("wanted"),
    )
    slots = _slots(counts, within, key).join(free.filter(F.col("free") > 0), key)
    if allow_repeats:
        at = _draw(seed, key, F.col("free"))
    else:
        slots = slots.withColumn("wanted", F.least("wanted", "free")).filter("slot < wanted")
        width, longer = F.expr("free div wanted"), F.expr("free % wanted")
        low = F.col("slot") * width + F.least(F.col("slot"), longer)
        size = width + F.when(F.col("slot") < longer, F.lit(1)).otherwise(F.lit(0))
        at = low + _draw(seed, key, size)
    drawn = _past_blocked(blocked, slots.select(key, "slot", at.alias("at")), key, limit, most_blocked + most_questions)
    drawn = drawn.withColumnRenamed("at", "question_no")
    return drawn.join(numbered.select("question_no", question_key, query), "question_no").drop(
        "question_no"
    )


def negatives_by_match(
    questions: DataFrame,
    answered: DataFrame,
    key: str,
    question_key: str,
    query: str,
    seed: int,
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Like ``negatives`` with repeats, but a draw takes another match first and then one of its questions.

    So a match is drawn as often as another whatever its number of questions, and every draw that hits a
    question with a result on the asked match is repeated from the start. In one step: a question has the
    share of its match divided by the number of the match's questions as its weight, and the draw is one among the weights
    that are not blocked, moved past the blocked ones below it. Weights are whole numbers, ``MATCH_SHARE`` div n.
    """
    counts = questions.groupBy(key).agg(F.count(F.lit(1)).alias("questions"))
    asked = questions.select(key, question_key, query)
    # A question without a query cannot be put to another match, but counts for its own.
    narrow = asked.filter(F.col(query).isNotNull()).join(
        counts.select(key, F.expr(f"{MATCH_SHARE} div questions").alias("width")), key
    )
    results = answered.select(key, query).filter(F.col(query).isNotNull()).distinct()
    sizes = _group_sizes(asked=(asked, key), queries=(asked.filter(F.col(query).isNotNull()), query), results=(results, key))
    most = sizes["results"].largest + 2 * sizes["asked"].largest

    ranges = _starts(narrow.groupBy(query).agg(F.sum("width").alias("questions")), query, seed)
    summed = OrderedGroups(narrow, [query], [F.col(question_key), F.col(key)], limit, sizes["queries"].largest).running_sum(
        F.col("width"), "upto"
    ).df
    numbered = summed.join(ranges.select(query, "start"), query).select(
        key, question_key, query, "width", (F.col("start") + F.col("upto") - F.col("width")).alias("question_no")
    )
    blocked = _blocked(results, ranges, numbered, key, query)
    gone = blocked.groupBy(key).agg(F.sum("questions").alias("gone"))
    everything = narrow.agg(F.coalesce(F.sum("width"), F.lit(0)).alias("all")).first()["all"]
    free = counts.join(gone, key, "left").select(key, (F.lit(everything) - F.coalesce("gone", F.lit(0))).alias("free"))
    within = OrderedGroups(asked, [key], [F.col(question_key)], limit, sizes["asked"].largest).number("within", start=0).df
    slots = _slots(counts, within, key).join(free.filter(F.col("free") > 0), key)
    draws = slots.select(key, "slot", _draw(seed, key, F.col("free")).alias("at"))
    drawn = _past_blocked(blocked, draws, key, limit, most)

    # A draw and the question whose weight it falls into meet in a cell of the number line; a question lies in a few of them.
    cell = MATCH_SHARE // 16
    first, last = F.expr(f"question_no div {cell}"), F.expr(f"(question_no + width - 1) div {cell}")
    lying = numbered.select(question_key, query, "question_no", "width", F.explode(F.sequence(first, last)).alias("cell"))
    hit = (F.col("at") >= F.col("question_no")) & (F.col("at") < F.col("question_no") + F.col("width"))
    return drawn.withColumn("cell", F.expr(f"at div {cell}")).join(lying, "cell").filter(hit).select(
        key, "slot", question_key, query
    )


def as_negatives(drawn: DataFrame) -> DataFrame:
    """Drawn questions as question records without an answer."""
    return drawn.withColumn("unanswerable", F.lit(True)).withColumn("answer", F.lit(""))


def with_negatives(questions: DataFrame, drawn: DataFrame) -> DataFrame:
    """Answerable questions and negatives in one table, categories named."""
    both = questions.unionByName(as_negatives(drawn), allowMissingColumns=True)
    return both.withColumn("category", category_named(F.col("category"))).withColumn(
        "unanswerable", F.coalesce("unanswerable", F.lit(False))
    )
