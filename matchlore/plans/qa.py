"""From events and texts to questions, answers, negatives and the split dataset."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlore.functions.sampling import seed_hash
from matchlore.functions.text import strip
from matchlore.operators import export, questions, spans
from matchlore.operators.ordered import largest_group
from matchlore.operators.reports import unfinished
from matchlore.operators.rules import Rule, any_applies, for_target, render, variant, with_text
from matchlore.session import kept_table, reliable

# Rules of our own, one per family. A text rule words the question; its partner
# under the same id spells the query: the family and the values it asks for.
EVENT_RULES = (
    Rule("questions", "text", "Q_E_WHO", "player1.name IS NOT NULL",
         "concat('Which player had a ', event_kind, ' in minute ', minute, '?', chr(10), "
         "'Whose ', event_kind, ' was it in minute ', minute, '?')", "Player", "text"),
    Rule("questions", "datalog", "Q_E_WHO", "true",
         "concat_ws('|', ':event/player', event_kind, minute, team)"),
    Rule("questions", "text", "Q_E_WHEN", "player1.name IS NOT NULL",
         "concat('In which minute did ', player1.name, ' have a ', event_kind, '?')", "-", "minute"),
    Rule("questions", "datalog", "Q_E_WHEN", "true",
         "concat_ws('|', ':event/minute', event_kind, player1.name)"),
    Rule("questions", "text", "Q_E_MANY", "true",
         "concat('How many times was there a ', event_kind, ' by the ', team, ' team?')", "Count", "numeric"),
    Rule("questions", "datalog", "Q_E_MANY", "true", "concat_ws('|', 'count', event_kind, team)"),
)
MATCH_RULES = (
    Rule("questions", "text", "Q_A_1", "true", "concat('Who plays at home against ', awayteam, '?')",
         "-", "text"),
    Rule("questions", "datalog", "Q_A_1", "true", "concat_ws('|', 'home', awayteam)"),
    Rule("questions", "text", "Q_A_2", "true", "'How many events are there?'", "Count", "numeric"),
    Rule("questions", "datalog", "Q_A_2", "true", "'count'"),
)


def check_partners(rules: Sequence[Rule]) -> None:
    """Every rule that words a question needs a partner that spells its query."""
    missing = {rule.rule_id for rule in for_target(rules, "text")} - {
        rule.rule_id for rule in for_target(rules, "datalog")
    }
    if missing:
        raise ValueError(f"no query rule with the id of {sorted(missing)}")


def _query(rules: Sequence[Rule]) -> Column:
    """The query of the partner of the chosen rule."""
    query = F.lit(None).cast("string")
    for rule in for_target(rules, "datalog"):
        query = F.when(F.col("rule.rule_id") == rule.rule_id, F.expr(rule.body)).otherwise(query)
    return query


def _asked(df: DataFrame, rules: Sequence[Rule], keys: Sequence[str], seed: int) -> DataFrame:
    check_partners(rules)
    asking = for_target(rules, "text")
    chosen = with_text(render(df.filter(any_applies(asking)), asking, keys, seed), "__text")
    return chosen.select(
        *keys,
        F.col("rule.rule_id").alias("rule"),
        F.col("rule.category").alias("category"),
        F.col("rule.answertype").alias("answertype"),
        variant(F.col("__text"), seed, *[F.col(key) for key in keys]).alias("question"),
        _query(rules).alias("datalog"),
    )


def ask_events(events: DataFrame, seed: int, rules: Sequence[Rule] = EVENT_RULES) -> DataFrame:
    """One drawn question per event, in seeded order."""
    asked = _asked(events, rules, ["match_id", "pos"], seed)
    return asked.withColumn("draw", seed_hash(seed, F.col("match_id"), F.col("pos"))).withColumn(
        "level", F.lit("event")
    )


def ask_matches(matches: DataFrame, seed: int, rules: Sequence[Rule] = MATCH_RULES) -> DataFrame:
    """Match-level attempts: each draws a rule; the first of every rule stays."""
    numbers = F.sequence(F.lit(1).cast("bigint"), F.lit(questions.MATCH_ATTEMPTS).cast("bigint"))
    attempts = matches.withColumn("pos", F.explode(numbers))
    asked = _asked(attempts, rules, ["match_id", "pos"], seed)
    return asked.withColumn("draw", F.lpad(F.col("pos").cast("string"), 4, "0")).withColumn(
        "level", F.lit("match")
    )


def answers(matches: DataFrame, events: DataFrame) -> DataFrame:
    """Results of all rule families on all matches: (match_id, query, answer)."""
    joined = F.concat_ws

    def first(query: Column, answer: Column) -> DataFrame:
        rows = events.select(
            "match_id", "pos", query.alias("query"), answer.cast("string").alias("answer")
        ).filter(F.col("answer").isNotNull())
        return rows.groupBy("match_id", "query").agg(F.min_by("answer", "pos").alias("answer"))

    def counted(query: Column) -> DataFrame:
        return events.groupBy("match_id", query.alias("query")).agg(
            F.count(F.lit(1)).cast("string").alias("answer")
        )

    player = F.col("player1.name")
    return (
        first(joined("|", F.lit(":event/player"), "event_kind", F.col("minute").cast("string"), "team"), player)
        .unionByName(first(joined("|", F.lit(":event/minute"), "event_kind", player), F.col("minute")))
        .unionByName(counted(joined("|", F.lit("count"), "event_kind", "team")))
        .unionByName(counted(F.lit("count")))
        .unionByName(
            matches.select(
                "match_id", joined("|", F.lit("home"), "awayteam").alias("query"),
                F.col("hometeam").alias("answer"),
            )
        )
    )


def chosen_matches(
    matches: DataFrame,
    reports: DataFrame | None = None,
    fact_texts: DataFrame | None = None,
    done: DataFrame | None = None,
    min_lines: int = questions.MIN_LINES,
) -> DataFrame:
    """Matches whose report (``context``) and facts (``text``) exist and are long enough, and that are not done."""
    given = [(t, c) for t, c in ((reports, "context"), (fact_texts, "text")) if t is not None]
    chosen = questions.gated(matches, "match_id", *given, min_lines=min_lines)
    return chosen if done is None else unfinished(chosen, done, ["match_id"])


def question_set(
    matches: DataFrame,
    events: DataFrame,
    seed: int,
    reports: DataFrame | None = None,
    fact_texts: DataFrame | None = None,
    done: DataFrame | None = None,
    event_rules: Sequence[Rule] = EVENT_RULES,
    match_rules: Sequence[Rule] = MATCH_RULES,
    min_lines: int = questions.MIN_LINES,
) -> DataFrame:
    """Selected, answered questions of all matches, with negatives.

    (match_id, question_key, level, rule, category, question, datalog, answer,
    answertype, unanswerable). With ``reports`` and ``fact_texts`` only matches whose texts are
    long enough are asked; ``done`` lists those that have questions already. A rule
    asks once per match, on whichever level it comes first.
    """
    asked_of = chosen_matches(matches, reports, fact_texts, done, min_lines)
    if reports is not None or fact_texts is not None or done is not None:
        # Which matches are asked takes all their texts, so it is worked out once; their events are read many times below.
        asked_of = kept_table(asked_of, "question-matches")
        events = kept_table(events.join(asked_of.select("match_id"), "match_id", "left_semi"), "question-events")
    # The results are read several times below, so they are worked out once and kept.
    results = reliable(answers(asked_of, events).withColumnRenamed("query", "datalog"))
    on = ["match_id", "datalog"]
    by_match = questions.one_per_rule(ask_matches(asked_of, seed, match_rules), ["draw", "pos"])
    by_match = questions.answer_from(by_match, results, on)
    by_event = questions.drop_empty_answers(
        questions.answer_from(ask_events(events, seed, event_rules), results, on)
    )
    by_event = questions.one_per_rule(by_event, ["draw", "pos"])
    by_event = by_event.join(by_match.select("match_id", "rule"), ["match_id", "rule"], "left_anti")
    by_event = questions.capped(by_event, ["draw", "pos"])
    asked = by_match.unionByName(by_event.select(*by_match.columns)).drop("draw")
    asked = reliable(
        asked.withColumn("question_key", F.concat_ws("_", "match_id", "level", "rule"))
    )
    drawn = questions.negatives(asked, results, "match_id", "question_key", "datalog", seed)
    wording = asked.select("question_key", "rule", "category", "question", "answertype")
    # A drawn question is asked once more under a key of its own.
    negatives = drawn.join(wording, "question_key").withColumn(
        "question_key", F.concat_ws("_", F.lit("n"), "match_id", "slot")
    )
    return questions.with_negatives(
        asked.drop("pos"), negatives.drop("slot").withColumn("level", F.lit("drawn"))
    )


@dataclass(frozen=True)
class Dataset:
    """``documents``: nested rows with their split. ``statuses``: (question_key, match_id,
    split, status) per question, where status is added or the reason of a skip."""

    documents: DataFrame
    statuses: DataFrame

    def counts(self) -> DataFrame:
        return export.export_counts(self.statuses)


def dataset(
    asked: DataFrame, contexts: DataFrame, fact_texts: DataFrame, seed: int, minute: str | None = None
) -> Dataset:
    """Questions with their texts to located answers and nested documents.

    ``contexts`` (match_id, context) and ``fact_texts`` (match_id, datalog) have
    one row per match. The context leaves the question rows before any shuffle
    that follows the join.
    """
    asked = asked.withColumn(
        "answertype", export.answertype_of(F.col("rule"), F.col("answertype"))
    ).withColumn("is_impossible", F.coalesce("unanswerable", F.lit(False)))
    split = export.with_split(asked.select("match_id").distinct(), "match_id", seed)
    documents = split.join(contexts, "match_id").join(fact_texts, "match_id")

    key = "question_key"
    # Neither the choices nor the records of a match outnumber its questions by more than these.
    largest = largest_group(asked, ["match_id"]) + spans.MIN_CHOICES
    pairs = asked.filter(~F.col("is_impossible")).join(contexts, "match_id")
    # Read four times below, so the search is done once and its narrow result kept.
    located = reliable(
        spans.with_spans(pairs, minute=minute).select(
            key, "match_id", "clean_answer", "spans", "pieces", "reason",
            F.length("context").alias("context_length"),
        )
    )
    status = located.select(key, "reason")
    direct = spans.span_rows(located, [key])
    by_word = spans.last_word_spans(located, [key]).withColumn("no", F.col("answer_start"))
    numeric = located.filter(F.col("reason") == "numeric").select(
        key, "match_id", F.col("clean_answer").try_cast("bigint").alias("value"), "clean_answer",
        "context_length",
    )
    choices = spans.numeric_choices(numeric, "match_id", seed, largest=largest)
    placed = spans.numeric_spans(numeric, choices, "match_id").select(
        key,
        F.lit(0).alias("no"),
        F.col("clean_answer").alias("text"),
        F.col("answer_start").cast("int").alias("answer_start"),
    )
    found = direct.unionByName(by_word).unionByName(placed)

    records = asked.withColumn(
        "id", export.question_id(F.col("rule"), seed, F.col(key))
    ).withColumnRenamed("datalog", "query")
    nested = export.nested_documents(
        export.question_records(records, found, key),
        _with_choice_lines(documents, choices),
        "match_id",
    )
    statuses = (
        asked.join(status, key, "left")
        .join(split, "match_id")
        .withColumn(
            "status",
            F.when(F.col("reason").isNull() | F.col("reason").isin("numeric", "last_word"), "added")
            .otherwise(F.col("reason")),
        )
        .select(key, "match_id", "split", "status")
    )
    return Dataset(nested, statuses)


def _with_choice_lines(documents: DataFrame, choices: DataFrame) -> DataFrame:
    """Documents whose context ends with their line of numbers, if they have one."""
    line = spans.choice_line(choices, "match_id")
    longer = F.concat(F.col("context"), F.lit("\n\n"), F.col("numbers"))
    return (
        documents.join(line, "match_id", "left")
        .withColumn("context", F.coalesce(longer, F.col("context")))
        .drop("numbers")
    )


def single_texts(texts: DataFrame, name: str, column: str) -> DataFrame:
    """(match_id, name): the stripped text of every match."""
    return texts.select("match_id", strip(F.col(column)).alias(name))
