"""From the relational tables to events, facts and reports of all matches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from matchlore.operators import events as ev
from matchlore.operators import facts as fx
from matchlore.operators import model, reports
from matchlore.operators.rules import Rule
from matchlore.session import reliable
from matchlore.sources import fact_text
from matchlore.sources.runs import RunFolder

# Rules of our own: what the report says about an event.
REPORT_RULES = (
    Rule("textrep", "textrep", "R_SHORT", "short_form AND player1.name IS NOT NULL",
         "concat('Again the same player: ', event_kind, '.')"),
    Rule("textrep", "textrep", "R_PAIR", "player1.name IS NOT NULL AND player2.name IS NOT NULL",
         "concat(player1.name, ' and ', player2.name, ' are part of a ', event_kind, '.')"),
    Rule("textrep", "textrep", "R_ONE", "player1.name IS NOT NULL",
         "concat(player1.name, ' of the ', team, ' team: ', event_kind, '.')"),
    Rule("textrep", "textrep", "R_TEAM", "true", "concat('The ', team, ' team: ', event_kind, '.')"),
)


_TEXTS = StructType([
    StructField("match_id", LongType()), StructField("context", StringType()), StructField("text", StringType())
])


@dataclass(frozen=True)
class Corpus:
    """``matches`` are scored; ``reports`` (match_id, context) and ``fact_texts`` (match_id, text) have a row per match."""

    matches: DataFrame
    events: DataFrame
    facts: DataFrame
    reports: DataFrame
    fact_texts: DataFrame


def build_corpus(
    tables: Mapping[str, DataFrame],
    seed: int,
    rules: Sequence[Rule] = REPORT_RULES,
    whole_match_rule: bool = True,
    events: DataFrame | None = None,
    done: DataFrame | None = None,
) -> Corpus:
    """``tables``: Match, Team, Country, League and Player as read from parquet.

    Events and scored matches are kept in reliable checkpoints, as all outputs
    share them. Pass ``events`` (a stored result of ``match_events``) to skip parsing, and
    ``done`` (match_id) to leave out matches that have their texts already.
    """
    if done is not None:
        finished = done.select(F.col("match_id").alias("id"))
        tables = {**tables, "Match": reports.unfinished(tables["Match"], finished, ["id"])}
    overview = model.match_overview(
        tables["Match"], tables["Country"], tables["League"], tables["Team"]
    )
    with_data = model.matches_with_events(tables["Match"])
    if events is None:
        events = reliable(
            ev.match_events(with_data, overview, tables["Team"], tables["Player"], whole_match_rule)
        )
    ids = with_data.select(F.col("id").alias("match_id"))
    recorded = overview.join(ids, "match_id", "left_semi")
    # The score text counts goal events; the goals of the table stay beside it.
    scores = model.recomputed_score(recorded.select("match_id"), events).select("match_id", "score")
    matches = reliable(recorded.join(scores, "match_id"))
    return Corpus(
        matches=matches,
        events=events,
        facts=fx.facts_of(matches, events),
        reports=_reports(matches, events, rules, seed),
        fact_texts=_fact_texts(matches, events),
    )


def _reports(matches: DataFrame, events: DataFrame, rules: Sequence[Rule], seed: int) -> DataFrame:
    lines = reports.report_lines(
        events.withColumn("__subject", F.struct("team", "player1.name").cast("string")),
        rules,
        seed,
        subject="__subject",
    )
    headers = matches.select(
        "match_id",
        F.concat_ws(" ", F.concat_ws(" vs. ", "hometeam", "awayteam"), F.lit("in"), "league").alias("header"),
    )
    return reports.joined_lines(reports.with_header(lines, headers))


def _fact_texts(matches: DataFrame, events: DataFrame) -> DataFrame:
    match_rows = fx.match_entities(matches)
    event_rows = fx.event_entities(events).withColumn(
        "match_id_text", F.concat(F.lit("match_"), F.col("match_id").cast("string"))
    )
    match_names = {name: f"match/{name}" for name in fx.MATCH_ATTRS}
    event_names = {
        "match_id_text" if name == "match_id" else name: f"event/{name}" for name in fx.EVENT_ATTRS
    }

    def rendered(rows: DataFrame, names: Mapping[str, str]) -> DataFrame:
        entries = fx.entity_entries(rows, names, fx.INTEGER_ATTRS)
        return rows.select(
            "match_id",
            (F.col("entity_id") - fx.FIRST_ENTITY).alias("pos"),
            fact_text.render_entries(entries).alias("line"),
        )

    event_lines = rendered(event_rows, event_names)
    kept = ev.drop_repeats(event_lines, ["match_id"], [F.col("pos")])
    return fact_text.fact_texts(
        rendered(match_rows, match_names).unionByName(kept), "match_id"
    )


def _text_runs(spark: SparkSession, folder: str) -> RunFolder:
    return RunFolder(spark, folder, _TEXTS, "match_id")


def write_corpus(built: Corpus, folder: str, run: str | None = None) -> int:
    """Adds the report and the fact text of every match the folder does not have; returns how many matches.

    Both texts of a match are one row, so a match is finished with both or not at all.
    """
    texts = built.reports.join(built.fact_texts, "match_id").select("match_id", "context", "text")
    return _text_runs(built.reports.sparkSession, folder).add(texts, run)


def finished_matches(spark: SparkSession, folder: str) -> DataFrame:
    """(match_id): the matches that need no further run, the ``done`` of ``build_corpus``."""
    return _text_runs(spark, folder).finished()


def read_corpus(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Reports and fact texts of all runs."""
    texts = _text_runs(spark, folder).read()
    return texts.select("match_id", "context"), texts.select("match_id", "text")
