"""The relational side: dimensions, matches, lineups and lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlore.functions import labels
from matchlore.functions.sampling import hash_number, seed_hash
from matchlore.operators.ordered import OrderedGroups, first_in_group, hash_ranked
from matchlore.session import kept_table

# The event columns of the match table.
EVENT_KINDS = (
    "goal", "shoton", "shotoff", "foulcommit", "card", "cross", "corner", "possession",
)
SIDES = ("home", "away")
SLOTS = range(1, 12)


def players_with_age(players: DataFrame, as_of: Column) -> DataFrame:
    birthday = F.try_to_timestamp("birthday")
    return players.withColumn("birthday", birthday).withColumn(
        "age", labels.age_in_years(F.col("birthday"), as_of)
    )


def leagues_with_country(leagues: DataFrame, countries: DataFrame) -> DataFrame:
    country = countries.select(F.col("id").alias("country_id"), F.col("name").alias("country"))
    return leagues.select("id", F.col("name").alias("league"), "country_id").join(
        country, "country_id", "left"
    ).select("id", "league", "country")


def match_overview(
    matches: DataFrame, countries: DataFrame, leagues: DataFrame, teams: DataFrame
) -> DataFrame:
    """Matches with the names of country, league and both teams, and the result.

    Left joins throughout: a match with an unknown team stays. Spark broadcasts
    the dimensions while their size statistics allow it.
    """

    country = countries.select(F.col("id").alias("country_id"), F.col("name").alias("country"))
    league = leagues.select(F.col("id").alias("league_id"), F.col("name").alias("league"))
    home, away = (
        teams.select(
            F.col("team_api_id").alias(f"{side}_team_api_id"),
            F.col("id").alias(f"{side}team_id"),
            F.col("team_long_name").alias(f"{side}team"),
        )
        for side in SIDES
    )
    joined = (
        matches.join(country, "country_id", "left")
        .join(league, "league_id", "left")
        .join(home, "home_team_api_id", "left")
        .join(away, "away_team_api_id", "left")
    )
    return joined.select(
        F.col("id").alias("match_id"),
        "match_api_id",
        "country",
        "league_id",
        "league",
        "hometeam_id",
        "hometeam",
        F.col("home_team_goal").alias("home_goals"),
        "awayteam_id",
        "awayteam",
        F.col("away_team_goal").alias("away_goals"),
        labels.parsed_timestamp(F.col("date").cast("string")).alias("match_date"),
        labels.result_label(F.col("home_team_goal"), F.col("away_team_goal")).alias("result"),
    )


def left_lookup(df: DataFrame, key: str, table: DataFrame, table_key: str) -> DataFrame:
    """Left join to a table that is unique on ``table_key``.

    Rows without a key match nothing, and there may be very many of them; each gets
    a spread value of its own, so they go to all tasks alike.
    """
    hashable = [name for name, kind in df.dtypes if "map<" not in kind]
    spread = F.when(F.col(key).isNull(), F.xxhash64(*hashable)).otherwise(F.lit(0).cast("bigint"))
    left = df.withColumn("__spread", spread)
    right = table.withColumn("__zero", F.lit(0).cast("bigint")).withColumnRenamed(
        table_key, "__key"
    )
    match = (left[key] == right["__key"]) & (left["__spread"] == right["__zero"])
    return left.join(right, match, "left").drop("__spread", "__zero", "__key")


def prepared_teams(teams: DataFrame, attr: str = "team_api_id") -> DataFrame:
    """One team per key, the one with the smallest id, stored once for any number of lookups.

    As a table its size is known: small ones are broadcast, so that the rows that look up are not shuffled.
    """
    teams = teams.select("id", "team_api_id", "team_long_name", "team_short_name")
    return kept_table(first_in_group(teams, [attr], ["id"]), "teams")


def prepared_players(players: DataFrame) -> DataFrame:
    """One player per key like ``prepared_teams``."""
    players = players.select("id", "player_api_id", "player_name")
    return kept_table(first_in_group(players, ["player_api_id"], ["id"]), "players")


def lookup_team(
    df: DataFrame, key: str, teams: DataFrame, prefix: str, attr: str = "team_api_id", prepared: bool = False
) -> DataFrame:
    """Adds ``{prefix}_id, _api_id, _longname, _shortname``; NULL if there is no such team.

    Of several teams with one key the one with the smallest id is taken. ``prepared`` teams are unique already.
    """
    chosen = teams if prepared else first_in_group(
        teams.select("id", "team_api_id", "team_long_name", "team_short_name"), [attr], ["id"]
    )
    named = chosen.select(
        F.col(attr).alias("__team_key"),
        F.col("id").alias(f"{prefix}_id"),
        F.col("team_api_id").alias(f"{prefix}_api_id"),
        F.col("team_long_name").alias(f"{prefix}_longname"),
        F.col("team_short_name").alias(f"{prefix}_shortname"),
    )
    return left_lookup(df, key, named, "__team_key")


# Fixed value: the text that stands for a player without a row.
UNKNOWN_PLAYER = "unknown player"


def lookup_player(
    df: DataFrame, key: str, players: DataFrame, name: str, prepared: bool = False
) -> DataFrame:
    """Adds ``name STRUCT<id, name, valid>`` for a player key given as id or as text.

    No key gives NULL; a key without a row gives (key, 'unknown', false); the
    text 'unknown player' gives (-1, 'unknown', false).
    """
    unique = players if prepared else first_in_group(
        players.select("id", "player_api_id", "player_name"), ["player_api_id"], ["id"]
    )
    chosen = unique.select(
        F.col("player_api_id").alias("__player_key"),
        F.col("id").alias("__player_id"),
        F.col("player_name").alias("__player_name"),
    )
    text = F.lower(F.trim(F.col(key).cast("string")))
    keyed = df.withColumn("__unknown", text == UNKNOWN_PLAYER).withColumn(
        "__api_id", F.when(text != UNKNOWN_PLAYER, text).cast("bigint")
    )
    joined = left_lookup(keyed, "__api_id", chosen, "__player_key")

    def player(identity: Column, label: Column, valid: bool) -> Column:
        return F.struct(
            identity.cast("bigint").alias("id"), label.alias("name"), F.lit(valid).alias("valid")
        )

    unknown = F.lit("unknown")
    found = (
        F.when(F.col("__unknown"), player(F.lit(-1), unknown, False))
        .when(
            F.col("__player_id").isNotNull(),
            player(F.col("__player_id"), F.col("__player_name"), True),
        )
        .when(F.col("__api_id").isNotNull(), player(F.col("__api_id"), unknown, False))
    )
    return joined.withColumn(name, found).drop(
        "__unknown", "__api_id", "__player_id", "__player_name"
    )


def lineup_slots(
    matches: DataFrame, sides: Sequence[str] = SIDES, slots: Sequence[int] = SLOTS
) -> DataFrame:
    """Slot columns ``{side}_player_{n}`` as rows (match_id, side, slot, player_api_id)."""
    columns = [f"{side}_player_{slot}" for side in sides for slot in slots]
    long = matches.select(
        F.col("id").alias("match_id"), *[F.col(c).cast("double").alias(c) for c in columns]
    ).unpivot("match_id", columns, "slot_column", "value")
    part = F.split("slot_column", "_player_")
    # NaN stands for a missing id in files written by pandas.
    return long.filter(F.col("value").isNotNull() & ~F.isnan("value")).select(
        "match_id",
        part[0].alias("side"),
        part[1].cast("int").alias("slot"),
        F.col("value").cast("bigint").alias("player_api_id"),
    )


def lineups(matches: DataFrame, players: DataFrame, **slots) -> DataFrame:
    found = lookup_player(lineup_slots(matches, **slots), "player_api_id", players, "player")
    return found.select("match_id", "side", "slot", "player_api_id", "player.*")


def matches_with_events(matches: DataFrame, columns: Sequence[str] = EVENT_KINDS) -> DataFrame:
    return matches.filter(F.coalesce(*columns).isNotNull())


def match_by_id(matches: DataFrame, match_id: int, key: str = "match_id") -> DataFrame:
    return matches.filter(F.col(key) == match_id)


def match_count(matches: DataFrame) -> DataFrame:
    return matches.agg(F.count(F.lit(1)).alias("matches"))


def recomputed_score(matches: DataFrame, events: DataFrame) -> DataFrame:
    """Replaces the goals of every match by its goal events per side.

    Own goals and missed penalties count like any goal event; a match without
    events has 0:0. Goal events are counted before they meet the matches.
    """
    goals = (
        events.filter(F.col("event_kind") == "goal")
        .groupBy("match_id")
        .agg(
            F.count_if(F.col("team") == "home").alias("home_goals"),
            F.count_if(F.col("team") == "away").alias("away_goals"),
        )
    )
    joined = matches.drop("home_goals", "away_goals").join(goals, "match_id", "left")
    return joined.fillna(0, ["home_goals", "away_goals"]).withColumn(
        "score", labels.score_text(F.col("home_goals"), F.col("away_goals"))
    )


def league_teams(matches: DataFrame) -> DataFrame:
    """Distinct (league_id, team_id) over both roles."""
    home, away = (
        matches.select("league_id", F.col(f"{side}team_id").alias("team_id")) for side in SIDES
    )
    return home.union(away).filter(F.col("team_id").isNotNull()).distinct()


def sample_match(matches: DataFrame, seed: int, key: str = "match_id") -> DataFrame:
    """One seeded random match."""
    return matches.orderBy(seed_hash(seed, F.col(key)), key).limit(1)


def synthesize_matches(
    templates: DataFrame,
    leagues: DataFrame,
    league_team: DataFrame,
    teams: DataFrame,
    seed: int,
    distinct_teams: bool = True,
) -> DataFrame:
    """Copies of matches moved to a drawn country, a league of it and two of its teams.

    ``leagues`` (id, league, country) and ``league_team`` (league_id, team_id)
    list the choices. Each draw is a number that meets a numbered choice in an
    equi-join. With ``distinct_teams`` the away team differs from the home team
    wherever the league has two.
    """

    def draw(what: str, size: Column) -> Column:
        return F.pmod(hash_number(seed_hash(seed, F.col("match_id"), F.lit(what))), size)

    usable = leagues.join(
        league_team.select(F.col("league_id").alias("id")).distinct(), "id", "left_semi"
    ).filter(F.col("country").isNotNull())
    countries = hash_ranked(usable.select("country").distinct(), ["country"], seed, "country_no")
    numbered_leagues = _numbered(usable, "country", "id", "league_no", "leagues")
    numbered_teams = _numbered(
        league_team.join(teams.select(F.col("id").alias("team_id"), "team_long_name"), "team_id"),
        "league_id", "team_id", "team_no", "teams",
    )
    drawn = (
        templates.withColumn("country_no", draw("country", F.lit(countries.count())))
        .drop("country", "league", "league_id", "hometeam", "awayteam")
        .join(countries.select("country_no", "country"), "country_no")
        .join(numbered_leagues.select("country", "leagues").distinct(), "country")
        .withColumn("league_no", draw("league", F.col("leagues")))
        .join(numbered_leagues.drop("leagues"), ["country", "league_no"])
        .withColumnRenamed("id", "league_id")
        .join(numbered_teams.select("league_id", "teams").distinct(), "league_id")
        .withColumn("home_no", draw("home", F.col("teams")))
    )
    if distinct_teams:
        others = F.greatest(F.col("teams") - 1, F.lit(1))
        step = F.pmod(hash_number(seed_hash(seed, F.col("match_id"), F.lit("away"))), others)
        drawn = drawn.withColumn("away_no", F.pmod(F.col("home_no") + 1 + step, F.col("teams")))
    else:
        drawn = drawn.withColumn("away_no", draw("away", F.col("teams")))
    for side in SIDES:
        names = numbered_teams.select(
            "league_id",
            F.col("team_no").alias(f"{side}_no"),
            F.col("team_long_name").alias(f"{side}team"),
        )
        drawn = drawn.join(names, ["league_id", f"{side}_no"])
    return drawn.select(
        F.col("match_id").alias("template_id"),
        F.lit(-1).cast("bigint").alias("match_id"),
        F.lit(-1).cast("bigint").alias("match_api_id"),
        "country",
        "league",
        "hometeam",
        "awayteam",
        *[goals for goals in ("home_goals", "away_goals") if goals in templates.columns],
    )


def synthetic_events(copies: DataFrame, events: DataFrame) -> DataFrame:
    """The events of every copy: those of its template, as (template_id, match_id, other event columns)."""
    ids = copies.select("template_id", "match_id")
    own = events.withColumnRenamed("match_id", "template_id")
    return ids.join(own, "template_id")


def _numbered(df: DataFrame, group: str, key: str, name: str, size: str) -> DataFrame:
    numbered = OrderedGroups(df, [group], [F.col(key)]).number(name, start=0).df
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias(size))
    return numbered.join(sizes, group)
