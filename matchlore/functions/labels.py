"""Columns derived from a match or player row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def age_in_years(birthday: Column, as_of: Column) -> Column:
    """Whole days since birthday over 365, cut towards zero."""
    return (F.datediff(as_of, birthday) / F.lit(365)).cast("int")


def parsed_timestamp(text: Column) -> Column:
    return F.try_to_timestamp(text)


def result_label(home: Column, away: Column) -> Column:
    """tie, home-win or away-win; ``-`` while a side has no goals recorded."""
    return (
        F.when(home == away, "tie")
        .when(home > away, "home-win")
        .when(home < away, "away-win")
        .otherwise("-")
    )


def winner(home: Column, away: Column, hometeam: Column, awayteam: Column) -> Column:
    """Name of the winning team, NULL on a tie."""
    return F.when(home > away, hometeam).when(home < away, awayteam)


def versus(hometeam: Column, awayteam: Column) -> Column:
    return F.concat_ws(" vs. ", hometeam, awayteam)


def score_text(home: Column, away: Column) -> Column:
    return F.concat_ws(":", home.cast("string"), away.cast("string"))


def card_colour(card_type: Column) -> Column:
    """``y`` and ``r`` for anything that begins with them, other values kept."""
    return (
        F.when(card_type.startswith("y"), "y")
        .when(card_type.startswith("r"), "r")
        .otherwise(card_type)
    )


def team_role(team: Column, hometeam: Column, awayteam: Column) -> Column:
    """home, away, or NULL for a team in neither role; home wins if both match."""
    return F.when(team == hometeam, "home").when(team == awayteam, "away")


def effective_minute(elapsed: Column, elapsed_plus: Column) -> Column:
    return elapsed + F.coalesce(elapsed_plus, F.lit(0))


def qualified_id(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix + "_"), key.cast("string"))
