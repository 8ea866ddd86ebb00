"""Events: typed fields, names, validity and order."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlore.functions import labels
from matchlore.functions.text import strip
from matchlore.operators.model import lookup_player, lookup_team, prepared_players, prepared_teams
from matchlore.operators.ordered import GROUP_LIMIT, OrderedGroups
from matchlore.sources.xml_events import event_documents, event_elements

# Source tags that are dropped, renamed, or read as numbers.
IGNORED_TAGS = ("comment", "n")
RENAMED_TAGS = {"event_incident_typefk": "event_type_id", "id": "event_id", "type": "event_type"}
NUMBER_TAGS = ("elapsed", "sortorder", "elapsed_plus")
# The event id is no number: ids are compared as text when events are ordered.
TEXT_TAGS = (
    "event_id", "event_type", "event_type_id", "player1", "player2", "team", "subtype",
    "card_type", "goal_type", "homepos", "awaypos", "del",
)


def clean_tags(tags: Column) -> Column:
    """Lower-cased, renamed tags with stripped values; ignored and empty ones dropped."""
    lowered = F.transform_values(
        F.transform_keys(tags, lambda tag, _: strip(F.lower(tag))), lambda _, value: strip(value)
    )
    kept = F.map_filter(
        lowered,
        lambda tag, value: ~tag.isin(*IGNORED_TAGS) & value.isNotNull() & (value != ""),
    )

    def renamed(tag: Column, _: Column) -> Column:
        new = F.when(F.lit(False), tag)
        for old, name in RENAMED_TAGS.items():
            new = new.when(tag == old, name)
        return new.otherwise(tag)

    return F.transform_keys(kept, renamed)


def event_fields(elements: DataFrame, strict: bool = True) -> DataFrame:
    """Tag maps to typed columns; tags without a column of their own go to ``extra``.

    ``strict`` fails on a number that is none; otherwise it becomes NULL.
    """
    keys = ["match_id", "event_kind", "kind_no", "position"]
    cleaned = elements.select(*keys, clean_tags(F.col("tags")).alias("tags"))

    def number(tag: str) -> Column:
        text = F.col("tags")[tag]
        return (text.cast("int") if strict else text.try_cast("int")).alias(tag)

    known = [*NUMBER_TAGS, *TEXT_TAGS]
    typed = cleaned.select(
        *keys,
        *[number(tag) for tag in NUMBER_TAGS],
        *[F.col("tags")[tag].alias(tag) for tag in TEXT_TAGS],
        F.map_filter("tags", lambda tag, _: ~tag.isin(*known)).alias("extra"),
    )
    return typed.withColumn("elapsed_plus", F.coalesce("elapsed_plus", F.lit(0))).withColumn(
        "minute", labels.effective_minute(F.col("elapsed"), F.col("elapsed_plus"))
    )


def resolve_names(events: DataFrame, teams: DataFrame, players: DataFrame) -> DataFrame:
    """Team key to the team's long name, player keys to player structs.

    Each dimension is made unique once, however many keys refer to it.
    """
    teams, players = prepared_teams(teams), prepared_players(players)
    keyed = events.withColumn("__team", F.col("team").cast("bigint"))
    found = lookup_team(keyed, "__team", teams, "team", prepared=True).drop(
        "__team", "team", "team_id", "team_api_id", "team_shortname"
    )
    for player in ("player1", "player2"):
        found = lookup_player(
            found.withColumnRenamed(player, "__key"), "__key", players, player, prepared=True
        ).drop("__key")
    return found


def with_roles(events: DataFrame, matches: DataFrame) -> DataFrame:
    """Adds the role of the event's team in its match and the clean card type."""
    sides = matches.select("match_id", "hometeam", "awayteam")
    role = labels.team_role(F.col("team_longname"), F.col("hometeam"), F.col("awayteam"))
    return (
        events.join(sides, "match_id")
        .withColumn("team", role)
        .withColumn("card_type", labels.card_colour(F.col("card_type")))
        .drop("hometeam", "awayteam")
    )


def is_deleted() -> Column:
    return F.col("del").eqNullSafe("1")


def is_invalid() -> Column:
    """No team, a team in neither role, or a possession without any position."""
    empty_possession = (
        (F.col("event_kind") == "possession")
        & F.col("homepos").isNull()
        & F.col("awaypos").isNull()
    )
    return F.col("team").isNull() | empty_possession


def event_order() -> list[Column]:
    """Minute, sort order, id as text; then the source position makes it total."""
    return [
        F.col("minute").asc_nulls_last(),
        F.coalesce("sortorder", F.lit(0)),
        F.col("event_id").asc_nulls_first(),
        F.col("kind_no"),
        F.col("position"),
    ]


def order_events(
    events: DataFrame,
    group: Sequence[str] = ("match_id",),
    order: Sequence[Column] | None = None,
    name: str = "pos",
    limit: int = GROUP_LIMIT,
    largest: int | None = None,
) -> DataFrame:
    """Numbers the events of a match from 1 in canonical order."""
    return OrderedGroups(events, group, order or event_order(), limit, largest).number(name).df


def last_event_valid(events: DataFrame) -> DataFrame:
    """Events of matches whose last event is valid.

    The source data was produced by a filter that looked at the last event only
    and dropped a match's events as a whole. Whoever needs the same event set
    applies this before ``drop_invalid``. It is a window over the partitioning
    that numbered the events: a match's events come out of one row of the match
    table, so no group is large.
    """
    last = F.max_by("invalid", "pos").over(Window.partitionBy("match_id"))
    return events.withColumn("__last_invalid", last).filter(~F.col("__last_invalid")).drop(
        "__last_invalid"
    )


def drop_invalid(events: DataFrame) -> DataFrame:
    return events.filter(~F.col("invalid") & ~is_deleted())


def match_events(
    matches: DataFrame,
    overview: DataFrame,
    teams: DataFrame,
    players: DataFrame,
    whole_match_rule: bool = True,
    strict: bool = True,
) -> DataFrame:
    """All usable events of all matches, numbered per match.

    ``matches`` holds the XML columns, ``overview`` the team names. With
    ``whole_match_rule`` a match whose last event is invalid loses all events.
    """
    raw = event_fields(event_elements(event_documents(matches)), strict)
    named = with_roles(resolve_names(raw, teams, players), overview)
    # A match's events come out of one row, which bounds the group: no size check.
    ordered = order_events(named, largest=0).withColumn("invalid", is_invalid())
    if whole_match_rule:
        ordered = last_event_valid(ordered)
    return drop_invalid(ordered).drop("invalid")


def drop_repeats(
    lines: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    line: str = "line",
    limit: int = GROUP_LIMIT,
    largest: int | None = None,
) -> DataFrame:
    """Leaves out a line equal to the one before; repeats further apart stay."""
    marked = (
        OrderedGroups(lines, group, order, limit, largest)
        .previous(F.struct(line), "__before")
        .df
    )
    repeated = F.col("__before").isNotNull() & F.col(line).eqNullSafe(F.col("__before")[line])
    return marked.filter(~repeated).drop("__before")


def short_form_allowed(
    events: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    subject: str,
    name: str = "short_form",
    limit: int = GROUP_LIMIT,
    largest: int | None = None,
) -> DataFrame:
    """True where an event may refer back to its predecessor's subject.

    Only an event with the same subject as the one before is eligible, and never
    two events in a row: within a run of equal subjects it is every second one.
    """
    ordered = OrderedGroups(events, group, order, limit, largest)
    ordered.number("__pos").previous(F.col(subject), "__before")
    eligible = F.coalesce(F.col(subject) == F.col("__before"), F.lit(False))
    ordered.running_max(F.when(~eligible, F.col("__pos")), "__head")
    offset = F.col("__pos") - F.col("__head")
    return ordered.df.withColumn(name, offset % 2 == 1).drop("__pos", "__before", "__head")


def carried_values(
    events: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    values: Column,
    uses: Callable[[Column], Column],
    hold: bool = False,
    name: str = "carried",
    limit: int = GROUP_LIMIT,
    largest: int | None = None,
) -> DataFrame:
    """Adds ``name``: the ``values`` struct an event can refer to, and ``name``_used: whether it does.

    An event hands its values (NULL for none) on to the next one. An event for which ``uses`` of the
    values handed to it holds uses them up and hands on nothing, so it is never followed by a second use of
    the same values, nor by one of its own. With ``hold`` an event without values passes on what it was handed, so
    values last until they are used or replaced.

    Who hands on to whom is known before anything is used: the last event before a row that has values (any
    event without ``hold``). Within the stretch that refers to one such event only the first fitting row can
    use it. Whether the event still hands on depends on whether it is itself the first fitting row of the stretch before,
    and so on backwards: in a run of those every second one is used.
    """
    at, own, source, fit, seen, number, head = (f"__{c}" for c in ("event", "own", "source", "fit", "seen", "number", "head"))
    rows = OrderedGroups(events.withColumn(own, values), group, order, limit, largest).number(at)
    hands = F.col(own).isNotNull() if hold else F.lit(True)
    handed = F.struct(F.col(at).alias("at"), F.col(own).alias("values"))
    rows.running_max(F.when(hands, handed), source).previous(F.col(source), source)
    known = F.col(f"{source}.values")
    fits = known.isNotNull() & F.coalesce(uses(known), F.lit(False))
    rows.running_max(F.when(fits, F.col(at)), seen).previous(F.col(seen), seen)
    # Nobody in between has used it: the fitting row seen last is not behind the event that handed on.
    fresh = F.coalesce(F.col(seen) <= F.col(f"{source}.at"), F.lit(True))
    first = fits & fresh
    rows.running_sum(hands.cast("bigint"), number)
    rows.running_max(F.when(hands & ~first, F.col(number)), head)
    # Before the row itself: is the event that handed on a user, an odd number of steps into its run?
    rows.previous(F.col(number) - F.col(head), fit)
    spent = F.coalesce(F.col(fit) % 2 == 1, F.lit(False))
    carried = F.when(fresh & ~spent, known)
    found = rows.df.withColumn(name, carried)
    used = F.col(name).isNotNull() & F.coalesce(uses(F.col(name)), F.lit(False))
    return found.withColumn(f"{name}_used", used).drop(at, own, source, fit, seen, number, head)
