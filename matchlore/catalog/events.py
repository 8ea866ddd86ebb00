"""Queries over events: XML, validity, order and repeats."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchlore.catalog import standins as st
from matchlore.functions import labels
from matchlore.operators import events as ev
from matchlore.operators import model, stats
from matchlore.sources.tables import read_table
from matchlore.sources.xml_events import event_documents, event_elements

_TAG = "concat('<{tag}>', cast({value} as string), '</{tag}>')"


def _element(**tags: str):
    parts = [_TAG.format(tag=tag, value=value) for tag, value in tags.items()]
    return F.expr(f"concat('<value>', {', '.join(parts)}, '</value>')")


def _xml_matches(spark, folder):
    """Orders with up to eight filled event columns, among them blank and empty ones."""
    orders = read_table(
        spark, folder, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
        spread=True,
    )
    goal = _element(
        id="o_orderkey", Elapsed="o_orderkey % 90", elapsed_plus="o_custkey % 4", n="7",
        sortorder="o_custkey % 3 - 1", player1="o_custkey % 160", team="o_custkey % 110 + 1000",
        type="'goal'", goal_type="lower(o_orderstatus)", comment="'c'",
        event_incident_typefk="o_custkey",
    )
    second = _element(
        id="o_orderkey + 1", elapsed="o_orderkey % 45", player1="'Unknown Player'",
        team="o_orderkey % 90 + 1000", type="'goal'", subtype="'&lt;a &amp; b'", note="o_orderpriority", nested="'<x>1</x>'",
    )
    card = _element(
        id="o_orderkey", elapsed="o_custkey % 90", card_type="if(o_orderkey % 2 = 0, 'y2', 'r')",
        team="o_orderkey % 90 + 1000", type="'card'", **{"del": "o_orderkey % 3"},
    )
    possession = _element(
        id="o_orderkey", elapsed="o_orderkey % 60", homepos="o_custkey % 100",
        team="o_custkey % 110 + 1000", type="'special'",
    )
    status, rank = F.col("o_orderstatus"), F.substring("o_orderpriority", 1, 1)

    def root(tag, *elements):
        return F.concat(F.lit(f"<{tag}>"), *elements, F.lit(f"</{tag}>"))

    xml = {kind: F.lit(None).cast("string") for kind in model.EVENT_KINDS}
    xml["goal"] = F.when(status == "F", root("goal", goal, second)).when(
        status == "O", root("goal", goal)
    )
    xml["card"] = F.when(rank == "5", "  ").when(rank == "4", "<card />").otherwise(root("card", card))
    xml["possession"] = F.when(rank.isin("1", "2"), root("possession", possession))
    return orders.select(F.col("o_orderkey").alias("id"), *[c.alias(k) for k, c in xml.items()])


def xml_events(spark, folder):
    """XML columns to typed event rows, and tags without a column of their own."""
    parsed = ev.event_fields(event_elements(event_documents(_xml_matches(spark, folder))))
    numbers = ("position", "kind_no", "elapsed", "sortorder", "elapsed_plus", "minute")
    return parsed.select(
        "match_id",
        "event_kind",
        *[F.col(c).cast("bigint").alias(c) for c in numbers],
        *ev.TEXT_TAGS,
        F.element_at("extra", "note").alias("note"),
        F.size("extra").cast("bigint").alias("extras"),
    )


def _match_events(spark, folder, whole):
    events = ev.match_events(
        _xml_matches(spark, folder),
        model.match_overview(
            st.matches(spark, folder), st.countries(spark, folder),
            st.leagues(spark, folder), st.teams(spark, folder),
        ),
        st.teams(spark, folder),
        st.players(spark, folder),
        whole_match_rule=whole,
    )
    return events.select(
        "match_id", F.col("pos").cast("bigint").alias("pos"), "event_kind", "event_id", "team",
        F.col("minute").cast("bigint").alias("minute"), "card_type",
        F.col("player1.name").alias("player1"),
    )


def match_events(spark, folder):
    """From XML columns to usable, ordered events with names and roles."""
    return _match_events(spark, folder, True)


def match_events_each(spark, folder):
    """The same with every event judged by itself."""
    return _match_events(spark, folder, False)


def card_norm(spark, folder):
    orders = read_table(spark, folder, "orders", "o_orderkey", "o_orderpriority")
    # First letters of the priority text stand for card types: l, h, m, u, n.
    kind = F.lower(F.regexp_extract("o_orderpriority", "[A-Z ]+", 0))
    raw = F.translate(kind, "hu", "yr")
    return orders.select(
        "o_orderkey", raw.alias("raw"), labels.card_colour(raw).alias("card_type")
    )


def team_role(spark, folder):
    lines = read_table(spark, folder, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    team, home, away = F.col("l_partkey") % 4, F.col("l_suppkey") % 4, F.col("l_orderkey") % 4
    role = labels.team_role(team, home, away)
    return lines.groupBy(F.col("l_linenumber").cast("bigint").alias("line"), role.alias("role")).agg(
        F.count(F.lit(1)).alias("n")
    )


def invalid_filter(spark, folder):
    events = st.match_events(spark, folder).select(
        "eid",
        "team",
        "del",
        F.when(F.col("event_kind") == "view", "possession").otherwise(F.col("event_kind")).alias("event_kind"),
        F.when(F.col("value") > 5, F.col("value")).alias("homepos"),
        F.when(F.col("value") < 3, F.col("value")).alias("awaypos"),
    )
    return events.filter(~ev.is_invalid()).select("eid", "event_kind")


def deleted_filter(spark, folder):
    events = st.match_events(spark, folder).withColumn("invalid", F.col("team").isNull())
    return ev.drop_invalid(events).select("eid", "match_id")


def event_order(spark, folder):
    ordered = ev.order_events(st.match_events(spark, folder))
    return ordered.select("match_id", "eid", F.col("pos").cast("bigint").alias("pos"))


def consecutive_dedup(spark, folder):
    events = read_table(spark, folder, "events", "user_id", "ts", "event_id", "event_type")
    order = [F.col("ts"), F.col("event_id")]
    return ev.drop_repeats(events, ["user_id"], order, "event_type").select(
        "user_id", "event_id", "event_type"
    )


def coref_alternation(spark, folder):
    events = read_table(spark, folder, "events", "user_id", "ts", "event_id", "event_type")
    order = [F.col("ts"), F.col("event_id")]
    return ev.short_form_allowed(events, ["user_id"], order, "event_type").select(
        "user_id", "event_id", "short_form"
    )


def _carried(spark, folder, hold):
    """Two of three events name their kind; an event of the same kind refers to it."""
    events = read_table(spark, folder, "events", "user_id", "ts", "event_id", "event_type")
    named = F.struct(F.col("event_type").alias("subject"), F.col("event_id").alias("source"))
    found = ev.carried_values(
        events, ["user_id"], [F.col("ts"), F.col("event_id")], F.when(F.col("event_id") % 3 != 0, named),
        lambda carried: carried["subject"] == F.col("event_type"), hold,
    )
    return found.select(
        "user_id", "event_id", F.col("carried.subject").alias("carried_subject"),
        F.col("carried.source").alias("carried_from"), F.col("carried_used").alias("used"),
    )


def coref_replacements(spark, folder):
    """What each event can refer to, kept until an event has used or replaced it."""
    return _carried(spark, folder, True)


def coref_handed_on(spark, folder):
    """What each event is handed by the one right before it."""
    return _carried(spark, folder, False)


def flatten_kinds(spark, folder):
    """Events kept per kind, put into one list again."""
    events = st.match_events(spark, folder)
    kinds = ("view", "click", "error", "purchase", "signup")
    wide = events.select(
        "eid", *[F.when(F.col("event_kind") == kind, F.col("value")).alias(kind) for kind in kinds]
    )
    long = wide.unpivot("eid", list(kinds), "event_kind", "value")
    return long.filter(F.col("value").isNotNull())


def events_per_match_hist(spark, folder):
    return stats.events_per_match(
        st.match_numbers(spark, folder), st.match_events(spark, folder).select("match_id")
    )


QUERIES = {
    f.__name__: f
    for f in (
        xml_events, match_events, match_events_each, card_norm, team_role, invalid_filter,
        deleted_filter, event_order, consecutive_dedup, coref_alternation, coref_replacements,
        coref_handed_on, flatten_kinds,
        events_per_match_hist,
    )
}

# The elements of _xml_matches as rows.
_ELEMENTS = """el AS (
  SELECT o_orderkey AS match_id, 'goal' AS event_kind, 0 AS kind_no, 0 AS position,
    o_orderkey % 90 AS elapsed, o_custkey % 3 - 1 AS sortorder, o_custkey % 4 AS elapsed_plus,
    CAST(o_orderkey AS VARCHAR) AS event_id, 'goal' AS event_type, CAST(o_custkey AS VARCHAR) AS event_type_id,
    CAST(o_custkey % 160 AS VARCHAR) AS player1, CAST(NULL AS VARCHAR) AS player2,
    CAST(o_custkey % 110 + 1000 AS VARCHAR) AS team, CAST(NULL AS VARCHAR) AS subtype,
    CAST(NULL AS VARCHAR) AS card_type, lower(o_orderstatus) AS goal_type,
    CAST(NULL AS VARCHAR) AS homepos, CAST(NULL AS VARCHAR) AS awaypos, CAST(NULL AS VARCHAR) AS del,
    CAST(NULL AS VARCHAR) AS note, 0 AS extras
  FROM orders WHERE o_orderstatus IN ('F', 'O')
  UNION ALL SELECT o_orderkey, 'goal', 0, 1, o_orderkey % 45, NULL, 0, CAST(o_orderkey + 1 AS VARCHAR), 'goal',
    NULL, 'Unknown Player', NULL, CAST(o_orderkey % 90 + 1000 AS VARCHAR), '<a & b', NULL, NULL, NULL,
    NULL, NULL, o_orderpriority, 1
  FROM orders WHERE o_orderstatus = 'F'
  UNION ALL SELECT o_orderkey, 'card', 4, 0, o_custkey % 90, NULL, 0, CAST(o_orderkey AS VARCHAR), 'card', NULL,
    NULL, NULL, CAST(o_orderkey % 90 + 1000 AS VARCHAR), NULL,
    CASE WHEN o_orderkey % 2 = 0 THEN 'y2' ELSE 'r' END, NULL, NULL, NULL,
    CAST(o_orderkey % 3 AS VARCHAR), NULL, 0
  FROM orders WHERE o_orderpriority[1] NOT IN ('4', '5')
  UNION ALL SELECT o_orderkey, 'possession', 7, 0, o_orderkey % 60, NULL, 0, CAST(o_orderkey AS VARCHAR),
    'special', NULL, NULL, NULL, CAST(o_custkey % 110 + 1000 AS VARCHAR), NULL, NULL, NULL,
    CAST(o_custkey % 100 AS VARCHAR), NULL, NULL, NULL, 0
  FROM orders WHERE o_orderpriority[1] IN ('1', '2'))"""

_MATCH_EVENTS = f"""WITH {st.TEAMS_SQL}, {st.MATCHES_SQL}, {_ELEMENTS},
 named AS (SELECT el.*, t.team_long_name AS name, h.team_long_name AS hn, a.team_long_name AS an
   FROM el JOIN matches m ON m.id = el.match_id
   LEFT JOIN teams t ON t.team_api_id = CAST(el.team AS BIGINT)
   LEFT JOIN teams h ON h.team_api_id = m.home_team_api_id
   LEFT JOIN teams a ON a.team_api_id = m.away_team_api_id),
 placed AS (SELECT *, CASE WHEN name = hn THEN 'home' WHEN name = an THEN 'away' END AS role,
   row_number() OVER (PARTITION BY match_id ORDER BY elapsed + elapsed_plus, coalesce(sortorder, 0),
     event_id, kind_no, position) AS pos FROM named),
 kept AS (SELECT * FROM placed {{rule}})
 SELECT match_id, pos, event_kind, event_id, role AS team, elapsed + elapsed_plus AS minute,
   CASE WHEN card_type[1] IN ('y', 'r') THEN card_type[1] ELSE card_type END AS card_type,
   CASE WHEN player1 = 'Unknown Player' THEN 'unknown' WHEN player1 IS NULL THEN NULL
        ELSE coalesce(s_name, 'unknown') END AS player1
 FROM kept LEFT JOIN supplier ON s_suppkey = TRY_CAST(player1 AS BIGINT)
 WHERE role IS NOT NULL AND coalesce(del, '') <> '1'"""



def _carried_sql(otherwise_subject: str, otherwise_source: str) -> str:
    """Event by event: what was used is gone, what is named replaces the rest."""
    return f"""WITH RECURSIVE o AS (SELECT user_id, event_id, event_type, event_id % 3 <> 0 AS names,
       row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events),
     s AS (SELECT *, CAST(NULL AS VARCHAR) AS subject, CAST(NULL AS BIGINT) AS source FROM o WHERE pos = 1
       UNION ALL SELECT o.*,
         CASE WHEN s.subject = s.event_type THEN NULL WHEN s.names THEN s.event_type ELSE {otherwise_subject} END,
         CASE WHEN s.subject = s.event_type THEN NULL WHEN s.names THEN s.event_id ELSE {otherwise_source} END
       FROM s JOIN o ON o.user_id = s.user_id AND o.pos = s.pos + 1)
     SELECT user_id, event_id, subject AS carried_subject, source AS carried_from,
       coalesce(subject = event_type, false) AS used FROM s"""


SQL = {
    "coref_replacements": _carried_sql("s.subject", "s.source"),
    "coref_handed_on": _carried_sql("NULL", "NULL"),
    "xml_events": f"""WITH {_ELEMENTS} SELECT match_id, event_kind, CAST(kind_no AS BIGINT) AS kind_no,
        CAST(position AS BIGINT) AS position, elapsed, sortorder, elapsed_plus,
        elapsed + elapsed_plus AS minute, event_id, event_type, event_type_id, player1, player2,
        team, subtype, card_type, goal_type, homepos, awaypos, del, note,
        CAST(extras AS BIGINT) AS extras FROM el""",
    "match_events": _MATCH_EVENTS.format(
        rule="""WHERE match_id IN (SELECT match_id FROM placed
          GROUP BY match_id HAVING arg_max(role IS NOT NULL, pos))"""
    ),
    "match_events_each": _MATCH_EVENTS.format(rule=""),
    "card_norm": """WITH c AS (SELECT o_orderkey,
          translate(lower(regexp_extract(o_orderpriority, '[A-Z ]+')), 'hu', 'yr') AS raw FROM orders)
        SELECT o_orderkey, raw, CASE WHEN raw LIKE 'y%' THEN 'y' WHEN raw LIKE 'r%' THEN 'r'
          ELSE raw END AS card_type FROM c""",
    "team_role": """SELECT CAST(l_linenumber AS BIGINT) AS line,
          CASE WHEN l_partkey % 4 = l_suppkey % 4 THEN 'home'
               WHEN l_partkey % 4 = l_orderkey % 4 THEN 'away' END AS role, count(*) AS n
        FROM lineitem GROUP BY 1, 2""",
    "invalid_filter": f"""WITH {st.EVENTS_SQL}
        SELECT eid, CASE WHEN event_kind = 'view' THEN 'possession' ELSE event_kind END AS event_kind
        FROM ev WHERE team IS NOT NULL AND NOT (event_kind = 'view' AND value <= 5 AND value >= 3)""",
    "deleted_filter": f"""WITH {st.EVENTS_SQL} SELECT eid, match_id FROM ev
        WHERE team IS NOT NULL AND del IS DISTINCT FROM '1'""",
    "event_order": f"""WITH {st.EVENTS_SQL} SELECT match_id, eid,
        row_number() OVER (PARTITION BY match_id ORDER BY {st.ORDER_SQL}) AS pos FROM ev""",
    "consecutive_dedup": """SELECT user_id, event_id, event_type FROM (
        SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)
        WHERE event_type IS DISTINCT FROM p""",
    "coref_alternation": """WITH a AS (SELECT *, row_number() OVER w AS pos,
          coalesce(event_type = lag(event_type) OVER w, false) AS eligible
          FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
        b AS (SELECT *, max(CASE WHEN NOT eligible THEN pos END)
          OVER (PARTITION BY user_id ORDER BY pos) AS head FROM a)
        SELECT user_id, event_id, (pos - head) % 2 = 1 AS short_form FROM b""",
    "flatten_kinds": "SELECT event_id AS eid, event_type AS event_kind, value FROM events",
    "events_per_match_hist": f"""WITH {st.EVENTS_SQL}, c AS (SELECT c_custkey, count(eid) AS events
        FROM customer LEFT JOIN ev ON match_id = c_custkey GROUP BY 1)
        SELECT events, count(*) AS n FROM c GROUP BY 1""",
}
