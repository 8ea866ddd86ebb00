"""Queries over facts: scan, patterns, parameters, chains and changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchlore.catalog import standins as st
from matchlore.functions import labels
from matchlore.operators import changes
from matchlore.operators import events as ev
from matchlore.operators import facts as fx
from matchlore.sources import fact_text
from matchlore.sources.tables import read_table

_ATTRS = {
    "event_kind": "event/type", "minute": "event/minute", "team": "event/team",
    "player1": "event/player1", "player2": "event/player2",
}
# The values that change; the missing sixth is NULL.
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def _numbered_events(spark, folder):
    ordered = ev.order_events(st.match_events(spark, folder))
    return ordered.withColumn("entity_id", F.col("pos") + fx.FIRST_ENTITY)


def _facts(spark, folder):
    events = st.match_events(spark, folder).withColumn("entity_id", F.col("eid"))
    return fx.wide_to_facts(events, _ATTRS)


def _match_rows(spark, folder):
    return st.match_numbers(spark, folder).withColumn(
        "score", labels.score_text(F.col("home_goals"), F.col("away_goals"))
    )


def pattern_count(spark, folder):
    """Entities with a minute and type error, counted per match."""
    found = fx.entities_where(_facts(spark, folder), {"event/type": "error"}, ["event/minute"])
    return fx.entity_count(found)


def pattern_values(spark, folder):
    """The same in one grouping, keeping values."""
    return fx.entities_where(
        _facts(spark, folder),
        {"event/type": "click", "event/team": "home"},
        values={"player": "event/player1", "minute": "event/minute"},
    )


def conjunctive_pattern(spark, folder):
    """Goals of a side by player: patterns sharing an entity, values kept."""
    facts = _facts(spark, folder)
    return fx.all_patterns(
        fx.pattern(facts, "event/type", "click"),
        fx.pattern(facts, "event/team", "home"),
        fx.pattern(facts, "event/player1", name="player"),
        fx.pattern(facts, "event/minute", name="minute"),
    ).select("match_id", "entity_id", "player", "minute")


def facts_melt(spark, folder):
    return _facts(spark, folder)


def facts_pivot(spark, folder):
    wide = fx.facts_to_wide(_facts(spark, folder), list(_ATTRS.values()))
    return wide.select("match_id", "entity_id", *[F.col(f"`{a}`").alias(c) for c, a in _ATTRS.items()])


def fact_text_roundtrip(spark, folder):
    """Events to fact text per match and back to facts."""
    events = _numbered_events(spark, folder)
    event_maps = events.select(
        "match_id",
        F.col("pos").alias("at"),
        fact_text.render_entries(
            fx.entity_entries(events, _ATTRS, ["minute"])
        ).alias("line"),
    )
    matches = _match_rows(spark, folder).withColumn("id", labels.qualified_id("match", F.col("match_id")))
    names = {"id": "match/id", "league": "match/league", "hometeam": "match/hometeam", "score": "match/score"}
    match_maps = matches.select(
        "match_id",
        F.lit(0).cast("bigint").alias("at"),
        fact_text.render_entries(fx.entity_entries(matches, names, [])).alias("line"),
    )
    lines = event_maps.unionByName(match_maps).withColumnRenamed("at", "pos")
    texts = fact_text.fact_texts(lines, "match_id")
    maps = fact_text.fact_maps(texts, "match_id")
    return fx.maps_to_facts(maps, "match_id").withColumn("entity_id", F.col("entity_id").cast("bigint"))


def attribute_namespaces(spark, folder):
    """Plain attribute names get the prefix of a match or of an event map."""
    rows = _match_rows(spark, folder)
    scored = F.when(F.col("match_id") % 2 == 0, F.col("score"))
    rows = rows.withColumn("score", scored).withColumn("entity_id", F.lit(2).cast("bigint"))
    names = {"league": "league", "hometeam": "event/hometeam", "score": "score"}
    kept = F.filter(fx.entity_entries(rows, names, []), lambda item: item["value"].isNotNull())
    maps = rows.select("match_id", "entity_id", fx.namespaced(kept).alias("entries"))
    return fx.maps_to_facts(maps, "match_id")


def qualified_ids(spark, folder):
    events = st.match_events(spark, folder)
    return events.select(
        "eid",
        labels.qualified_id("match", F.col("match_id")).alias("match"),
        labels.qualified_id("event", F.col("eid")).alias("event"),
    )


def param_query(spark, folder):
    """Events by a player, for one parameter row per customer segment and player."""
    parameters = read_table(spark, folder, "part", "p_partkey").select(
        F.concat(F.lit("Ana Maria P"), F.pmod("p_partkey", F.lit(4)).cast("string")).alias("who")
    ).distinct()
    found = fx.pattern(_facts(spark, folder), "event/player1", name="player")
    return fx.entity_count(fx.with_parameters(found, parameters, {"player": "who"}))


def ref_traverse(spark, folder):
    """From an order to its customer to the name of the customer's nation."""
    orders = read_table(spark, folder, "orders", "o_orderkey", "o_custkey")
    customer = read_table(spark, folder, "customer", "c_custkey", "c_nationkey")
    nation = read_table(spark, folder, "nation", "n_nationkey", "n_name")
    step = fx.follow(orders.withColumnRenamed("o_custkey", "ref"), "ref", customer, "c_custkey")
    last = fx.follow(step.withColumnRenamed("c_nationkey", "to"), "to", nation, "n_nationkey")
    return last.select("o_orderkey", F.col("n_name").alias("name"))


def multi_value(spark, folder):
    """Several names of one conversation as facts of their own."""
    talks = read_table(spark, folder, "conversations", "conv_id", "turn", "role", "text")
    words = F.split("text", " ")
    return fx.multi_valued(talks.select("conv_id", "turn", words.alias("aka")), "aka", "name")


def _chain_steps(spark, folder):
    events = st.match_events(spark, folder)
    order = [F.col("minute"), F.col("eid")]
    first = fx.first_answer(
        events.filter(F.col("event_kind") == "purchase").withColumn("value", F.col("player1")),
        "match_id", order,
    )
    asked = events.filter(F.col("event_kind") == "error").join(
        first.select("match_id", F.col("value").alias("player1")), ["match_id", "player1"]
    )
    second = fx.first_answer(asked.withColumn("value", F.col("minute").cast("string")), "match_id", order)
    return first, second


def chained_query(spark, folder):
    """First buyer, then the buyer's first error; the buyer where there is no error."""
    first, second = _chain_steps(spark, folder)
    loose = fx.chained(first, second, key="match_id")
    strict = fx.chained(first, second, key="match_id", strict=True)
    return loose.join(strict.withColumnRenamed("value", "strict_value"), "match_id")


def chained_three(spark, folder):
    """First buyer and side, then that buyer's first error on that side, then a click in the minute of the error.

    Where there is no error the third question is asked with the buyer, whom no minute equals.
    """
    events = st.match_events(spark, folder)

    def of(kind):
        return events.filter(F.col("event_kind") == kind)

    steps = [
        fx.Step(of("purchase"), ["player1", "team"], order=["minute", "eid"]),
        fx.Step(of("error"), ["minute", "player1"], takes=["player1", "team"], order=["minute", "eid"]),
        fx.Step(of("click"), ["eid"], takes=["minute"], order=["minute", "eid"]),
    ]
    found = fx.chain(st.match_numbers(spark, folder).select("match_id"), steps, "match_id")
    return found.select("match_id", F.array_join("value", "|", "none").alias("value"), "step")


def first_answers(spark, folder):
    return _chain_steps(spark, folder)[0]


def denormalise_parent(spark, folder):
    """Order columns copied to the lines; a line's own status wins."""
    lines = read_table(spark, folder, "lineitem", "l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
    status = F.when(F.col("l_returnflag") == "N", F.col("l_returnflag"))
    lines = lines.select(F.col("l_orderkey").alias("match_id"), "l_partkey", "l_quantity", status.alias("status"))
    orders = read_table(spark, folder, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority")
    parents = orders.select(
        F.col("o_orderkey").alias("match_id"), F.col("o_orderstatus").alias("status"), "o_orderpriority"
    )
    return fx.with_match_facts(lines, parents)


def copied_facts(spark, folder):
    """Facts in which events carry the facts of their match, counted by attribute and match."""
    matches = _match_rows(spark, folder).withColumn("entity_id", F.lit(-1).cast("bigint"))
    match_facts = fx.wide_to_facts(matches, {"league": "match/league", "score": "match/score"})
    both = match_facts.unionByName(_facts(spark, folder))
    copied = fx.copied_match_facts(both)
    return copied.groupBy("match_id", "attr").agg(
        F.count(F.lit(1)).alias("facts"), F.count_distinct("value").alias("texts")
    )


def fact_add_set(spark, folder):
    """Adding facts, half of which are known already."""
    customer = read_table(spark, folder, "customer", "c_custkey", "c_name", "c_mktsegment")
    known = customer.select(
        F.col("c_custkey").alias("entity_id"), F.lit("name").alias("attr"), F.col("c_name").alias("value")
    )
    more = customer.select(
        F.col("c_custkey").alias("entity_id"),
        F.lit("name").alias("attr"),
        F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).otherwise(F.col("c_mktsegment")).alias("value"),
    )
    return fx.add_facts(known, more)


def fact_cas(spark, folder):
    """Sets a value where it is still the expected one."""
    customer = read_table(spark, folder, "customer", "c_custkey", "c_mktsegment")
    facts = customer.select(F.col("c_custkey").alias("entity_id"), F.col("c_mktsegment").alias("value"))
    updates = customer.select(
        F.col("c_custkey").alias("entity_id"), F.lit("BUILDING").alias("expected"), F.lit("HOUSE").alias("new")
    )
    return fx.compare_and_set(facts, updates, ["entity_id"])


def fact_cas_chain(spark, folder):
    """The segment of a customer after all its orders, each of which changes one segment into another."""
    customer = read_table(spark, folder, "customer", "c_custkey", "c_mktsegment")
    orders = read_table(spark, folder, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    names = F.array(*[F.lit(name) for name in SEGMENTS])
    updates = orders.select(
        F.col("o_custkey").alias("entity_id"),
        "o_orderdate", "o_orderkey",
        F.get(names, (F.col("o_orderkey") % 6).cast("int")).alias("expected"),
        F.get(names, (F.substring("o_orderpriority", 1, 1).cast("int") * 7 + F.col("o_orderkey") % 11).cast("int") % 6).alias("new"),
    )
    facts = customer.select(F.col("c_custkey").alias("entity_id"), F.col("c_mktsegment").alias("value"))
    return changes.compare_and_set_in_order(facts, updates, ["entity_id"], ["o_orderdate", "o_orderkey"])


def fact_cas_repeats(spark, folder):
    """Several updates of one key at once: none multiplies a row."""
    customer = read_table(spark, folder, "customer", "c_custkey", "c_mktsegment")
    facts = customer.select(F.col("c_custkey").alias("entity_id"), F.col("c_mktsegment").alias("value"))
    orders = read_table(spark, folder, "orders", "o_custkey", "o_orderkey", "o_orderpriority")
    updates = orders.select(
        F.col("o_custkey").alias("entity_id"), F.get(F.array(*[F.lit(n) for n in SEGMENTS]), (F.col("o_orderkey") % 6).cast("int")).alias("expected"),
        F.col("o_orderpriority").alias("new"),
    )
    return fx.compare_and_set(facts, updates, ["entity_id"])


QUERIES = {
    f.__name__: f
    for f in (
        pattern_count, pattern_values, conjunctive_pattern, facts_melt, facts_pivot, fact_text_roundtrip,
        attribute_namespaces, qualified_ids, param_query, ref_traverse, multi_value, chained_query,
        first_answers, denormalise_parent, copied_facts, fact_add_set, fact_cas,
        fact_cas_chain, fact_cas_repeats, chained_three,
    )
}

_SCORE = "concat_ws(':', home_goals, away_goals)"

_FACTS = f"""{st.EVENTS_SQL}, facts AS (
  SELECT match_id, eid AS entity_id, 'event/type' AS attr, event_kind AS value FROM ev
  UNION ALL SELECT match_id, eid, 'event/minute', CAST(minute AS VARCHAR) FROM ev
  UNION ALL SELECT match_id, eid, 'event/team', team FROM ev WHERE team IS NOT NULL
  UNION ALL SELECT match_id, eid, 'event/player1', player1 FROM ev
  UNION ALL SELECT match_id, eid, 'event/player2', player2 FROM ev WHERE player2 IS NOT NULL)"""

_CHAIN = f"""{st.EVENTS_SQL}, s1 AS (SELECT match_id,
   arg_min(player1, (minute, eid)) AS value, count(*) > 1 AS ambiguous
   FROM ev WHERE event_kind = 'purchase' GROUP BY 1),
 s2 AS (SELECT e.match_id, arg_min(CAST(minute AS VARCHAR), (minute, eid)) AS value
   FROM ev e JOIN s1 ON s1.match_id = e.match_id AND s1.value = e.player1
   WHERE event_kind = 'error' GROUP BY 1)"""

_SEGMENTS = "[" + ", ".join(f"'{name}'" for name in SEGMENTS) + ", NULL]"

SQL = {
    "fact_cas_chain": f"""WITH RECURSIVE u AS (SELECT o_custkey AS entity_id,
          row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey, o_orderkey % 6) AS pos,
          {_SEGMENTS}[o_orderkey % 6 + 1] AS expected,
          {_SEGMENTS}[(CAST(o_orderpriority[1] AS INT) * 7 + o_orderkey % 11) % 6 + 1] AS new FROM orders),
        s AS (SELECT c_custkey AS entity_id, c_mktsegment AS value, CAST(0 AS BIGINT) AS changes, 0 AS pos FROM customer
          UNION ALL SELECT s.entity_id, CASE WHEN s.value IS NOT DISTINCT FROM u.expected THEN u.new ELSE s.value END,
            s.changes + CASE WHEN s.value IS NOT DISTINCT FROM u.expected THEN 1 ELSE 0 END, s.pos + 1
          FROM s JOIN u ON u.entity_id = s.entity_id AND u.pos = s.pos + 1)
        SELECT entity_id, value, changes FROM s QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY pos DESC) = 1""",
    "fact_cas_repeats": f"""WITH u AS (SELECT o_custkey, {_SEGMENTS}[o_orderkey % 6 + 1] AS expected, min(o_orderpriority) AS new
          FROM orders GROUP BY 1, 2)
        SELECT c_custkey AS entity_id, coalesce(new, c_mktsegment) AS value
        FROM customer LEFT JOIN u ON o_custkey = c_custkey AND expected = c_mktsegment""",
    "chained_three": f"""WITH {st.EVENTS_SQL},
        s1 AS (SELECT match_id, arg_min(player1, (minute, eid)) AS player1, arg_min(coalesce(team, ''), (minute, eid)) AS team
          FROM ev WHERE event_kind = 'purchase' GROUP BY 1),
        s2 AS (SELECT e.match_id, arg_min(CAST(minute AS VARCHAR), (minute, eid)) AS minute
          FROM ev e JOIN s1 ON s1.match_id = e.match_id AND s1.player1 = e.player1 AND s1.team = e.team
          WHERE event_kind = 'error' GROUP BY 1),
        s3 AS (SELECT e.match_id, min(eid) AS eid FROM ev e JOIN s2 ON s2.match_id = e.match_id AND s2.minute = CAST(e.minute AS VARCHAR)
          WHERE event_kind = 'click' GROUP BY 1)
        SELECT c_custkey AS match_id, CASE WHEN s3.eid IS NOT NULL THEN CAST(s3.eid AS VARCHAR)
            WHEN s2.minute IS NOT NULL THEN s2.minute || '|' || player1
            ELSE player1 || '|' || CASE WHEN team = '' THEN 'none' ELSE team END END AS value,
          CASE WHEN s3.eid IS NOT NULL THEN 3 WHEN s2.minute IS NOT NULL THEN 2 WHEN player1 IS NOT NULL THEN 1 ELSE 0 END AS step
        FROM customer LEFT JOIN s1 ON s1.match_id = c_custkey LEFT JOIN s2 ON s2.match_id = c_custkey LEFT JOIN s3 ON s3.match_id = c_custkey""",
    "pattern_count": f"""WITH {st.EVENTS_SQL} SELECT match_id, count(DISTINCT eid) AS n FROM ev
        WHERE event_kind = 'error' AND minute IS NOT NULL GROUP BY 1""",
    "conjunctive_pattern": f"""WITH {st.EVENTS_SQL} SELECT match_id, eid AS entity_id,
        player1 AS player, CAST(minute AS VARCHAR) AS minute FROM ev
        WHERE event_kind = 'click' AND team = 'home'""",
    "pattern_values": f"""WITH {st.EVENTS_SQL} SELECT match_id, eid AS entity_id,
        player1 AS player, CAST(minute AS VARCHAR) AS minute FROM ev
        WHERE event_kind = 'click' AND team = 'home'""",
    "facts_melt": f"WITH {_FACTS} SELECT * FROM facts",
    "facts_pivot": f"""WITH {st.EVENTS_SQL} SELECT match_id, eid AS entity_id, event_kind,
        CAST(minute AS VARCHAR) AS minute, team, player1, player2 FROM ev""",
    "fact_text_roundtrip": f"""WITH {_FACTS}, {st.MATCH_NUMBERS_SQL}, pos AS (
          SELECT eid, 2 + row_number() OVER (PARTITION BY match_id ORDER BY {st.ORDER_SQL}) AS entity_id
          FROM ev)
        SELECT match_id, pos.entity_id, attr, value FROM facts JOIN pos ON pos.eid = facts.entity_id
        UNION ALL SELECT match_id, 2, 'match/id', 'match_' || match_id FROM mn
        UNION ALL SELECT match_id, 2, 'match/league', league FROM mn
        UNION ALL SELECT match_id, 2, 'match/hometeam', hometeam FROM mn
        UNION ALL SELECT match_id, 2, 'match/score', {_SCORE} FROM mn""",
    "attribute_namespaces": f"""WITH {st.MATCH_NUMBERS_SQL},
        p AS (SELECT *, CASE WHEN match_id % 2 = 0 THEN 'match/' ELSE 'event/' END AS p FROM mn)
        SELECT match_id, CAST(2 AS BIGINT) AS entity_id, p || 'league' AS attr, league AS value FROM p
        UNION ALL SELECT match_id, 2, p || 'hometeam', hometeam FROM p
        UNION ALL SELECT match_id, 2, p || 'score', {_SCORE} FROM p WHERE match_id % 2 = 0""",
    "qualified_ids": """SELECT event_id AS eid, 'match_' || user_id AS match,
        'event_' || event_id AS event FROM events""",
    "param_query": f"""WITH {st.EVENTS_SQL} SELECT match_id, count(DISTINCT eid) AS n FROM ev
        WHERE player1 IN (SELECT 'Ana Maria P' || (p_partkey % 4) FROM part) GROUP BY 1""",
    "ref_traverse": """SELECT o_orderkey, n_name AS name FROM orders
        JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey""",
    "multi_value": """SELECT conv_id, turn, unnest(string_split(text, ' ')) AS name
        FROM conversations""",
    "chained_query": f"""WITH {_CHAIN} SELECT match_id, coalesce(s2.value, s1.value) AS value,
        s2.value AS strict_value FROM s1 LEFT JOIN s2 USING (match_id)""",
    "first_answers": f"WITH {_CHAIN} SELECT * FROM s1",
    "denormalise_parent": """SELECT l_orderkey AS match_id, l_partkey, l_quantity,
        CASE WHEN l_returnflag = 'N' THEN 'N' ELSE o_orderstatus END AS status, o_orderpriority
        FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey""",
    "copied_facts": f"""WITH {_FACTS}, {st.MATCH_NUMBERS_SQL},
        m AS (SELECT match_id, -1 AS entity_id, 'match/league' AS attr, league AS value FROM mn
          UNION ALL SELECT match_id, -1, 'match/score', {_SCORE} FROM mn),
        u AS (SELECT * FROM facts UNION ALL SELECT * FROM m
          UNION ALL SELECT m.match_id, eid, attr, m.value FROM m JOIN ev ON ev.match_id = m.match_id)
        SELECT match_id, attr, count(*) AS facts, count(DISTINCT value) AS texts FROM u GROUP BY 1, 2""",
    "fact_add_set": """SELECT c_custkey AS entity_id, 'name' AS attr, c_name AS value FROM customer
        UNION SELECT c_custkey, 'name', CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE c_mktsegment END
        FROM customer""",
    "fact_cas": """SELECT c_custkey AS entity_id,
        CASE WHEN c_mktsegment = 'BUILDING' THEN 'HOUSE' ELSE c_mktsegment END AS value FROM customer""",
}
