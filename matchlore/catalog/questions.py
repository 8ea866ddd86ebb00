"""Queries over questions: gate, selection, answers and negatives."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchlore.catalog import standins as st
from matchlore.functions.sampling import seed_hash
from matchlore.operators import export
from matchlore.operators import questions as qs
from matchlore.operators.ordered import OrderedGroups, hash_ranked
from matchlore.sources import questions_json
from matchlore.sources.tables import read_table


def length_gate(spark, folder):
    """Conversations and documents under one id, both long enough.

    The line limits are lower than those of the report job, as the texts are shorter.
    """
    documents = read_table(spark, folder, "documents", "doc_id", "text", spread=True)
    # The second text of a document: its words, one per line.
    words = documents.select("doc_id", F.replace("text", F.lit(" "), F.lit("\n")).alias("words"))
    gate = qs.long_enough(documents, "doc_id", min_lines=5)
    return gate.join(qs.long_enough(words, "doc_id", "words"), "doc_id", "left_semi")


def fact_exists_semi(spark, folder):
    """Matches that have events."""
    matches = st.match_numbers(spark, folder).select("match_id", "hometeam")
    return matches.join(st.match_events(spark, folder).select("match_id"), "match_id", "left_semi")


def _questions(spark, folder):
    """A question per event: how often its kind occurs for its player in its match."""
    events = st.match_events(spark, folder)
    kind, player = F.col("event_kind"), F.col("player1")
    return events.select(
        "match_id",
        "eid",
        F.col("event_kind").alias("rule"),
        F.when(F.col("eid") % 3 == 0, "-").otherwise("Counting").alias("category"),
        F.concat_ws(" ", F.lit("How many times"), kind, F.lit("by"), player, F.lit("?")).alias("question"),
        F.concat_ws("|", kind, player, F.coalesce("team", F.lit("none"))).alias("query"),
        "player1",
        "team",
    )


def _answers(spark, folder):
    """Results of all those queries on all matches in one grouping."""
    events = st.match_events(spark, folder)
    query = F.concat_ws("|", "event_kind", "player1", F.coalesce("team", F.lit("none")))
    return events.groupBy("match_id", query.alias("query")).agg(
        F.count_distinct("eid").cast("string").alias("answer")
    )


def answer_batch(spark, folder):
    """Every question put to its own match and to the next one."""
    asked = _questions(spark, folder).select("match_id", "eid", "query")
    shifted = asked.withColumn("match_id", F.col("match_id") + 1)
    both = asked.withColumn("own", F.lit(True)).unionByName(shifted.withColumn("own", F.lit(False)))
    return qs.answer_from(both, _answers(spark, folder), ["match_id", "query"])


def drop_empty(spark, folder):
    """Unanswered event questions go, unanswered match questions stay."""
    asked = _questions(spark, folder).select("match_id", "eid", "query")
    shifted = asked.withColumn("match_id", F.col("match_id") + 1).withColumn(
        "level", F.when(F.col("eid") % 2 == 0, "match").otherwise("event")
    )
    return qs.drop_empty_answers(qs.answer_from(shifted, _answers(spark, folder), ["match_id", "query"]))


def question_per_rule(spark, folder):
    asked = _questions(spark, folder).select("match_id", "rule", "eid", "question")
    drawn = asked.withColumn("draw", seed_hash(st.SEED, F.col("eid")))
    return qs.one_per_rule(drawn, ["draw", "eid"]).select("match_id", "rule", "eid", "question")


def question_cap(spark, folder):
    """At most 31 questions per match in shuffled order."""
    asked = _questions(spark, folder).select("match_id", "eid", "question")
    drawn = asked.withColumn("draw", seed_hash(st.SEED, F.col("eid")))
    return qs.capped(drawn, ["draw", "eid"]).drop("draw")


def category_default(spark, folder):
    asked = _questions(spark, folder)
    missing = F.when(F.col("eid") % 5 != 0, F.col("category"))
    return asked.select("eid", qs.category_named(missing).alias("category"))


def answerability(spark, folder):
    """Questions of the match before that have no result on the match."""
    asked = _questions(spark, folder).select("match_id", "eid", "query")
    shifted = asked.withColumn("match_id", F.col("match_id") + 1)
    return qs.unanswered(shifted, _answers(spark, folder), ["match_id", "query"])


def other_match_draw(spark, folder):
    asked = _questions(spark, folder).select("match_id", "eid")
    return qs.other_match_questions(asked, "match_id", "eid", st.SEED)


def _negatives(spark, folder, repeats):
    asked = _questions(spark, folder).select("match_id", "eid", "query")
    return qs.negatives(
        asked, _answers(spark, folder), "match_id", "eid", "query", st.SEED, allow_repeats=repeats
    )


def negatives(spark, folder):
    """n div 4 + 1 unanswerable questions per match, none twice."""
    return _negatives(spark, folder, False)


def negatives_with_repeats(spark, folder):
    return _negatives(spark, folder, True)


def negatives_by_match(spark, folder):
    """n div 4 + 1 unanswerable questions per match, drawn by match first."""
    asked = _questions(spark, folder).select("match_id", "eid", "query")
    return qs.negatives_by_match(asked, _answers(spark, folder), "match_id", "eid", "query", st.SEED)


def negatives_shortfall(spark, folder):
    """Matches that get fewer negatives than wanted where a question asks for a kind and a side only."""
    query = F.concat_ws("|", "event_kind", F.coalesce("team", F.lit("none")))
    asked = st.match_events(spark, folder).select("match_id", "eid", query.alias("query"))
    answered = asked.select("match_id", "query").distinct()
    drawn = qs.negatives(asked, answered, "match_id", "eid", "query", st.SEED)
    return qs.shortfall(asked, drawn, "match_id")


def question_union(spark, folder):
    """Answered questions and negatives as one set of records, counted."""
    asked = _questions(spark, folder)
    answered = qs.answer_from(asked, _answers(spark, folder), ["match_id", "query"])
    drawn = _negatives(spark, folder, False)
    source = asked.select("eid", "rule", "category", "question")
    records = qs.with_negatives(
        answered.select("match_id", "eid", "rule", "category", "question", "answer"),
        drawn.join(source, "eid").select("match_id", "eid", "rule", "category", "question"),
    )
    return records.groupBy("match_id", "category", "unanswerable").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("answer") == "").alias("empty")
    )


def shuffle_events(spark, folder):
    """Events of a match in seeded order."""
    events = st.match_events(spark, folder).select("match_id", "eid")
    drawn = events.withColumn("draw", seed_hash(st.SEED, F.col("eid")))
    return OrderedGroups(drawn, ["match_id"], [F.col("draw"), F.col("eid")]).number("pos").df.select(
        "match_id", "eid", F.col("pos").cast("bigint").alias("pos")
    )


def shuffle_documents(spark, folder):
    """All documents in one seeded order, ranked exactly."""
    documents = read_table(spark, folder, "documents", "doc_id")
    return hash_ranked(documents, ["doc_id"], st.SEED, "rank", "total")


def split_60_20_20(spark, folder):
    documents = read_table(spark, folder, "documents", "doc_id")
    return export.with_split(documents, "doc_id", st.SEED)


def question_jsonl(spark, folder):
    """Questions to JSON lines and back."""
    asked = _questions(spark, folder)
    fields = F.struct("category", "rule", "question", F.col("query").alias("datalog"), F.col("player1").alias("answer"))
    lines = asked.select("eid", F.to_json(fields).alias("line"))
    parsed = lines.select("eid", questions_json.question_of(F.col("line")).alias("q"))
    return parsed.select("eid", "q.category", "q.rule", "q.question", "q.datalog", "q.answer", "q.unanswerable")


def props_json(spark, folder):
    """The JSON column of the events parsed with a schema."""
    events = read_table(spark, folder, "events", "event_id", "props")
    return events.select("event_id", F.from_json("props", "k BIGINT")["k"].alias("k"))


QUERIES = {
    f.__name__: f
    for f in (
        length_gate, fact_exists_semi, answer_batch, drop_empty, question_per_rule, question_cap,
        category_default, answerability, other_match_draw, negatives, negatives_with_repeats,
        negatives_by_match, negatives_shortfall, question_union, shuffle_events, shuffle_documents, split_60_20_20, question_jsonl, props_json,
    )
}

_NO_TEAM = "coalesce(team, 'none')"
_ASKED = f"""{st.EVENTS_SQL}, q AS (SELECT match_id, eid, event_kind AS rule,
   CASE WHEN eid % 3 = 0 THEN '-' ELSE 'Counting' END AS category,
   'How many times ' || event_kind || ' by ' || player1 || ' ?' AS question,
   event_kind || '|' || player1 || '|' || {_NO_TEAM} AS query, player1, team FROM ev),
 a AS (SELECT match_id, query, CAST(count(DISTINCT eid) AS VARCHAR) AS answer FROM q GROUP BY 1, 2)"""

_HASH = "CAST('0x' || substr(md5('42:' || {}), 1, 15) AS BIGINT)"


def _groups(key: str) -> str:
    """Questions numbered so that those of a key are consecutive."""
    return f"""g0 AS (SELECT {key}, count(*) AS n FROM q GROUP BY 1),
 g AS (SELECT *, sum(n) OVER (ORDER BY md5('42:' || {key}), {key}) - n AS start,
   sum(n) OVER () AS total FROM g0),
 numbered AS (SELECT q.match_id, eid, query, CAST(start AS BIGINT)
   + row_number() OVER (PARTITION BY q.{key} ORDER BY eid) - 1 AS no FROM q JOIN g USING ({key}))"""


_SLOTS = """cnt AS (SELECT match_id, count(*) AS n FROM q GROUP BY 1),
 slots AS (SELECT match_id, n, unnest(range(n // 4 + 1)) AS slot FROM cnt)"""

# Brute force: what a match may be asked is listed in full and drawn from by rank.
_NEGATIVES = f"""{_ASKED}, {_groups('query')}, {_SLOTS},
 free AS (SELECT c.match_id, o.eid, o.query,
   row_number() OVER (PARTITION BY c.match_id ORDER BY o.no) - 1 AS r,
   count(*) OVER (PARTITION BY c.match_id) AS free
   FROM cnt c JOIN numbered o ON o.match_id <> c.match_id
   ANTI JOIN a ON a.match_id = c.match_id AND a.query = o.query),
 sizes AS (SELECT DISTINCT match_id, free FROM free),
 drawn AS ({{drawn}})
 SELECT d.match_id, d.slot, f.eid, f.query FROM drawn d JOIN free f ON f.match_id = d.match_id AND f.r = d.at"""
_DRAW = _HASH.format("match_id || ':' || slot")
_DISTINCT = f"""SELECT match_id, slot, slot * (free // wanted) + least(slot, free % wanted)
     + {_DRAW} % (free // wanted + CASE WHEN slot < free % wanted THEN 1 ELSE 0 END) AS at
   FROM (SELECT match_id, slot, free, least(n // 4 + 1, free) AS wanted FROM slots JOIN sizes USING (match_id))
   WHERE slot < wanted"""
_REPEATS = f"SELECT match_id, slot, {_DRAW} % free AS at FROM slots JOIN sizes USING (match_id)"
_NEGATIVES_SQL = "WITH " + _NEGATIVES.format(drawn=_DISTINCT)

SQL = {
    # Brute force: all that a match may be asked, each with its weight.
    "negatives_by_match": f"""WITH {_ASKED}, {_SLOTS},
        w AS (SELECT q.match_id, eid, query, 1073741824 // n AS width FROM q JOIN cnt USING (match_id)),
        free AS (SELECT c.match_id, o.eid, o.query, width, CAST(sum(width) OVER (PARTITION BY c.match_id
            ORDER BY md5('42:' || o.query), o.query, o.eid ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
          FROM cnt c JOIN w o ON o.match_id <> c.match_id ANTI JOIN a ON a.match_id = c.match_id AND a.query = o.query),
        drawn AS (SELECT match_id, slot, """ + _DRAW + """ % free AS at
          FROM slots JOIN (SELECT match_id, max(upto) AS free FROM free GROUP BY 1) USING (match_id))
        SELECT d.match_id, d.slot, f.eid, f.query FROM drawn d
        JOIN free f ON f.match_id = d.match_id AND f.upto - f.width <= d.at AND d.at < f.upto""",
    "negatives_shortfall": f"""WITH {st.EVENTS_SQL}, q AS (SELECT match_id, event_kind || '|' || coalesce(team, 'none') AS query FROM ev),
        t AS (SELECT query, count(*) AS n FROM q GROUP BY 1), m AS (SELECT match_id, count(*) AS n FROM q GROUP BY 1),
        b AS (SELECT match_id, sum(t.n) AS blocked FROM (SELECT DISTINCT match_id, query FROM q) JOIN t USING (query) GROUP BY 1),
        f AS (SELECT match_id, m.n // 4 + 1 AS wanted, CAST((SELECT count(*) FROM q) - blocked AS BIGINT) AS free FROM m JOIN b USING (match_id))
        SELECT match_id, wanted, wanted - least(wanted, free) AS missing FROM f WHERE free < wanted""",
    "length_gate": f"""SELECT doc_id FROM documents
        WHERE len([x FOR x IN string_split(text, chr(10)) IF {st.strip_sql('x')} <> '']) >= 5
        AND len([x FOR x IN string_split(replace(text, ' ', chr(10)), chr(10))
                 IF {st.strip_sql('x')} <> '']) >= 50""",
    "fact_exists_semi": """SELECT c_custkey AS match_id, c_name AS hometeam FROM customer
        WHERE c_custkey IN (SELECT user_id FROM events)""",
    "answer_batch": f"""WITH {_ASKED}, b AS (SELECT match_id, eid, query, true AS own FROM q
          UNION ALL SELECT match_id + 1, eid, query, false FROM q)
        SELECT b.*, coalesce(answer, '') AS answer FROM b LEFT JOIN a USING (match_id, query)""",
    "drop_empty": f"""WITH {_ASKED}, b AS (SELECT match_id + 1 AS match_id, eid, query,
          CASE WHEN eid % 2 = 0 THEN 'match' ELSE 'event' END AS level FROM q)
        SELECT b.*, coalesce(answer, '') AS answer FROM b LEFT JOIN a USING (match_id, query)
        WHERE level = 'match' OR answer IS NOT NULL""",
    "question_per_rule": f"""WITH {_ASKED}, r AS (SELECT *, row_number() OVER (
          PARTITION BY match_id, rule ORDER BY md5('42:' || eid), eid) AS r FROM q)
        SELECT match_id, rule, eid, question FROM r WHERE r = 1""",
    "question_cap": f"""WITH {_ASKED}, r AS (SELECT *, row_number() OVER (
          PARTITION BY match_id ORDER BY md5('42:' || eid), eid) AS r FROM q)
        SELECT match_id, eid, question FROM r WHERE r <= 31""",
    "category_default": """SELECT event_id AS eid, CASE WHEN event_id % 5 = 0 THEN NULL
        WHEN event_id % 3 = 0 THEN 'Simple' ELSE 'Counting' END AS category FROM events""",
    "answerability": f"""WITH {_ASKED}, b AS (SELECT match_id + 1 AS match_id, eid, query FROM q)
        SELECT b.* FROM b ANTI JOIN a USING (match_id, query)""",
    "other_match_draw": f"""WITH {_ASKED}, {_groups('match_id')}, {_SLOTS},
        d AS (SELECT s.match_id, slot, {_HASH.format("s.match_id || ':' || slot")} % CAST(total - s.n AS BIGINT) AS draw,
          CAST(start AS BIGINT) AS start, s.n FROM slots s JOIN g USING (match_id) WHERE total > s.n)
        SELECT d.match_id, slot, eid FROM d
        JOIN numbered ON no = draw + CASE WHEN draw >= start THEN n ELSE 0 END""",
    "negatives": _NEGATIVES_SQL,
    "negatives_with_repeats": "WITH " + _NEGATIVES.format(drawn=_REPEATS),
    "question_union": f"""WITH neg AS ({_NEGATIVES_SQL}), {_ASKED},
        u AS (SELECT match_id, category, false AS unanswerable, answer FROM q JOIN a USING (match_id, query)
          UNION ALL SELECT neg.match_id, category, true, '' FROM neg JOIN q USING (eid))
        SELECT match_id, CASE WHEN category = '-' THEN 'Simple' ELSE category END AS category, unanswerable,
          count(*) AS n, count(*) FILTER (answer = '') AS empty FROM u GROUP BY 1, 2, 3""",
    "shuffle_events": """SELECT user_id AS match_id, event_id AS eid, row_number() OVER (
        PARTITION BY user_id ORDER BY md5('42:' || event_id), event_id) AS pos FROM events""",
    "shuffle_documents": """SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1
        AS rank, count(*) OVER () AS total FROM documents""",
    "split_60_20_20": """WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1
          AS r, count(*) OVER () AS n FROM documents),
        t AS (SELECT *, floor(n * 0.6::DOUBLE) AS a, floor(n * 0.2::DOUBLE) AS b FROM r)
        SELECT doc_id, CASE WHEN a = 0 OR r < a THEN 'train' WHEN b = 0 OR r < a + b THEN 'dev'
          ELSE 'test' END AS split FROM t""",
    "question_jsonl": f"""WITH {_ASKED} SELECT eid, category, rule, question, query AS datalog,
        player1 AS answer, CAST(NULL AS BOOLEAN) AS unanswerable FROM q""",
    "props_json": """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""",
}
