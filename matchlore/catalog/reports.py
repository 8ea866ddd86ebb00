"""Queries over rules, reports and text statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchlore.catalog import standins as st
from matchlore.functions import text as tx
from matchlore.operators import reports, stats
from matchlore.operators import rules as rl
from matchlore.operators import sections
from matchlore.sources.tables import read_table

# A rule list of our own: conditions and bodies are SQL both engines read.
RULES = (
    rl.Rule("textrep", "textrep", "T1", "event_kind = 'purchase' AND team = 'home'",
            "concat(player1, ' buys for the home side')"),
    rl.Rule("textrep", "textrep", "T2", "event_kind = 'purchase'", "concat(player1, ' buys')"),
    rl.Rule("textrep", "textrep", "T3", "player2 IS NOT NULL",
            "concat('  ', player1, ' and ', player2, ': ', event_kind, ' ')"),
    rl.Rule("textrep", "textrep", "T4", "event_kind <> 'signup'", "concat(player1, ' does ', event_kind)"),
    rl.Rule("textrep", "textrep", "T5", "team IS NOT NULL", "concat('A ', event_kind, ' for ', team)"),
)
QUESTION_RULES = (
    rl.Rule("questions", "text", "Q1", "event_kind = 'error'",
            "concat('  Who met the error?', chr(10), ' Which player met an error ? ')",
            "player", "text"),
    rl.Rule("questions", "datalog", "Q1", "event_kind = 'error'", "'player of error'"),
    rl.Rule("questions", "text", "Q2", "team IS NOT NULL",
            "concat('When did ', team, ' ', event_kind, '?', chr(10), 'Minute of ', event_kind, '?')",
            "minute", "minute"),
    rl.Rule("questions", "datalog", "Q2", "team IS NOT NULL", "'minute of kind and team'"),
    rl.Rule("questions", "text", "Q3", "true", "concat('How many times ', event_kind, '?')", "-", "numeric"),
    rl.Rule("questions", "datalog", "Q3", "true", "'count of kind'"),
)


def rule_render(spark, folder):
    """The first fitting rule of each event."""
    events = st.match_events(spark, folder)
    rendered = rl.with_text(rl.render(events, RULES))
    return rendered.select("eid", F.col("rule.rule_id").alias("rule_id"), "text")


def rule_sampling(spark, folder):
    """One fitting rule per event, drawn by seed."""
    events = st.match_events(spark, folder)
    rendered = rl.with_text(rl.render(events, RULES, ["eid"], st.SEED))
    return rendered.select("eid", F.col("rule.rule_id").alias("rule_id"), "text")


def rule_variant(spark, folder):
    """One line of a multi-line question text, each line stripped."""
    events = st.match_events(spark, folder)
    asked = rl.with_text(rl.render(events, rl.for_target(QUESTION_RULES, "text"), ["eid"], st.SEED))
    return asked.select(
        "eid", F.col("rule.rule_id").alias("rule_id"), rl.variant(F.col("text"), st.SEED, F.col("eid")).alias("question")
    )


def rule_pair(spark, folder):
    """Asking rules with their answering partner, joined to the events they apply to."""
    pairs = rl.paired_rules(rl.rule_table(spark, QUESTION_RULES))
    events = st.match_events(spark, folder)
    asked = rl.render(events, rl.for_target(QUESTION_RULES, "text"), ["eid"], st.SEED)
    return asked.select("eid", F.col("rule.rule_id").alias("rule_id")).join(
        pairs.select("rule_id", "category", "answertype"), "rule_id"
    )


def rule_counts(spark, folder):
    """Rules per ruleset with the events their rulesets apply to."""
    counts = rl.rules_per_ruleset(rl.rule_table(spark, (*RULES, *QUESTION_RULES)))
    events = st.match_events(spark, folder)
    fitting = events.select(
        F.size(rl.applicable(RULES)).alias("textrep"),
        F.size(rl.applicable(QUESTION_RULES)).alias("questions"),
    )
    used = fitting.agg(
        F.sum("textrep").alias("textrep"), F.sum("questions").alias("questions")
    ).unpivot([], ["textrep", "questions"], "ruleset", "uses")
    return counts.join(used, "ruleset")


def _lines(spark, folder):
    return reports.report_lines(
        st.match_events(spark, folder, spread=True),
        RULES,
        st.SEED,
        order=[F.col("minute"), F.coalesce("sortorder", F.lit(0)), F.col("event_id")],
        keys=("eid",),
    )


def report_lines(spark, folder):
    return _lines(spark, folder)


def report_text(spark, folder):
    """Whole reports: header, blank line and event lines."""
    headers = st.match_numbers(spark, folder).select(
        "match_id", F.concat_ws(" vs. ", "hometeam", "awayteam").alias("header")
    )
    lines = reports.with_header(_lines(spark, folder), headers)
    return reports.joined_lines(lines)


def event_dump(spark, folder):
    events = st.match_events(spark, folder)
    names = ("sortorder", "event_id", "del")
    rest = F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).cast("string").alias("value")) for n in names])
    return events.select(
        "eid",
        reports.event_dump(
            F.col("event_kind"), F.col("minute"), F.col("team"), F.col("player1"), F.col("player2"), rest
        ).alias("dump"),
    )


def minute_lines(spark, folder):
    events = st.match_events(spark, folder)
    return events.select(
        "eid", tx.minute_line(F.col("minute"), F.concat(F.lit("  "), F.col("player1"), F.lit(" \n"))).alias("line")
    )


def strip_lines(spark, folder):
    documents = read_table(spark, folder, "documents", "doc_id", "text")
    return documents.select("doc_id", tx.strip_each_line(F.col("text")).alias("text"))


def incremental_skip(spark, folder):
    documents = read_table(spark, folder, "documents", "doc_id", "lang")
    return reports.unfinished(documents, read_table(spark, folder, "labels", "doc_id"), ["doc_id"])


def batch_cap(spark, folder):
    """The next 500 documents without a label: the cap is the feature."""
    documents = read_table(spark, folder, "documents", "doc_id", "lang")
    return reports.next_batch(documents, read_table(spark, folder, "labels", "doc_id"), "doc_id")


def _documents(spark, folder):
    return read_table(spark, folder, "documents", "doc_id", "text", spread=True)


def text_lines(spark, folder):
    lines = sections.numbered_lines(_documents(spark, folder), "doc_id", "text", keep_blank=False)
    return lines.withColumn("line_no", F.col("line_no").cast("bigint"))


def line_hist(spark, folder):
    return stats.line_histogram(_documents(spark, folder))


def token_hist(spark, folder):
    return stats.token_histogram(_documents(spark, folder))


def unique_token_hist(spark, folder):
    return stats.unique_token_histogram(_documents(spark, folder))


def term_freq(spark, folder):
    return stats.term_frequency(_documents(spark, folder))


def term_freq_topn(spark, folder):
    return stats.top_and_rest(stats.term_frequency(_documents(spark, folder)), "term")


def token_hist_topn(spark, folder):
    return stats.top_and_rest(stats.token_histogram(_documents(spark, folder)), "tokens")


QUERIES = {
    f.__name__: f
    for f in (
        rule_render, rule_sampling, rule_variant, rule_pair, rule_counts, report_lines, report_text,
        event_dump, minute_lines, strip_lines, incremental_skip, batch_cap, text_lines, line_hist,
        token_hist, unique_token_hist, term_freq, term_freq_topn, token_hist_topn,
    )
}


def _offers(rules) -> str:
    """Every (event, fitting rule) with its text, as rows."""
    return " UNION ALL ".join(
        f"SELECT eid, {no} AS no, '{r.rule_id}' AS rule_id, {r.body} AS body FROM ev WHERE {r.condition}"
        for no, r in enumerate(rules)
    )


_STRIP = st.strip_sql("{}")
_STRIP_EACH = f"array_to_string([{st.strip_sql('x')} FOR x IN string_split({{}}, chr(10))], chr(10))"


def _chosen(rules, order: str) -> str:
    return f"""{st.EVENTS_SQL}, offers AS ({_offers(rules)}),
 chosen AS (SELECT eid, arg_min(rule_id, {order}) AS rule_id, arg_min(body, {order}) AS body
   FROM offers GROUP BY eid)"""


_DRAW = "md5(md5('42:' || eid) || ':' || rule_id)"
_TEXT_RULES = rl.for_target(QUESTION_RULES, "text")
_CLEAN = _STRIP_EACH.format(_STRIP.format("body"))

_LINES = f"""{_chosen(RULES, _DRAW)},
 l0 AS (SELECT ev.match_id, ev.eid, minute, minute || ': ' || {_STRIP.format('body')} AS line,
   row_number() OVER (PARTITION BY match_id ORDER BY {st.ORDER_SQL}) AS pos
   FROM ev JOIN chosen USING (eid)),
 l1 AS (SELECT *, lag(line) OVER (PARTITION BY match_id ORDER BY pos) AS before FROM l0),
 lines AS (SELECT match_id, minute, line, row_number() OVER (PARTITION BY match_id ORDER BY pos) AS line_no
   FROM l1 WHERE line IS DISTINCT FROM before)"""

_WORDS = rf"""tok AS (SELECT doc_id, [x FOR x IN
   [{st.strip_sql('w')} FOR w IN string_split(replace(regexp_replace(
     lower(text), '[0-9.\-:;!@#$%^&*(){{}}]', '', 'g'), chr(10), ' '), ' ')] IF x <> ''] AS words
   FROM documents)"""
_TERMS = f"{_WORDS}, terms AS (SELECT term, count(*) AS n FROM (SELECT unnest(words) AS term FROM tok) GROUP BY 1)"


def _top(counts: str, key: str) -> str:
    return f"""ranked AS (SELECT *, row_number() OVER (ORDER BY n DESC, {key}) AS r
       FROM (SELECT CAST({key} AS VARCHAR) AS {key}, n FROM {counts}))
     SELECT {key}, n, false AS is_rest FROM ranked WHERE r <= 10
     UNION ALL SELECT NULL, CAST(coalesce(sum(n), 0) AS BIGINT), true FROM ranked WHERE r > 10"""


SQL = {
    "rule_render": f"""WITH {_chosen(RULES, 'no')} SELECT eid, rule_id, {_CLEAN} AS text
        FROM ev LEFT JOIN chosen USING (eid)""",
    "rule_sampling": f"""WITH {_chosen(RULES, _DRAW)} SELECT eid, rule_id, {_CLEAN} AS text
        FROM ev LEFT JOIN chosen USING (eid)""",
    "rule_variant": f"""WITH {_chosen(_TEXT_RULES, _DRAW)}, v AS (SELECT eid, rule_id,
          string_split({_CLEAN}, chr(10)) AS items FROM chosen)
        SELECT eid, rule_id, items[CAST('0x' || substr(md5('42:' || eid), 1, 15) AS BIGINT) % len(items) + 1]
          AS question FROM v""",
    "rule_pair": f"""WITH {_chosen(_TEXT_RULES, _DRAW)},
        r AS (SELECT * FROM (VALUES ('Q1', 'player', 'text'), ('Q2', 'minute', 'minute'),
          ('Q3', '-', 'numeric')) r(rule_id, category, answertype))
        SELECT rule_id, eid, category, answertype FROM chosen JOIN r USING (rule_id)""",
    "rule_counts": f"""WITH {st.EVENTS_SQL}, a AS ({_offers(RULES)}), b AS ({_offers(QUESTION_RULES)})
        SELECT 'textrep' AS ruleset, CAST({len(RULES)} AS BIGINT) AS rules, count(*) AS uses FROM a
        UNION ALL SELECT 'questions', {len(QUESTION_RULES)}, count(*) FROM b""",
    "report_lines": f"WITH {_LINES} SELECT * FROM lines",
    "report_text": f"""WITH {_LINES}, {st.MATCH_NUMBERS_SQL},
        u AS (SELECT match_id, line_no, line FROM lines
          UNION ALL SELECT match_id, -1, hometeam || ' vs. ' || awayteam FROM mn
          UNION ALL SELECT match_id, 0, '' FROM mn)
        SELECT match_id, string_agg(line, chr(10) ORDER BY line_no) AS context
        FROM u GROUP BY 1""",
    "event_dump": f"""WITH {st.EVENTS_SQL} SELECT eid, 'Event ' || event_kind || ' @ minute ' || minute
        || ' (team: ' || coalesce(team, 'None') || ')' || chr(10)
        || chr(9) || player1 || ' => ' || coalesce(player2, 'None') || chr(10)
        || chr(9) || concat_ws(', ', 'sortorder: ' || sortorder, 'event_id: ' || event_id, 'del: ' || del)
        AS dump FROM ev""",
    "minute_lines": f"WITH {st.EVENTS_SQL} SELECT eid, minute || ': ' || player1 AS line FROM ev",
    "strip_lines": f"SELECT doc_id, {_STRIP_EACH.format('text')} AS text FROM documents",
    "incremental_skip": """SELECT doc_id, lang FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "batch_cap": """SELECT doc_id, lang FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY doc_id LIMIT 500""",
    "text_lines": f"""WITH p AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
        l AS (SELECT doc_id, unnest(range(len(parts))) AS line_no, unnest(parts) AS raw FROM p),
        c AS (SELECT doc_id, line_no, {_STRIP.format('raw')} AS line FROM l)
        SELECT * FROM c WHERE line <> ''""",
    "line_hist": f"""WITH l AS (SELECT len([x FOR x IN string_split(text, chr(10))
          IF {st.strip_sql('x')} <> '']) AS lines FROM documents)
        SELECT lines, count(*) AS n FROM l GROUP BY 1""",
    "token_hist": f"WITH {_WORDS} SELECT len(words) AS tokens, count(*) AS n FROM tok GROUP BY 1",
    "unique_token_hist": f"""WITH {_WORDS}
        SELECT len(list_distinct(words)) AS tokens, count(*) AS n FROM tok GROUP BY 1""",
    "term_freq": f"WITH {_TERMS} SELECT * FROM terms",
    "term_freq_topn": f"WITH {_TERMS}, {_top('terms', 'term')}",
    "token_hist_topn": f"""WITH {_WORDS},
        h AS (SELECT len(words) AS tokens, count(*) AS n FROM tok GROUP BY 1), {_top('h', 'tokens')}""",
}
