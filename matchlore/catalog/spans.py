"""Queries that locate answers in texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchlore.catalog import reports as rp
from matchlore.catalog import standins as st
from matchlore.functions import text as tx
from matchlore.operators import reports, sections, spans
from matchlore.sources.tables import read_table


def reports_of(spark, folder):
    headers = st.match_numbers(spark, folder).select(
        "match_id", F.concat_ws(" vs. ", "hometeam", "awayteam").alias("header")
    )
    return reports.joined_lines(reports.with_header(rp.report_lines(spark, folder), headers))


def _flat(rows, *keys):
    return rows.select(*keys, "text", F.col("answer_start").cast("bigint").alias("answer_start"))


def _exploded(pairs, *keys):
    return _flat(spans.span_rows(pairs, keys), *keys)


def _minute_pairs(spark, folder):
    """Asks for the minute of every event; some answers are empty or no minute of the report."""
    minute = F.col("minute").cast("string")
    answer = (
        F.when(F.col("eid") % 20 == 0, "")
        .when(F.col("eid") % 20 == 1, F.concat(minute, F.lit("5")))
        .when(F.col("eid") % 20 == 2, F.concat(F.lit("'"), minute, F.lit("'")))
        .otherwise(minute)
    )
    events = st.match_events(spark, folder, spread=True).select("match_id", "eid", answer.alias("answer"))
    return events.join(reports_of(spark, folder), "match_id").withColumn("answertype", F.lit("minute"))


def span_minute(spark, folder):
    found = spans.with_spans(_minute_pairs(spark, folder), minute=None)
    return _exploded(found, "match_id", "eid")


def span_reasons(spark, folder):
    """Why minute pairs have no span, counted."""
    found = spans.with_spans(_minute_pairs(spark, folder), minute=None)
    return found.groupBy(F.coalesce("reason", F.lit("added")).alias("status")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _player_pairs(spark, folder):
    """Asks for the player of every event from its minute on."""
    key = F.col("eid")
    answer = (
        F.when(key % 6 == 0, F.concat(F.lit("Max "), F.substring_index("player1", " ", -1)))
        .when(key % 6 == 1, F.concat(F.lit("'"), F.col("player1"), F.lit("'")))
        .when(key % 6 == 2, F.col("player2"))
        .when(key % 6 == 3, F.lit("Nobody Anywhere"))
        .otherwise(F.col("player1"))
    )
    query = F.when(key % 4 == 0, "[?e :event/team ?t] [?e :event/player1 ?p]").otherwise(
        "[?e :event/player1 ?p]"
    )
    events = st.match_events(spark, folder, spread=True).select(
        "match_id", "eid", answer.alias("answer"), F.col("minute").cast("string").alias("minute"),
        query.alias("datalog"),
    )
    return events.join(reports_of(spark, folder), "match_id").withColumn("answertype", F.lit("text"))


def span_anchor(spark, folder):
    """From the minute's line on, with the surname as a second answer."""
    return _exploded(spans.with_spans(_player_pairs(spark, folder)), "match_id", "eid")


def _document_pairs(spark, folder):
    """Two questions per document: one whose answer is in the text, one of which only the last word is."""
    documents = read_table(spark, folder, "documents", "doc_id", "text", spread=True)
    words = F.split("text", " ")
    start = F.pmod("doc_id", F.lit(3)).cast("int") + 2
    phrase = F.array_join(F.slice(words, start, 2), " ")
    word = F.coalesce(F.get(words, F.lit(4)), F.lit("none"))
    both = F.array(
        F.struct(F.lit("phrase").alias("kind"), phrase.alias("answer")),
        F.struct(F.lit("word").alias("kind"), F.concat(F.lit("no such "), word).alias("answer")),
    )
    pairs = documents.select("doc_id", F.col("text").alias("context"), F.explode(both).alias("p"))
    return pairs.select("doc_id", "context", "p.kind", "p.answer").withColumn("answertype", F.lit("text"))


def span_first(spark, folder):
    found = spans.with_spans(_document_pairs(spark, folder), minute=None)
    return _exploded(found, "doc_id", "kind")


def span_all(spark, folder):
    """Every occurrence of the last word, overlapping ones included, over whole texts."""
    found = spans.with_spans(_document_pairs(spark, folder), minute=None)
    return _flat(spans.last_word_spans(found, ["doc_id", "kind"]), "doc_id", "kind")


def answer_contained(spark, folder):
    """Turns found in their own conversation, or in the one after it."""
    talks = read_table(spark, folder, "conversations", "conv_id", "turn", "role", "text")
    lines = talks.select(
        "conv_id", F.col("turn").alias("line_no"), tx.minute_line(F.col("turn"), F.col("text")).alias("line")
    )
    contexts = reports.joined_lines(lines, "conv_id")
    own = talks.select("conv_id", F.lit(True).alias("own"), "turn", F.col("text").alias("answer"))
    later = own.withColumn("conv_id", F.col("conv_id") + 1).withColumn("own", F.lit(False))
    pairs = own.unionByName(later).join(contexts, "conv_id")
    return spans.contained(pairs).select("conv_id", "own", "turn", "answer")


def unquote_answers(spark, folder):
    customer = read_table(spark, folder, "customer", "c_custkey", "c_name")
    name, key = F.col("c_name"), F.col("c_custkey")
    quoted = (
        F.when(key % 5 == 0, F.concat(F.lit("'"), name, F.lit("'")))
        .when(key % 5 == 1, F.concat(F.lit("\"'"), name, F.lit("'\"")))
        .when(key % 5 == 2, F.concat(F.lit("'O\\'"), name, F.lit("\"")))
        .when(key % 5 == 3, F.concat(F.lit("''''"), name))
        .otherwise(name)
    )
    return customer.select("c_custkey", quoted.alias("raw"), tx.unquote(quoted).alias("answer"))


def _numeric_answers(spark, folder):
    """Order counts of each customer, by status for one half and by priority for the other."""
    orders = read_table(spark, folder, "orders", "o_custkey", "o_orderstatus", "o_orderpriority")
    part = F.when(F.col("o_custkey") % 2 == 0, F.col("o_orderstatus")).otherwise(F.col("o_orderpriority"))
    return orders.groupBy(F.col("o_custkey").alias("doc"), part.alias("rule")).agg(
        F.count(F.lit(1)).alias("value")
    )


def numeric_choices(spark, folder):
    """Choices per customer: answers with copies, distractors, and their place in the line."""
    return spans.numeric_choices(_numeric_answers(spark, folder), "doc", st.SEED)


def numeric_line(spark, folder):
    choices = spans.numeric_choices(_numeric_answers(spark, folder), "doc", st.SEED)
    return spans.choice_line(choices, "doc")


def span_numeric(spark, folder):
    """Starts of numeric answers behind a context as long as the customer key."""
    numeric = _numeric_answers(spark, folder).withColumn("context_length", F.col("doc"))
    choices = spans.numeric_choices(numeric, "doc", st.SEED)
    return spans.numeric_spans(numeric, choices, "doc").select("doc", "rule", "value", "answer_start")


def unwrap_result(spark, folder):
    customer = read_table(spark, folder, "customer", "c_custkey", "c_name")
    name, key = F.col("c_name"), F.col("c_custkey")
    raw = (
        F.when(key % 4 == 0, F.concat(F.lit(" [ "), name, F.lit(" ]\n")))
        .when(key % 4 == 1, F.concat(F.lit("[["), name, F.lit("]]")))
        .when(key % 4 == 2, F.concat(F.lit("["), name))
        .otherwise(F.lit("[ ]"))
    )
    return customer.select("c_custkey", tx.unwrap_result(raw).alias("result"))


def _marked_texts(spark, folder):
    """Documents whose lines begin a section, are comments or plain, by their first letter."""
    documents = read_table(spark, folder, "documents", "doc_id", "text", spread=True)
    line = F.split("text", "\n")
    marked = F.transform(
        line,
        lambda x: F.when(x.startswith("A"), F.concat(F.lit(" ;;# "), x))
        .when(x.startswith("I"), F.concat(F.lit(";; "), x))
        .otherwise(x),
    )
    return documents.select("doc_id", F.array_join(marked, "\n").alias("text"))


def _labelled(spark, folder):
    texts = _marked_texts(spark, folder)
    lines = sections.numbered_lines(texts, "doc_id", "text")
    # marking adds no line feeds, so the given texts tell how many lines there are
    longest = sections.most_lines(read_table(spark, folder, "documents", "text"), "text")
    return sections.labelled_lines(lines, "doc_id", largest=longest)


def section_label(spark, folder):
    labelled = _labelled(spark, folder)
    return labelled.withColumn("line_no", F.col("line_no").cast("bigint"))


def section_text(spark, folder):
    return sections.section_texts(_labelled(spark, folder), "doc_id")


def trace_records(spark, folder):
    """Events as a log: a view opens a query, clicks give arguments, purchases results."""
    events = read_table(spark, folder, "events", "event_id", "ts", "user_id", "event_type")
    key = F.col("event_id").cast("string")
    kind = F.col("event_type")
    line = (
        F.when(kind == "view", F.concat(F.lit(' IM_QUERY:"[:find '), key, F.lit(']"')))
        .when(kind == "click", F.concat(F.lit("IM_ARGS:[\"a\", "), key, F.lit("]")))
        .when(kind == "purchase", F.concat(F.lit("IM_RESULT:[["), key, F.lit("]]")))
        .otherwise(F.concat(F.lit("other "), key))
    )
    lines = events.select("user_id", "ts", "event_id", line.alias("line"))
    records = sections.trace_records(lines, "user_id", ["ts", "event_id"])
    return records.withColumn("args", F.array_join("args", ","))


QUERIES = {
    f.__name__: f
    for f in (
        span_minute, span_reasons, span_anchor, span_first, span_all, answer_contained,
        unquote_answers, numeric_choices, numeric_line, span_numeric, unwrap_result, section_label,
        section_text, trace_records,
    )
}

_REPORTS = f"""{rp._LINES}, {st.MATCH_NUMBERS_SQL},
 u AS (SELECT match_id, line_no, line FROM lines
   UNION ALL SELECT match_id, -1, hometeam || ' vs. ' || awayteam FROM mn
   UNION ALL SELECT match_id, 0, '' FROM mn),
 rep AS (SELECT match_id, string_agg(line, chr(10) ORDER BY line_no) AS context FROM u GROUP BY 1)"""

_MINUTES = f"""{_REPORTS}, p AS (SELECT match_id, eid, context, CASE WHEN eid % 20 = 0 THEN ''
     WHEN eid % 20 = 1 THEN minute || '5' ELSE CAST(minute AS VARCHAR) END AS answer
   FROM ev JOIN rep USING (match_id)),
 f AS (SELECT *, strpos(context, chr(10) || answer || ': ') AS i FROM p)"""

_UNQUOTED = "{}"
for _ in range(2):
    for _edge in ("^''", "''$", '^"', '"$'):
        _UNQUOTED = f"regexp_replace({_UNQUOTED}, '{_edge}', '')"
_UNQUOTED = f"replace({_UNQUOTED}, '\\''', '''')"

_PAIRS = """p AS (SELECT doc_id, text AS context, 'phrase' AS kind,
     array_to_string(string_split(text, ' ')[doc_id % 3 + 2 : doc_id % 3 + 3], ' ') AS answer FROM documents
   UNION ALL SELECT doc_id, text, 'word', 'no such ' || coalesce(string_split(text, ' ')[5], 'none')
   FROM documents)"""

_CHOICES = """n AS (SELECT o_custkey AS doc,
     CASE WHEN o_custkey % 2 = 0 THEN o_orderstatus ELSE o_orderpriority END AS rule, count(*) AS value
   FROM orders GROUP BY 1, 2),
 t AS (SELECT doc, count(*) AS answers FROM n GROUP BY 1),
 c AS (SELECT doc, v.value, row_number() OVER (PARTITION BY doc ORDER BY md5('42:' || doc || ':' || v.value), v.value) AS r,
     answers FROM t CROSS JOIN (SELECT unnest(range(101)) AS value) v
   WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.doc = t.doc AND n.value = v.value)),
 k AS (SELECT doc, value, count(*) AS copies, true AS is_answer FROM n GROUP BY 1, 2
   UNION ALL SELECT doc, value, 1, false FROM c WHERE r <= 5 - answers),
 choices AS (SELECT *, CAST(sum(copies * (length('NUM' || value) + 1)) OVER (PARTITION BY doc ORDER BY value)
   - copies * (length('NUM' || value) + 1) + 3 AS BIGINT) AS "offset" FROM k)"""

_MARKED = f"""parts AS (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents),
 raw AS (SELECT doc_id, unnest(range(len(x))) AS line_no, unnest(x) AS y FROM parts),
 m AS (SELECT doc_id, line_no, CASE WHEN y LIKE 'A%' THEN NULL ELSE {st.strip_sql("y")} END AS line,
   CASE WHEN y LIKE 'A%' THEN lower({st.strip_sql("y")}) END AS head, y LIKE 'I%' AS comment FROM raw),
 s AS (SELECT doc_id, line_no, coalesce(last_value(head IGNORE NULLS) OVER (
     PARTITION BY doc_id ORDER BY line_no), 'data') AS section, line
   FROM m QUALIFY head IS NULL AND NOT comment)"""

_ANCHOR = f"""{_REPORTS}, p AS (SELECT match_id, eid, context, minute, eid % 4 <> 0 AS by_player,
     CASE eid % 6 WHEN 0 THEN 'Max ' || string_split(player1, ' ')[-1] WHEN 2 THEN player2
       WHEN 3 THEN 'Nobody Anywhere' ELSE player1 END AS answer
   FROM ev JOIN rep USING (match_id)),
 f AS (SELECT *, strpos(context, chr(10) || minute || ': ') + 1 AS onset,
   string_split(answer, ' ')[-1] AS word FROM p),
 g AS (SELECT *, strpos(substr(context, onset), answer) AS a, strpos(substr(context, onset), word) AS w,
   strpos(context, answer) AS c FROM f WHERE onset > 1 AND answer <> ''),
 h AS (SELECT *, CASE WHEN a > 0 THEN answer WHEN w > 0 THEN word WHEN c > 0 THEN answer END AS text,
   CASE WHEN a > 0 THEN a + onset - 2 WHEN w > 0 THEN w + onset - 2 ELSE c - 1 END AS answer_start FROM g)"""

SQL = {
    "span_minute": f"""WITH {_MINUTES} SELECT match_id, eid, answer AS text, i AS answer_start
        FROM f WHERE answer <> '' AND i > 0
        UNION ALL SELECT match_id, eid, answer || ':', i FROM f WHERE answer <> '' AND i > 0""",
    "span_reasons": f"""WITH {_MINUTES} SELECT CASE WHEN answer = '' THEN 'empty_answer'
        WHEN i > 0 THEN 'added' ELSE 'minute_not_found' END AS status, count(*) AS n FROM f GROUP BY 1""",
    "span_anchor": f"""WITH {_ANCHOR} SELECT match_id, eid, text, answer_start FROM h WHERE text IS NOT NULL
        UNION ALL SELECT match_id, eid, string_split(text, ' ')[-1],
          CASE WHEN strpos(substr(context, onset), string_split(text, ' ')[-1]) = 0 THEN -1
          ELSE strpos(substr(context, onset), string_split(text, ' ')[-1]) + onset - 2 END
        FROM h WHERE by_player AND contains(text, ' ')""",
    "span_first": f"""WITH {_PAIRS} SELECT doc_id, kind, answer AS text, strpos(context, answer) - 1 AS answer_start
        FROM p WHERE answer <> '' AND contains(context, answer)""",
    "span_all": f"""WITH RECURSIVE {_PAIRS},
        l AS (SELECT doc_id, kind, context, string_split(answer, ' ')[-1] AS word FROM p
          WHERE NOT contains(context, answer) AND string_split(answer, ' ')[-1] <> ''),
        o AS (SELECT doc_id, kind, word, strpos(context, word) AS pos,
            substr(context, strpos(context, word) + 1) AS rest FROM l WHERE contains(context, word)
          UNION ALL SELECT doc_id, kind, word, pos + strpos(rest, word),
            substr(rest, strpos(rest, word) + 1) FROM o WHERE contains(rest, word))
        SELECT doc_id, kind, word AS text, pos - 1 AS answer_start FROM o""",
    "answer_contained": f"""WITH ctx AS (SELECT conv_id, string_agg(turn || ': ' || {st.strip_sql('text')}, chr(10)
          ORDER BY turn) AS context FROM conversations GROUP BY 1),
        p AS (SELECT conv_id, true AS own, turn, text AS answer FROM conversations
          UNION ALL SELECT conv_id + 1, false, turn, text FROM conversations)
        SELECT conv_id, own, turn, answer FROM p JOIN ctx USING (conv_id) WHERE contains(context, answer)""",
    "unquote_answers": f"""WITH q AS (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN '''' || c_name || ''''
          WHEN 1 THEN '"''' || c_name || '''"' WHEN 2 THEN '''O\\''' || c_name || '"'
          WHEN 3 THEN '''''''''' || c_name ELSE c_name END AS raw FROM customer)
        SELECT c_custkey, raw, {_UNQUOTED.format('raw')} AS answer FROM q""",
    "numeric_choices": f"WITH {_CHOICES} SELECT * FROM choices",
    "numeric_line": f"""WITH {_CHOICES} SELECT doc,
        string_agg(rtrim(repeat('NUM' || value || ' ', copies)), ' ' ORDER BY value) AS numbers
        FROM choices GROUP BY 1""",
    "span_numeric": f"""WITH {_CHOICES} SELECT n.doc, rule, n.value, n.doc + 2 + "offset" AS answer_start
        FROM n JOIN choices c ON c.doc = n.doc AND c.value = n.value AND is_answer""",
    "unwrap_result": """SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN c_name
        WHEN 1 THEN '[' || c_name || ']' WHEN 2 THEN '[' || c_name ELSE '' END AS result FROM customer""",
    "section_label": f"WITH {_MARKED} SELECT * FROM s",
    "section_text": f"""WITH {_MARKED} SELECT doc_id, section,
        {st.strip_sql("string_agg(line, chr(10) ORDER BY line_no)")} AS text FROM s GROUP BY 1, 2""",
    "trace_records": """WITH r AS (SELECT user_id, ts, event_id, event_type AS k, sum(CASE WHEN event_type = 'view'
          THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS record FROM events)
        SELECT user_id, CAST(record AS BIGINT) AS record,
          '[:find ' || max(event_id) FILTER (k = 'view') || ']' AS query,
          'a,' || arg_max(event_id, ts) FILTER (k = 'click') AS args,
          '[[' || arg_max(event_id, ts) FILTER (k = 'purchase') || ']]' AS result
        FROM r WHERE record > 0 GROUP BY 1, 2""",
}
