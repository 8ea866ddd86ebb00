"""Queries over the export: ids, titles, joined sources and nested documents."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from matchlore.catalog import spans as sp
from matchlore.catalog import standins as st
from matchlore.operators import export
from matchlore.plans import qa
from matchlore.session import shared_folder
from matchlore.sources.fact_text import match_id_of_path
from matchlore.sources.tables import read_table


def question_ids(spark, folder):
    events = read_table(spark, folder, "events", "event_id", "event_type")
    return events.select(
        "event_id", export.question_id(F.col("event_type"), st.SEED, F.col("event_id")).alias("id")
    )


def repeated_ids(spark, folder):
    """Ids of three digits, which are not enough for the events."""
    events = read_table(spark, folder, "events", "event_id", "event_type")
    ids = export.question_id(F.col("event_type"), st.SEED, F.col("event_id"), low=100, high=999)
    return export.repeated_ids(events.select(ids.alias("id")))


def document_titles(spark, folder):
    documents = read_table(spark, folder, "documents", "doc_id", "text")
    return documents.select("doc_id", export.title_of(F.col("text")).alias("title"))


def answertype_override(spark, folder):
    events = read_table(spark, folder, "events", "event_id", "event_type", "user_id")
    rule = F.when(F.col("event_type") == "click", export.NUMERIC_RULE).otherwise(F.col("event_type"))
    flag = F.when(F.col("event_id") % 3 == 0, F.col("event_id") % 2 == 0)
    return events.select(
        "event_id",
        export.answertype_of(rule, F.lit("text")).alias("answertype"),
        F.coalesce(flag, F.lit(False)).alias("is_impossible"),
    )


def file_keys(spark, folder):
    """Match keys out of the file names of three kinds of files."""
    documents = read_table(spark, folder, "documents", "doc_id")
    key = F.col("doc_id").cast("string")
    names = (
        F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("/a/questions_"), key, F.lit(".dat")))
        .when(F.col("doc_id") % 3 == 1, F.concat(F.lit("/a_7/report_"), key, F.lit(".txt")))
        .otherwise(F.concat(F.lit("report_"), key, F.lit(".dl")))
    )
    return documents.select("doc_id", match_id_of_path(names).alias("match_id"))


def joined_sources(spark, folder):
    """Questions with the text and the label of their document."""
    documents = read_table(spark, folder, "documents", "doc_id", "lang", "source", "text")
    questions = documents.select("doc_id", F.concat_ws(" ", F.lit("Language of"), "source").alias("question"))
    reports = documents.select("doc_id", "text")
    labels = read_table(spark, folder, "labels").select(
        "doc_id", F.col("quality").cast("bigint").alias("quality")
    )
    return export.join_sources(questions, reports, labels, "doc_id")


def _question_plan(spark, folder):
    """The question plan on the event table: matches with long texts that are not done, their questions and answers.

    Customers are matches; a report and the document of the same number are their texts, labels name the finished ones.
    """
    events = st.match_events(spark, folder).withColumn("pos", F.col("eid")).withColumn(
        "player1", F.struct(F.col("player1").alias("name"))
    )
    matches = st.match_numbers(spark, folder)
    texts = read_table(spark, folder, "documents", F.col("doc_id").alias("match_id"), "text")
    done = read_table(spark, folder, "labels", F.col("doc_id").alias("match_id"))
    return qa.question_set(matches, events, st.SEED, sp.reports_of(spark, folder), texts, done, min_lines=4)


def question_set(spark, folder):
    """The questions that were made for a match, on either level."""
    return _question_plan(spark, folder).filter("level <> 'drawn'").select(
        "match_id", "question_key", "level", "rule", "category", "question", "datalog", "answer",
        "answertype", "unanswerable",
    )


def question_set_drawn(spark, folder):
    """The questions of other matches that the plan adds as unanswerable ones."""
    return _question_plan(spark, folder).filter("level = 'drawn'").select(
        "match_id", "question_key", "rule", "category", "question", "datalog", "answer", "answertype", "unanswerable"
    )


def _asked(spark, folder):
    """A question per event: for its minute, its player, or a number."""
    key = F.col("eid")
    kind = F.when(key % 3 == 0, "minute").when(key % 3 == 1, "text").otherwise("numeric")
    answer = (
        F.when(key % 3 == 0, F.col("minute").cast("string"))
        .when(key % 6 == 1, F.col("player1"))
        .when(key % 30 == 4, "zzz ")
        .when(key % 6 == 4, F.concat(F.lit("Max "), F.substring_index("player1", " ", -1)))
        .otherwise(F.coalesce("sortorder", F.lit(7)).cast("string"))
    )
    return st.match_events(spark, folder, spread=True).select(
        "match_id",
        F.col("event_id").alias("question_key"),
        F.col("event_kind").alias("rule"),
        F.lit("Simple").alias("category"),
        F.concat(F.lit("Question "), F.col("event_id"), F.lit("?")).alias("question"),
        F.lit("query").alias("datalog"),
        F.when(key % 7 == 0, "").otherwise(answer).alias("answer"),
        kind.alias("answertype"),
        F.when(key % 7 == 0, F.lit(True)).alias("unanswerable"),
    )


def _dataset(spark, folder):
    contexts = sp.reports_of(spark, folder)
    texts = st.match_numbers(spark, folder).select("match_id", F.col("league").alias("datalog"))
    return qa.dataset(_asked(spark, folder), contexts, texts, st.SEED)


def _flattened(documents):
    """One row per answer of nested documents."""
    paragraphs = documents.select("version", "split", F.explode("data").alias("d")).select(
        "version", "split", "d.title", F.explode("d.paragraphs").alias("p")
    ).select("version", "split", "title", F.length("p.context").alias("size"), F.explode("p.qas").alias("qa"),
             F.col("p.context").alias("context"))
    rows = paragraphs.select("version", "split", "title", "size", "context", "qa.*").select(
        "*", F.explode_outer("answers").alias("a")
    )
    start = F.col("a.answer_start").cast("bigint")
    return rows.select(
        "version", "split", "title", F.col("size").cast("bigint").alias("size"), "rule", "question",
        "answertype", "is_impossible", F.col("a.text").alias("text"), start.alias("answer_start"),
        F.substring("context", start.cast("int") + 1, F.length("a.text")).alias("found"),
    )


def nested_export(spark, folder):
    """Nested documents of the whole event table, flattened."""
    return _flattened(_dataset(spark, folder).documents)


def nested_roundtrip(spark, folder):
    """The same documents written as JSON lines per split and read back."""
    files = f"{shared_folder(spark)}/nested-{uuid.uuid4().hex}"
    export.write_documents(_dataset(spark, folder).documents, files)
    return _flattened(export.read_documents(spark, files))


def export_counters(spark, folder):
    return _dataset(spark, folder).counts()


QUERIES = {
    f.__name__: f
    for f in (
        question_ids, repeated_ids, document_titles, answertype_override, file_keys, joined_sources,
        nested_export, nested_roundtrip, export_counters, question_set, question_set_drawn,
    )
}

_ID = """event_type || '_' || ({low}
   + CAST('0x' || substr(md5('42:' || event_type || ':' || event_id), 1, 15) AS BIGINT) % {span})"""

_DATASET = f"""{sp._REPORTS},
 asked AS (SELECT match_id, eid, event_kind AS rule, 'Question ' || eid || '?' AS question,
   CASE eid % 3 WHEN 0 THEN 'minute' WHEN 1 THEN 'text' ELSE 'numeric' END AS answertype,
   CASE WHEN eid % 3 = 0 THEN CAST(minute AS VARCHAR) WHEN eid % 6 = 1 THEN player1
     WHEN eid % 30 = 4 THEN 'zzz '
     WHEN eid % 6 = 4 THEN 'Max ' || string_split(player1, ' ')[-1]
     ELSE CAST(coalesce(sortorder, 7) AS VARCHAR) END AS answer,
   eid % 7 = 0 AS is_impossible FROM ev),
 docs AS (SELECT match_id, context, row_number() OVER (ORDER BY md5('42:' || match_id), match_id) - 1 AS r,
   count(*) OVER () AS n FROM rep WHERE match_id IN (SELECT match_id FROM ev)),
 sp AS (SELECT *, CASE WHEN floor(n * 0.6::DOUBLE) = 0 OR r < floor(n * 0.6::DOUBLE) THEN 'train'
   WHEN floor(n * 0.2::DOUBLE) = 0 OR r < floor(n * 0.6::DOUBLE) + floor(n * 0.2::DOUBLE) THEN 'dev'
   ELSE 'test' END AS split FROM docs),
 x AS (SELECT asked.*, context, split FROM asked JOIN sp USING (match_id)),
 n AS (SELECT match_id AS doc, TRY_CAST(answer AS BIGINT) AS value FROM x
   WHERE NOT is_impossible AND answertype = 'numeric'),
 t AS (SELECT doc, count(*) AS answers FROM n GROUP BY 1),
 c AS (SELECT doc, v.value, row_number() OVER (PARTITION BY doc ORDER BY md5('42:' || doc || ':' || v.value), v.value) AS r,
   answers FROM t CROSS JOIN (SELECT unnest(range(101)) AS value) v
   WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.doc = t.doc AND n.value = v.value)),
 k AS (SELECT doc, value, count(*) AS copies FROM n GROUP BY 1, 2
   UNION ALL SELECT doc, value, 1 FROM c WHERE r <= 5 - answers),
 num AS (SELECT doc, string_agg(rtrim(repeat('NUM' || value || ' ', copies)), ' ' ORDER BY value) AS line
   FROM k GROUP BY 1),
 y AS (SELECT x.*, context || coalesce(chr(10) || chr(10) || line, '') AS full_context, length(context) AS size0,
   string_split(context, chr(10))[1] AS title, string_split(answer, ' ')[-1] AS word
   FROM x LEFT JOIN num ON doc = match_id),
 occ AS (SELECT eid, word, strpos(context, word) AS pos, substr(context, strpos(context, word) + 1) AS rest
   FROM y WHERE NOT is_impossible AND answertype = 'text' AND NOT contains(context, answer) AND word <> '' AND contains(context, word)
   UNION ALL SELECT eid, word, pos + strpos(rest, word), substr(rest, strpos(rest, word) + 1)
   FROM occ WHERE contains(rest, word)),
 ans AS (
   SELECT eid, answer AS text, strpos(context, chr(10) || answer || ': ') AS answer_start FROM y
     WHERE NOT is_impossible AND answertype = 'minute' AND contains(context, chr(10) || answer || ': ')
   UNION ALL SELECT eid, answer || ':', strpos(context, chr(10) || answer || ': ') FROM y
     WHERE NOT is_impossible AND answertype = 'minute' AND contains(context, chr(10) || answer || ': ')
   UNION ALL SELECT eid, answer, strpos(context, answer) - 1 FROM y
     WHERE NOT is_impossible AND answertype = 'text' AND contains(context, answer)
   UNION ALL SELECT eid, word, pos - 1 FROM occ
   UNION ALL SELECT eid, answer, size0 + strpos(substr(full_context, size0 + 1), 'NUM' || answer) + 2 FROM y
     WHERE NOT is_impossible AND answertype = 'numeric')"""

_QUESTION_SET = f"""{sp._REPORTS}, gate AS MATERIALIZED (
   SELECT mn.* FROM mn JOIN rep USING (match_id) JOIN documents ON doc_id = match_id
   WHERE match_id NOT IN (SELECT doc_id FROM labels)
     AND len(list_filter(string_split(context, chr(10)), lambda x: {st.strip_sql('x')} <> '')) >= 4
     AND len(list_filter(string_split(text, chr(10)), lambda x: {st.strip_sql('x')} <> '')) >= 4),
 e AS MATERIALIZED (SELECT * FROM ev WHERE match_id IN (SELECT match_id FROM gate)),
 res AS MATERIALIZED (
   SELECT match_id, concat_ws('|', ':event/player', event_kind, CAST(minute AS VARCHAR), team) AS datalog,
     arg_min(player1, eid) AS answer FROM e GROUP BY 1, 2
   UNION ALL SELECT match_id, concat_ws('|', ':event/minute', event_kind, player1),
     arg_min(CAST(minute AS VARCHAR), eid) FILTER (minute IS NOT NULL) FROM e GROUP BY 1, 2
   UNION ALL SELECT match_id, concat_ws('|', 'count', event_kind, team), CAST(count(*) AS VARCHAR) FROM e GROUP BY 1, 2
   UNION ALL SELECT match_id, 'count', CAST(count(*) AS VARCHAR) FROM e GROUP BY 1
   UNION ALL SELECT match_id, 'home|' || awayteam, hometeam FROM gate),
 tries AS MATERIALIZED (SELECT match_id, awayteam, pos, md5('42:' || match_id || ':' || pos) AS h
   FROM gate CROSS JOIN (SELECT unnest(range(1, 21)) AS pos)),
 m AS (SELECT match_id, 'match' AS level, CASE WHEN md5(h || ':Q_A_1') < md5(h || ':Q_A_2') THEN 'Q_A_1' ELSE 'Q_A_2' END AS rule,
   awayteam FROM tries),
 ma AS (SELECT DISTINCT match_id, level, rule, CASE rule WHEN 'Q_A_1' THEN 'Simple' ELSE 'Count' END AS category,
   CASE rule WHEN 'Q_A_1' THEN 'Who plays at home against ' || awayteam || '?' ELSE 'How many events are there?' END AS question,
   CASE rule WHEN 'Q_A_1' THEN 'home|' || awayteam ELSE 'count' END AS datalog,
   CASE rule WHEN 'Q_A_1' THEN 'text' ELSE 'numeric' END AS answertype FROM m),
 eh AS MATERIALIZED (SELECT *, md5('42:' || match_id || ':' || eid) AS h FROM e),
 er AS (SELECT *, CASE least(md5(h || ':Q_E_WHO'), md5(h || ':Q_E_WHEN'), md5(h || ':Q_E_MANY'))
     WHEN md5(h || ':Q_E_WHO') THEN 'Q_E_WHO' WHEN md5(h || ':Q_E_WHEN') THEN 'Q_E_WHEN' ELSE 'Q_E_MANY' END AS rule FROM eh),
 ea AS (SELECT match_id, 'event' AS level, rule, CASE rule WHEN 'Q_E_WHO' THEN 'Player' WHEN 'Q_E_WHEN' THEN 'Simple' ELSE 'Count' END AS category,
   CASE rule WHEN 'Q_E_WHO' THEN CASE WHEN CAST('0x' || substr(h, 1, 15) AS BIGINT) % 2 = 0
       THEN 'Which player had a ' || event_kind || ' in minute ' || minute || '?'
       ELSE 'Whose ' || event_kind || ' was it in minute ' || minute || '?' END
     WHEN 'Q_E_WHEN' THEN 'In which minute did ' || player1 || ' have a ' || event_kind || '?'
     ELSE 'How many times was there a ' || event_kind || ' by the ' || team || ' team?' END AS question,
   CASE rule WHEN 'Q_E_WHO' THEN concat_ws('|', ':event/player', event_kind, CAST(minute AS VARCHAR), team)
     WHEN 'Q_E_WHEN' THEN concat_ws('|', ':event/minute', event_kind, player1)
     ELSE concat_ws('|', 'count', event_kind, team) END AS datalog,
   CASE rule WHEN 'Q_E_WHO' THEN 'text' WHEN 'Q_E_WHEN' THEN 'minute' ELSE 'numeric' END AS answertype, h, eid FROM er),
 ef AS MATERIALIZED (SELECT ea.*, answer FROM ea JOIN res USING (match_id, datalog) WHERE trim(answer) <> ''
   QUALIFY row_number() OVER (PARTITION BY match_id, rule ORDER BY h, eid) = 1),
 both_levels AS MATERIALIZED (
   SELECT match_id, level, rule, category, question, datalog, answertype, answer FROM ef
   UNION ALL SELECT match_id, level, rule, category, question, datalog, answertype, coalesce(answer, '')
   FROM ma LEFT JOIN res USING (match_id, datalog))"""

_NESTED = f"""WITH RECURSIVE {_DATASET} SELECT '2.0' AS version, split, title,
          length(full_context) AS size, rule, question, answertype, is_impossible, text, answer_start,
          substr(full_context, answer_start + 1, length(text)) AS found
        FROM y LEFT JOIN ans USING (eid) WHERE is_impossible OR ans.eid IS NOT NULL"""

# Brute force: everything a match may be asked is listed and drawn from by rank.
_DRAWN = f"""{_QUESTION_SET}, k AS MATERIALIZED (SELECT *, match_id || '_' || level || '_' || rule AS question_key FROM both_levels),
 cnt AS (SELECT match_id, count(*) AS n FROM k GROUP BY 1),
 free AS MATERIALIZED (SELECT cnt.match_id, k.question_key, k.rule, k.category, k.question, k.datalog, k.answertype,
   row_number() OVER (PARTITION BY cnt.match_id ORDER BY md5('42:' || k.datalog), k.datalog, k.question_key) - 1 AS r,
   count(*) OVER (PARTITION BY cnt.match_id) AS free
   FROM cnt JOIN k ON k.match_id <> cnt.match_id
   WHERE NOT EXISTS (SELECT 1 FROM res WHERE res.match_id = cnt.match_id AND res.datalog = k.datalog)),
 slots AS (SELECT match_id, n, unnest(range(n // 4 + 1)) AS slot FROM cnt),
 sized AS (SELECT match_id, slot, free, least(n // 4 + 1, free) AS wanted
   FROM slots JOIN (SELECT DISTINCT match_id, free FROM free) USING (match_id)),
 drawn AS (SELECT match_id, slot, slot * (free // wanted) + least(slot, free % wanted)
     + CAST('0x' || substr(md5('42:' || match_id || ':' || slot), 1, 15) AS BIGINT)
       % (free // wanted + CASE WHEN slot < free % wanted THEN 1 ELSE 0 END) AS at FROM sized WHERE slot < wanted)"""

SQL = {
    "question_set": f"""WITH {_QUESTION_SET} SELECT match_id, match_id || '_' || level || '_' || rule AS question_key,
        level, rule, category, question, datalog, answer, answertype, false AS unanswerable FROM both_levels""",
    "question_set_drawn": f"""WITH {_DRAWN} SELECT d.match_id, 'n_' || d.match_id || '_' || slot AS question_key, rule, category,
        question, datalog, '' AS answer, answertype, true AS unanswerable
        FROM drawn d JOIN free f ON f.match_id = d.match_id AND f.r = d.at""",
    "question_ids": f"SELECT event_id, {_ID.format(low=10000000, span=90000000)} AS id FROM events",
    "repeated_ids": f"SELECT {_ID.format(low=100, span=900)} AS id, count(*) AS n FROM events GROUP BY 1 HAVING count(*) > 1",
    "document_titles": f"""SELECT doc_id, string_split({st.strip_sql('text')}, chr(10))[1] AS title
        FROM documents""",
    "answertype_override": """SELECT event_id, CASE WHEN event_type = 'click' THEN 'numeric' ELSE 'text' END
        AS answertype, event_id % 6 = 0 AS is_impossible FROM events""",
    "file_keys": "SELECT doc_id, doc_id AS match_id FROM documents",
    "joined_sources": """SELECT doc_id, 'Language of ' || source AS question, text,
        CAST(quality AS BIGINT) AS quality FROM documents JOIN labels USING (doc_id)""",
    "nested_export": _NESTED,
    "nested_roundtrip": _NESTED,
    "export_counters": f"""WITH RECURSIVE {_DATASET}, s AS (SELECT split, CASE
          WHEN is_impossible OR eid IN (SELECT eid FROM ans) THEN 'added'
          WHEN answertype = 'minute' THEN 'minute_not_found' ELSE 'answer_not_found' END AS status FROM y)
        SELECT split, status, count(*) AS n FROM s GROUP BY 1, 2""",
}
