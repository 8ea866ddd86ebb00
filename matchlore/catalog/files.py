"""Queries over files and across corpora: runs, files joined by name, texts found in other texts.

They write below the shared folder, as the tables come without such files, and read back what they wrote.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from matchlore.catalog import spans as sp
from matchlore.catalog import standins as st
from matchlore.operators import containment, export
from matchlore.session import shared_folder
from matchlore.sources import match_files
from matchlore.sources.reports import text_runs, write_texts
from matchlore.sources.tables import read_table


def _own_folder(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def incremental_texts(spark, folder):
    """A run over the good documents, one over all, and one that finds nothing to do."""
    documents = read_table(spark, folder, "documents", "doc_id", "text")
    good = read_table(spark, folder, "labels").filter("quality = 1")
    files = _own_folder(spark, "texts")
    for run, texts in (("1", documents.join(good, "doc_id", "left_semi")), ("2", documents), ("3", documents)):
        write_texts(texts, files, "doc_id", "text", run)
    kept = text_runs(spark, files, documents.schema["doc_id"], "text").read()
    return kept.select("doc_id", "run", F.md5("text").alias("digest"))


def _match_files(spark, folder):
    """Questions and reports of matches with events, and facts of those that a supplier stands for."""
    files = _own_folder(spark, "files")
    events = st.match_events(spark, folder)
    question = F.to_json(F.struct("eid", F.concat_ws(" ", F.lit("Who had the"), "event_kind").alias("question")))
    match_files.write_match_files(events.select("match_id", question.alias("line")), files, "questions", "match_id", "line")
    reports = sp.reports_of(spark, folder).join(events.select("match_id"), "match_id", "left_semi")
    match_files.write_match_files(reports, files, "reports", "match_id", "context")
    supplier = read_table(spark, folder, "supplier", F.col("s_suppkey").alias("match_id"), "s_name")
    facts = supplier.select("match_id", F.concat(F.lit("\n;;# data\n"), "s_name", F.lit("\n\n")).alias("text"))
    match_files.write_match_files(facts, files, "facts", "match_id", "text")
    return (
        match_files.read_match_lines(spark, files, "questions"),
        match_files.read_match_texts(spark, files, "reports", "context"),
        match_files.read_match_texts(spark, files, "facts", "datalog"),
    )


def joined_files(spark, folder):
    """Every question with the texts that the other two files of its match hold."""
    questions, reports, facts = _match_files(spark, folder)
    joined = export.join_sources(questions, reports, facts, "match_id")
    return joined.select(
        "match_id", F.get_json_object("line", "$.eid").cast("bigint").alias("eid"),
        F.md5("context").alias("context_digest"), "datalog",
    )


def files_without_partner(spark, folder):
    questions, reports, facts = _match_files(spark, folder)
    return match_files.missing_partners(questions=questions, reports=reports, facts=facts)


def benchmark_contained(spark, folder):
    """Documents that hold a whole benchmark text, and where."""
    return containment.contained_in(
        read_table(spark, folder, "benchmark", "item_id", "text"), read_table(spark, folder, "documents", "doc_id", "text"),
        "item_id", "doc_id", needle="text",
    )


def benchmark_phrases(spark, folder):
    """Documents that hold the first two or the first four words of a benchmark text."""
    items = read_table(spark, folder, "benchmark", "item_id", "text")
    words = F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ")
    sizes = F.explode(F.array(F.lit(2), F.lit(4)))
    sized = items.select("item_id", words.alias("words"), sizes.alias("size"))
    phrases = sized.select(
        F.concat_ws("/", "item_id", "size").alias("phrase"), F.array_join(F.slice("words", 1, F.col("size")), " ").alias("needle")
    )
    return containment.contained_in(phrases, read_table(spark, folder, "documents", "doc_id", "text"), "phrase", "doc_id")


QUERIES = {
    f.__name__: f
    for f in (
        incremental_texts, joined_files, files_without_partner, benchmark_contained, benchmark_phrases,
    )
}

SQL = {
    "incremental_texts": """SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) THEN '1' ELSE '2' END AS run,
        md5(text) AS digest FROM documents""",
    "joined_files": f"""WITH {sp._REPORTS} SELECT match_id, eid, md5(context) AS context_digest,
        chr(10) || ';;# data' || chr(10) || s_name || chr(10) || chr(10) AS datalog
        FROM ev JOIN rep USING (match_id) JOIN supplier ON s_suppkey = match_id""",
    "files_without_partner": """WITH e AS (SELECT DISTINCT user_id FROM events JOIN customer ON c_custkey = user_id)
        SELECT coalesce(user_id, s_suppkey) AS match_id, CASE WHEN user_id IS NULL THEN 'questions,reports' ELSE 'facts' END AS missing
        FROM e FULL JOIN supplier ON s_suppkey = user_id WHERE user_id IS NULL OR s_suppkey IS NULL""",
    "benchmark_contained": """SELECT item_id, doc_id, min(strpos(d.text, b.text)) - 1 AS first_position
        FROM documents d JOIN benchmark b ON b.text <> '' AND contains(d.text, b.text) GROUP BY 1, 2""",
    "benchmark_phrases": """WITH p AS (SELECT item_id || '/' || size AS phrase,
          array_to_string(string_split(replace(text, chr(10), ' '), ' ')[1:size], ' ') AS needle
          FROM benchmark, (SELECT unnest([2, 4]) AS size))
        SELECT phrase, doc_id, strpos(text, needle) - 1 AS first_position
        FROM documents JOIN p ON needle <> '' AND contains(text, needle)""",
}
