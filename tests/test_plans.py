"""The whole way from the relational tables to split documents, on small data."""

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from matchlore.catalog import events as ce
from matchlore.catalog import standins as st
from matchlore.operators import sections
from matchlore.plans import corpus, qa
from matchlore.sources import questions_json, reports as report_files
from matchlore.session import reliable
from matchlore.streaming import incremental


@pytest.fixture(scope="module")
def built(spark, data):
    match = ce._xml_matches(spark, data).join(st.matches(spark, data), "id")
    tables = {
        "Match": match,
        "Team": st.teams(spark, data),
        "Country": st.countries(spark, data),
        "League": st.leagues(spark, data),
        "Player": st.players(spark, data),
    }
    return corpus.build_corpus(tables, seed=3, whole_match_rule=False)


def test_corpus_is_consistent(built):
    owners = built.facts.filter("attr = 'match/score'").count()
    assert owners == built.matches.count() == built.reports.count() == built.fact_texts.count()
    kinds = built.facts.filter("attr = 'event/type'").count()
    assert kinds == built.events.count() > 0
    lines = built.reports.select(F.size(F.split("context", "\n")).alias("n")).agg(F.sum("n")).first()[0]
    # A header and a blank line per report, and at most one line per event.
    assert 2 * owners < lines <= 2 * owners + kinds


def test_dataset_from_corpus(spark, built):
    asked = reliable(qa.question_set(built.matches, built.events, seed=3))
    per_match = asked.filter("level <> 'drawn'").groupBy("match_id").count()
    drawn = asked.filter("unanswerable").groupBy("match_id").agg(F.count(F.lit(1)).alias("drawn"))
    joined = per_match.join(drawn, "match_id", "left").fillna(0)
    assert joined.filter("drawn <> count div 4 + 1").count() == 0
    assert asked.groupBy("question_key").count().filter("count > 1").count() == 0
    contexts = qa.single_texts(built.reports, "context", "context")
    texts = qa.single_texts(built.fact_texts, "datalog", "text")
    result = qa.dataset(asked, contexts, texts, seed=3)
    added = result.counts().filter("status = 'added'").agg(F.sum("n")).first()[0]
    documents = result.documents.select("split", F.explode("data").alias("d"))
    assert documents.count() == asked.select("match_id").distinct().count()
    rows = documents.select("split", F.explode("d.paragraphs").alias("p")).select(
        "split", "p.context", F.explode("p.qas").alias("qa")
    )
    assert rows.count() == added
    answers = rows.filter("NOT qa.is_impossible").select(
        "context", "qa.answertype", F.explode("qa.answers").alias("a")
    )
    # Every located answer stands where it is said to stand.
    wrong = answers.filter("a.answer_start >= 0 AND substr(context, a.answer_start + 1, length(a.text)) <> a.text")
    assert wrong.count() == 0 and answers.count() > 0
    assert rows.filter("qa.is_impossible").count() == asked.filter("unanswerable").count()


def test_question_files(spark, tmp_path):
    rows = spark.createDataFrame([("-", "r", "q?", "a")], "category string, rule string, question string, answer string")
    questions_json.write_questions(rows, str(tmp_path / "q"))
    extra = tmp_path / "q" / "more.json"
    extra.write_text("\n" + json.dumps({"rule": "s", "unanswerable": True}) + "\n\n")
    read = questions_json.read_questions(spark, str(tmp_path / "q"))
    assert {(r["rule"], r["unanswerable"]) for r in read.collect()} == {("r", None), ("s", True)}


def test_text_files(spark, tmp_path):
    texts = spark.createDataFrame([(1, "a \n\nb"), (2, "c")], "match_id int, text string")
    for _ in range(2):
        report_files.write_text_folders(texts, str(tmp_path / "folders"), "match_id", "text")
    lines = report_files.read_lines(spark, str(tmp_path / "folders"))
    assert sorted(r["line"] for r in lines.collect()) == ["a", "b", "c"]
    assert [report_files.write_texts(texts, str(tmp_path / "runs"), "match_id", "text") for _ in range(2)] == [2, 0]
    kept = report_files.text_runs(spark, str(tmp_path / "runs"), texts.schema["match_id"], "text").read()
    assert sorted((r["match_id"], r["text"]) for r in kept.collect()) == [(1, "a \n\nb"), (2, "c")]


def test_only_long_and_new_matches_are_asked(spark, built):
    ids = sorted(r["match_id"] for r in built.matches.select("match_id").collect())
    lines = {ids[0]: 3, ids[1]: 2, ids[2]: 3, ids[3]: 3}
    texts = [(i, "\n".join(["x"] * n) + "\n \n") for i, n in lines.items()]
    reports = spark.createDataFrame(texts, "match_id bigint, context string")
    facts = spark.createDataFrame([t for t in texts if t[0] != ids[2]], "match_id bigint, text string")
    done = spark.createDataFrame([(ids[3],)], "match_id bigint")
    chosen = qa.chosen_matches(built.matches, reports, facts, done, min_lines=3)
    assert [r["match_id"] for r in chosen.collect()] == [ids[0]]
    asked = qa.question_set(built.matches, built.events, 3, reports, facts, done, min_lines=3)
    assert {r["match_id"] for r in asked.select("match_id").distinct().collect()} == {ids[0]}


def test_texts_are_gated_once(spark, built):
    """The gate may stand for whole reports, so neither the answers nor the questions work it out again."""
    read = spark.sparkContext.accumulator(0)

    def seen(text: str) -> str:
        read.add(1)
        return text

    reports = reliable(built.matches.select("match_id").distinct().withColumn("context", F.lit("x\nx\nx")))
    read_reports = reports.withColumn("context", F.udf(seen, "string")("context"))
    qa.question_set(built.matches, built.events, 3, read_reports, min_lines=3).collect()
    assert 0 < read.value <= reports.count()


def test_a_rule_without_partner_fails(built):
    rules = [r for r in qa.EVENT_RULES if (r.target, r.rule_id) != ("datalog", "Q_E_WHO")]
    with pytest.raises(ValueError, match="Q_E_WHO"):
        qa.ask_events(built.events, 3, rules)


def test_an_id_is_used_on_one_level_only(built):
    renamed = [replace(r, rule_id="Q_A_1") if r.rule_id == "Q_E_MANY" else r for r in qa.EVENT_RULES]
    asked = qa.question_set(built.matches, built.events, 3, event_rules=renamed).filter("level <> 'drawn'")
    assert asked.groupBy("match_id", "rule").count().filter("count > 1").count() == 0
    assert asked.filter("rule = 'Q_A_1' AND level = 'event'").join(
        asked.filter("rule = 'Q_A_1' AND level = 'match'"), "match_id"
    ).count() == 0


def test_finished_matches_are_left_out_of_the_corpus(spark, data, built):
    done = built.matches.select("match_id").limit(5)
    match = ce._xml_matches(spark, data).join(st.matches(spark, data), "id")
    tables = {"Match": match, "Team": st.teams(spark, data), "Country": st.countries(spark, data),
              "League": st.leagues(spark, data), "Player": st.players(spark, data)}
    again = corpus.build_corpus(tables, seed=3, whole_match_rule=False, done=reliable(done))
    assert again.matches.count() == built.matches.count() - 5


def test_a_second_run_adds_what_the_first_left_out(spark, data, built, tmp_path):
    folder, matches = str(tmp_path / "corpus"), built.matches.count()
    some = replace(built, reports=built.reports.filter("match_id % 3 = 0"), fact_texts=built.fact_texts.filter("match_id % 3 = 0"))
    first = corpus.write_corpus(some, folder)
    done = corpus.finished_matches(spark, folder)
    assert first == done.count() < matches
    match = ce._xml_matches(spark, data).join(st.matches(spark, data), "id")
    tables = {"Match": match, "Team": st.teams(spark, data), "Country": st.countries(spark, data),
              "League": st.leagues(spark, data), "Player": st.players(spark, data)}
    again = corpus.build_corpus(tables, seed=3, whole_match_rule=False, done=done)
    assert corpus.write_corpus(again, folder) == matches - first
    assert corpus.write_corpus(built, folder) == 0
    reports, facts = corpus.read_corpus(spark, folder)
    key = ["match_id", "context"]
    assert reports.select(*key).exceptAll(built.reports.select(*key)).count() == 0
    assert reports.count() == facts.count() == corpus.finished_matches(spark, folder).count() == matches


def test_sections_and_traces(spark):
    text = "x\n;;# Schema\n;; note\ns1\n;;# data\n d1\nd2\n"
    texts = spark.createDataFrame([(1, text)], "k int, text string")
    labelled = sections.labelled_lines(sections.numbered_lines(texts, "k", "text"), "k", limit=2)
    got = {(r["section"], r["text"]) for r in sections.section_texts(labelled, "k").collect()}
    assert got == {("data", "x\nd1\nd2"), ("schema", "s1")}
    log = ['noise', 'IM_ARGS:["z"]', 'IM_QUERY:"q1"', 'IM_ARGS:[1,"b"]', 'IM_RESULT:[[1]]', 'IM_RESULT:[[2]]',
           'IM_QUERY:"q2"']
    lines = spark.createDataFrame([(1, n, x) for n, x in enumerate(log)], "k int, line_no int, line string")
    for limit in (10**9, 2):
        got = sections.trace_records(lines, "k", limit=limit).orderBy("record").collect()
        assert [tuple(r) for r in got] == [(1, 1, "q1", ["1", "b"], "[[2]]"), (1, 2, "q2", None, None)]


def test_new_fact_files_are_taken_once(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    body = ';;# data\n[\n{{:match/id "match_{0}"\n:match/score "0:0"}}\n]\n'
    (source / "report_1.dl").write_text(body.format(1))
    for expected in (2, 2):
        incremental.take_new_fact_files(spark, str(source), str(target), str(tmp_path / "state"))
        assert spark.read.parquet(str(target)).count() == expected
    (source / "report_2.dl").write_text(body.format(2))
    incremental.take_new_fact_files(spark, str(source), str(target), str(tmp_path / "state"))
    read = spark.read.parquet(str(target))
    assert {r["match_id"] for r in read.collect()} == {1, 2} and read.count() == 4
