import pytest
from pyspark.sql import functions as F

from matchlore.operators import export, spans

CONTEXT = "A vs. B\n\n4: Leo Messi scores\n44: Messi again\n45: X Y of ababa"


def located(spark, answer, answertype, minute=None, query=":event/player1", context=CONTEXT):
    df = spark.createDataFrame(
        [(1, context, answer, answertype, minute, query)],
        "k int, context string, answer string, answertype string, minute string, datalog string",
    )
    found = spans.with_spans(df)
    rows = spans.span_rows(found, ["k"]).orderBy("no").collect()
    return [(r["text"], r["answer_start"]) for r in rows], found.first()["reason"], found


@pytest.mark.parametrize(
    "answer, answertype, minute, query, want, reason",
    [
        ("4", "minute", None, "", [("4", 9), ("4:", 9)], None),
        ("'44'", "minute", None, "", [("44", 29), ("44:", 29)], None),
        ("5", "minute", None, "", [], "minute_not_found"),
        ("", "minute", None, "", [], "empty_answer"),
        ("Messi", "text", None, "", [("Messi", 16)], None),
        ("Leo Foo", "text", None, "", [], "answer_not_found"),
        ("", "text", None, "", [], "empty_answer"),
        ("Messi", "text", "44", "", [("Messi", 33)], None),
        ("Leo Messi", "text", "44", ":event/player1", [("Messi", 33)], None),
        ("Leo Messi", "text", "4", ":event/player1", [("Leo Messi", 12), ("Messi", 16)], None),
        ("Leo Messi", "text", "4", ":event/player1 :event/team", [("Leo Messi", 12)], None),
        ("A vs. B", "text", "45", ":event/player1", [("A vs. B", 0), ("B", -1)], None),
        ("Messi", "text", "7", "", [], "minute_not_found"),
        ("None Here", "text", "4", "", [], "answer_not_found"),
        ("3", "numeric", None, "", [], "numeric"),
        ("x", "numeric", None, "", [], "no_number"),
        ("x", "-", None, "", [], "unknown_answertype"),
    ],
)
def test_spans(spark, answer, answertype, minute, query, want, reason):
    got, why, _ = located(spark, answer, answertype, minute, query)
    assert (got, why) == (want, reason)


@pytest.mark.parametrize(
    "context, word",
    [("ababa", "aba"), (CONTEXT, "Messi"), ("aaaa", "aa"), ("x.\\E(y x.\\E(y", ".\\E("), ("é\né é", "é"), ("abc", "z")],
)
def test_every_occurrence(spark, context, word):
    _, reason, found = located(spark, "No " + word, "text", context=context)
    got = sorted(r["answer_start"] for r in spans.last_word_spans(found, ["k"]).collect())
    want = [i for i in range(len(context)) if context.startswith(word, i)]
    assert got == want and (reason == "last_word") == bool(want)


@pytest.mark.parametrize("limit", [10**9, 2])
def test_numeric_choices(spark, limit):
    rows = [(1, v) for v in (10, 1, 1)] + [(2, v) for v in (5, 4, 3, 2, 1, 0)] + [(3, 100)]
    df = spark.createDataFrame(rows, "doc int, value bigint").withColumn("context_length", F.lit(20))
    choices = spans.numeric_choices(df, "doc", 3, limit=limit)
    lines = {r["doc"]: r["numbers"] for r in spans.choice_line(choices, "doc").collect()}
    for doc, least in ((1, 5), (2, 6), (3, 5)):
        values = [int(mark[3:]) for mark in lines[doc].split(" ")]
        assert len(values) == least and values == sorted(values)
        assert all(values.count(v) == [r for r in rows if r[0] == doc].count((doc, v)) for d, v in rows if d == doc)
    for r in spans.numeric_spans(df, choices, "doc").collect():
        text = "." * 20 + "\n\n" + lines[r["doc"]]
        assert r["answer_start"] == text.index(f"NUM{r['value']}", 20) + 3


def test_many_copies_are_one_line(spark):
    df = spark.createDataFrame([(1, 7)] * 50 + [(1, 8)], "doc int, value bigint")
    choices = spans.numeric_choices(df, "doc", 3)
    (line,) = spans.choice_line(choices, "doc").collect()
    assert line["numbers"] == " ".join(["NUM7"] * 50 + ["NUM8"])


def test_an_empty_last_word_is_no_answer(spark):
    pairs = spark.createDataFrame([("some text", "zzz ", "text")], "context string, answer string, answertype string")
    found = spans.with_spans(pairs, minute=None).first()
    assert found["reason"] == "answer_not_found" and found["pieces"] is None


@pytest.mark.parametrize(
    "n, sizes",
    [(1, [1, 0, 0]), (2, [1, 1, 0]), (4, [2, 2, 0]), (5, [3, 1, 1]), (11, [6, 2, 3]), (100, [60, 20, 20])],
)
def test_split_sizes(spark, n, sizes):
    got = dict(
        map(tuple, export.with_split(spark.range(n), "id", 1).groupBy("split").count().collect())
    )
    assert [got.get(s, 0) for s in export.SPLITS] == sizes


def test_question_ids(spark):
    df = spark.range(100).select(export.question_id(F.lit("Q_1"), 1, F.col("id")).alias("id"))
    ids = [r["id"] for r in df.collect()]
    assert all(i.startswith("Q_1_") and 10_000_000 <= int(i[4:]) <= 99_999_999 for i in ids)
    assert export.repeated_ids(df.unionByName(df)).count() == 100


def test_nested_documents_are_whole(spark, tmp_path):
    records = spark.range(25).select(
        F.lit(1).alias("doc"), F.lit("r").alias("rule"), F.lit("c").alias("category"),
        F.col("id").cast("string").alias("question"), F.lit("text").alias("answertype"),
        F.lit("q").alias("query"), F.format_string("r_%08d", "id").alias("id"), F.lit(False).alias("is_impossible"),
        F.array(F.struct(F.lit("a").alias("text"), F.lit(0).alias("answer_start"))).alias("answers"),
    )
    documents = spark.createDataFrame(
        [(1, "train", "Title\nline", "facts"), (2, "dev", "Other", "none")],
        "doc int, split string, context string, datalog string",
    )
    nested = export.nested_documents(records, documents, "doc")
    folder = str(tmp_path / "out")
    export.write_documents(nested, folder)
    read = spark.read.json(folder)
    assert read.filter("split = 'train'").count() == 1 and read.filter("split = 'dev'").count() == 1
    assert set(read.columns) == {"version", "split", "data", "folder"}
    data = read.select(F.explode("data").alias("d"))
    qas = data.select(F.explode("d.paragraphs").alias("p")).select(F.explode("p.qas").alias("q"))
    assert [r[0] for r in qas.select("q.id").collect()] == [f"r_{n:08}" for n in range(25)]
    assert {r[0] for r in data.select("d.title").collect()} == {"Title", "Other"}
