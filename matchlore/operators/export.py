"""Split, question ids and the nested question-answering documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlore.functions.sampling import hash_number, seed_hash
from matchlore.functions.text import first_line, strip
from matchlore.operators.ordered import hash_ranked

# Fixed values of the export.
VERSION = "2.0"
SPLITS = ("train", "dev", "test")
SHARES = (0.6, 0.2)
NUMERIC_RULE = "Q_A_2"
ID_LOW, ID_HIGH = 10_000_000, 99_999_999


def split_of(rank: Column, total: Column) -> Column:
    """train, dev or test by 0-based rank. Shares are cut to whole documents;
    what is left goes to the last split a file counter would have reached."""
    train, dev = (F.floor(total * F.lit(share)).cast("bigint") for share in SHARES)
    return (
        F.when(train == 0, SPLITS[0])
        .when(rank < train, SPLITS[0])
        .when((dev == 0) | (rank < train + dev), SPLITS[1])
        .otherwise(SPLITS[2])
    )


def with_split(documents: DataFrame, key: str, seed: int, digits: int = 3) -> DataFrame:
    """Adds ``split``: an exact 60/20/20 split in seeded random order."""
    ranked = hash_ranked(documents, [key], seed, "__rank", "__documents", digits)
    return ranked.withColumn("split", split_of(F.col("__rank"), F.col("__documents"))).drop(
        "__rank", "__documents"
    )


def answertype_of(rule: Column, answertype: Column) -> Column:
    return F.when(rule == NUMERIC_RULE, "numeric").otherwise(answertype)


def question_id(rule: Column, seed: int, *keys: Column, low: int = ID_LOW, high: int = ID_HIGH) -> Column:
    """``rule_{8 digits}`` drawn by the question's key; see ``repeated_ids``."""
    span = high - low + 1
    number = F.pmod(hash_number(seed_hash(seed, rule, *keys)), F.lit(span)) + low
    return F.concat_ws("_", rule, number.cast("string"))


def repeated_ids(questions: DataFrame, name: str = "id") -> DataFrame:
    """Ids given more than once: eight digits are not enough for any number of questions."""
    return questions.groupBy(name).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def title_of(context: Column) -> Column:
    return first_line(context)


def join_sources(questions: DataFrame, reports: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """Questions with the report (context) and the fact text (datalog) of their match."""
    return questions.join(reports, key).join(facts, key)


def export_counts(questions: DataFrame) -> DataFrame:
    """Questions per (split, status); status is added or the reason of a skip."""
    return questions.groupBy("split", "status").agg(F.count(F.lit(1)).alias("n"))


def question_records(questions: DataFrame, answers: DataFrame, key: str) -> DataFrame:
    """Question rows with their spans as ``answers`` array; pairs without any are left out
    unless they are unanswerable.

    ``answers`` has (key, no, text, answer_start), one row per span in the order of ``no``.
    The spans of a pair lie in one text, which bounds what is collected.
    """
    grouped = answers.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("no", "text", "answer_start"))).alias("__spans")
    )
    ordered = F.transform(
        "__spans",
        lambda span: F.struct(span["text"].alias("text"), span["answer_start"].alias("answer_start")),
    )
    none = F.array().cast("array<struct<text:string,answer_start:int>>")
    joined = questions.join(grouped, key, "left")
    kept = F.col("__spans").isNotNull() | F.col("is_impossible")
    return (
        joined.withColumn("is_impossible", F.coalesce("is_impossible", F.lit(False)))
        .filter(kept)
        .withColumn("answers", F.when(F.col("is_impossible"), none).otherwise(ordered))
        .drop("__spans")
    )


RECORD = ("rule", "category", "question", "answertype", "query", "id", "is_impossible", "answers")


def nested_documents(records: DataFrame, documents: DataFrame, key: str) -> DataFrame:
    """One row (version, split, data) per document; ``data`` holds the one document.

    ``documents`` has (key, split, context, datalog); documents without questions stay. The
    questions of a document are bounded by the cap of questions per match.
    """
    fields = [F.col(c).alias("datalog" if c == "query" else c) for c in RECORD]
    ordered = F.struct("id", "question", F.struct(*fields).alias("qa"))
    grouped = records.groupBy(key).agg(F.array_sort(F.collect_list(ordered), _by_id).alias("qas"))
    grouped = grouped.withColumn("qas", F.transform("qas", lambda item: item["qa"]))
    joined = documents.join(grouped, key, "left")
    none = F.array().cast(grouped.schema["qas"].dataType)
    paragraph = F.struct(
        strip(F.col("context")).alias("context"),
        strip(F.col("datalog")).alias("datalog"),
        F.coalesce("qas", none).alias("qas"),
    )
    document = F.struct(title_of(F.col("context")).alias("title"), F.array(paragraph).alias("paragraphs"))
    return joined.select(F.lit(VERSION).alias("version"), "split", F.array(document).alias("data"))


def _by_id(left: Column, right: Column) -> Column:
    def compared(name: str) -> Column:
        return F.when(left[name] < right[name], -1).when(left[name] > right[name], 1)

    return F.coalesce(compared("id"), compared("question"), F.lit(0))


def write_documents(nested: DataFrame, folder: str) -> None:
    """JSON lines {version, split, data} in one folder per split."""
    named = nested.withColumn("folder", F.col("split"))
    named.write.mode("overwrite").partitionBy("folder").json(folder)


# The columns of an exported document.
DOCUMENT = (
    "version STRING, split STRING, data ARRAY<STRUCT<title: STRING, paragraphs: ARRAY<STRUCT<context: STRING, "
    "datalog: STRING, qas: ARRAY<STRUCT<rule: STRING, category: STRING, question: STRING, answertype: STRING, "
    "datalog: STRING, id: STRING, is_impossible: BOOLEAN, answers: ARRAY<STRUCT<text: STRING, answer_start: INT>>>>>>>>"
)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Exported documents as they were written. The schema is given, so nothing is inferred, and a line that is no document fails."""
    return spark.read.schema(DOCUMENT).option("mode", "FAILFAST").json(folder).select("version", "split", "data")
