"""Question records as JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUESTION = (
    "category STRING, rule STRING, question STRING, datalog STRING, answer STRING, "
    "answertype STRING, minute STRING, unanswerable BOOLEAN"
)


def read_questions(spark: SparkSession, folder: str) -> DataFrame:
    """Question records with the path of their file; blank lines are skipped, broken ones fail."""
    return (
        spark.read.schema(QUESTION)
        .option("mode", "FAILFAST")
        .option("recursiveFileLookup", "true")
        .json(folder)
        .withColumn("path", F.col("_metadata.file_path"))
    )


def question_of(line: Column) -> Column:
    """One JSON line as a question struct."""
    return F.from_json(line, QUESTION, {"mode": "FAILFAST"})


def write_questions(questions: DataFrame, folder: str) -> None:
    questions.write.mode("overwrite").json(folder)
