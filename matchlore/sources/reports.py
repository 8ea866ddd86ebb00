"""Report and fact texts as files, and text files as lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from matchlore.functions.text import strip
from matchlore.sources.runs import RunFolder


def read_lines(spark: SparkSession, folder: str, keep_blank: bool = False) -> DataFrame:
    """(path, line) of all text files in a folder, stripped."""
    lines = spark.read.option("recursiveFileLookup", "true").text(folder).select(
        F.col("_metadata.file_path").alias("path"), strip(F.col("value")).alias("line")
    )
    return lines if keep_blank else lines.filter(F.col("line") != "")


def text_runs(spark: SparkSession, folder: str, key: StructField, text: str) -> RunFolder:
    """The folder that runs add (key, text) rows to, as JSON lines."""
    return RunFolder(spark, folder, StructType([key, StructField(text, StringType())]), key.name, "json")


def write_texts(texts: DataFrame, folder: str, key: str, text: str, run: str | None = None) -> int:
    """Adds the texts that the folder does not have yet, as a run of their own; returns how many.

    Texts of earlier runs stay as they are.
    """
    return text_runs(texts.sparkSession, folder, texts.schema[key], text).add(texts.select(key, text), run)


def write_text_folders(texts: DataFrame, folder: str, key: str, text: str) -> None:
    """The plain text of every key in a folder of its own, which suits small sets only; other keys' folders stay."""
    plain = texts.select(key, F.col(text).alias("value"))
    plain.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).text(folder)
