"""New files only: fact files that arrived since the last run."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from matchlore.operators.facts import maps_to_facts
from matchlore.sources.fact_text import fact_maps, match_id_of_path


def take_new_fact_files(spark: SparkSession, source: str, target: str, state: str) -> None:
    """Appends the facts of files not taken before to a parquet folder and returns.

    The stream's checkpoint in ``state`` (a folder all executors share) knows
    which files are done, so a run that is broken off is taken up again.
    """
    files = (
        spark.readStream.option("recursiveFileLookup", "true")
        .text(source, wholetext=True)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    )
    texts = files.select(match_id_of_path(F.col("path")).alias("match_id"), "text")
    facts = maps_to_facts(fact_maps(texts, "match_id"), "match_id")
    query = (
        facts.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
