"""Parquet tables, read with only the columns a job needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The columns of each relational table the jobs use.
TABLE_COLUMNS = {
    "Player": ["id", "player_api_id", "player_name", "birthday"],
    "Player_Attributes": [
        "id", "player_fifa_api_id", "player_api_id", "preferred_foot",
        "attacking_work_rate", "defensive_work_rate",
    ],
    "Country": ["id", "name"],
    "League": ["id", "name", "country_id"],
    "Team": ["id", "team_api_id", "team_long_name", "team_short_name"],
}


def read_table(
    spark: SparkSession, folder: str, name: str, *columns: str, spread: bool = False
) -> DataFrame:
    """``{folder}/{name}.parquet``; the columns default to those listed for the table.

    ``spread`` is for costly work per row: a table of fewer files than cores is dealt
    out to all cores, as each of its files may be read by one task.
    """
    path = f"{folder}/{name}.parquet"
    table = spark.read.parquet(path)
    wanted = list(columns) or TABLE_COLUMNS.get(name)
    table = table.select(*wanted) if wanted else table
    cores = spark.sparkContext.defaultParallelism
    if spread and len(table.inputFiles()) < cores:
        table = table.repartition(cores)
    return table

