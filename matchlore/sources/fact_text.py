"""Fact files: one text per match holding attribute maps, the match first.

    ;;# data
    [
    {:match/id "match_1"
    :match/score "2:0"}

    {:event/type "goal"
    :event/minute 7}

    ]
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_QUOTED = r'"(?:[^"\\]++|\\.)*+"'
_MAP = r'\{((?:[^"{}]++|' + _QUOTED + r')*+)\}'
_ENTRY = r':([^\s"{}]+)\s+(' + _QUOTED + r'|[^\s"{}]+)'
HEAD, OPEN, CLOSE = ";;# data", "[", "]"


def read_fact_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, text) per file. Takes a folder, not a glob: a glob is listed path by path.

    A low ``spark.sql.files.openCostInBytes`` lets many small files share a task.
    """
    return (
        spark.read.option("recursiveFileLookup", "true")
        .text(folder, wholetext=True)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    )


def match_id_of_path(path: Column) -> Column:
    """The number a report, fact or question file, or a folder with its parts, carries in its name."""
    return F.regexp_extract(path, r"_(\d+)\.\w+(?:/[^/]*)?$", 1).try_cast("bigint")


def fact_maps(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """One row (key, entity_id, entries) per map; entities count from 2 in file order.

    ``entries`` is an array of (attr, value, quoted) in the order of the text.
    """
    maps = F.regexp_extract_all(F.col(text), F.lit(_MAP), F.lit(1))
    # The outer form: the plain one makes Spark search once more to filter by size.
    exploded = texts.select(key, F.posexplode_outer(maps).alias("__at", "__map")).filter(
        F.col("__at").isNotNull()
    )
    names = F.regexp_extract_all("__map", F.lit(_ENTRY), F.lit(1))
    values = F.regexp_extract_all("__map", F.lit(_ENTRY), F.lit(2))

    def entry(name: Column, value: Column) -> Column:
        quoted = value.startswith('"')
        inner = F.regexp_replace(
            F.regexp_replace(value, r'^"|"$', ""), r'\\(["\\])', "$1"
        )
        return F.struct(
            name.alias("attr"),
            F.when(quoted, inner).otherwise(value).alias("value"),
            quoted.alias("quoted"),
        )

    return exploded.select(
        key,
        (F.col("__at") + 2).alias("entity_id"),
        F.zip_with(names, values, entry).alias("entries"),
    )


def render_entries(entries: Column) -> Column:
    """An array of (attr, value, quoted) as one map text."""

    def entry(item: Column) -> Column:
        escaped = F.regexp_replace(item["value"], r'(["\\])', r"\\$1")
        value = F.when(item["quoted"], F.concat(F.lit('"'), escaped, F.lit('"')))
        return F.concat_ws(" ", F.concat(F.lit(":"), item["attr"]), value.otherwise(item["value"]))

    filled = F.filter(entries, lambda item: item["value"].isNotNull())
    return F.concat(F.lit("{"), F.array_join(F.transform(filled, entry), "\n"), F.lit("}"))


def fact_texts(maps: DataFrame, key: str) -> DataFrame:
    """(key, text): the fact text of a match from its map lines.

    ``maps`` has (key, pos, line). A text is one row, as it is one file: entities are
    numbered by their place in it.
    """
    grouped = maps.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("lines"))
    body = F.array_join(F.transform("lines", lambda item: item["line"]), "\n\n")
    return grouped.select(
        key, F.concat(F.lit(f"\n{HEAD}\n{OPEN}\n"), body, F.lit(f"\n\n{CLOSE}\n\n")).alias("text")
    )
