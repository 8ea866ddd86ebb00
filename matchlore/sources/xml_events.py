"""Event elements out of the XML text columns of the match table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlore.functions.text import strip
from matchlore.operators.model import EVENT_KINDS

# Stand for a written < and for the start of a CDATA section while XML is parsed: what is left of
# < at the start of a value is then a nested element. Neither character is allowed for exchange.
_WRITTEN, _SECTION = "\uFDD0", "\uFDD1"
# A map per element: tags are not known in advance.
ELEMENTS = "value ARRAY<MAP<STRING, STRING>>"


def parse_elements(xml: Column) -> Column:
    """The ``value`` children of the root as tag maps. Malformed XML fails the job.

    A tag with nested elements has no text of its own and gets NULL.
    """
    # Few texts hold a written < and few values a bracket, so each step first looks whether it has anything to do.
    marked = F.when(
        xml.contains("&"), F.regexp_replace(xml, "&lt;|&#0*60;|&#[xX]0*3[cC];", _WRITTEN)
    ).otherwise(xml)
    marked = F.when(
        xml.contains("<![CDATA["), F.replace(marked, F.lit("<![CDATA["), F.lit(f"{_SECTION}<![CDATA["))
    ).otherwise(marked)
    elements = F.from_xml(marked, ELEMENTS, {"mode": "FAILFAST"})["value"]

    def text(_: Column, value: Column) -> Column:
        held = value.contains(_WRITTEN) | value.contains(_SECTION)
        plain = F.when(held, F.translate(value, _WRITTEN + _SECTION, "<")).otherwise(value)
        return F.when(~value.contains("<") | ~strip(value).startswith("<"), plain)

    return F.transform(elements, lambda tags: F.transform_values(tags, text))


def event_documents(
    matches: DataFrame, key: str = "id", kinds: Sequence[str] = EVENT_KINDS
) -> DataFrame:
    """One row (match_id, event_kind, kind_no, xml) per filled event column."""
    kind_number = F.array_position(F.array(*[F.lit(kind) for kind in kinds]), F.col("event_kind"))
    return (
        matches.select(F.col(key).alias("match_id"), *kinds)
        .unpivot("match_id", list(kinds), "event_kind", "xml")
        .filter(F.col("xml").rlike(r"\S"))
        .select("match_id", "event_kind", (kind_number - 1).cast("int").alias("kind_no"), "xml")
    )


def event_elements(documents: DataFrame) -> DataFrame:
    """One row per event element: (match_id, event_kind, kind_no, position, tags)."""
    parsed = documents.select(
        "match_id", "event_kind", "kind_no", parse_elements(F.col("xml")).alias("elements")
    )
    # The outer form: the plain one makes Spark parse once more to filter by size.
    return parsed.select(
        "match_id", "event_kind", "kind_no", F.posexplode_outer("elements").alias("position", "tags")
    ).filter(F.col("position").isNotNull())
