"""Rules that turn a row into text: chosen by condition, first or sampled.

A rule set is a short list written by hand (it is code, not data), so it becomes
columns of one projection: no join, no shuffle, one pass over the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlore.functions.sampling import pick, seed_hash
from matchlore.functions.text import strip, strip_each_line


@dataclass(frozen=True)
class Rule:
    """``condition`` and ``body`` are Spark SQL expressions over the row.

    A body may have several lines, each of them one way to say the same.
    """

    ruleset: str
    target: str
    rule_id: str
    condition: str
    body: str
    category: str = "-"
    answertype: str = "-"


def for_target(rules: Sequence[Rule], target: str) -> list[Rule]:
    return [rule for rule in rules if rule.target == target]


def rule_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    columns = ("ruleset", "target", "rule_id", "category", "answertype")
    rows = [F.struct(*[F.lit(getattr(r, c)).alias(c) for c in columns]) for r in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def rules_per_ruleset(table: DataFrame) -> DataFrame:
    return table.groupBy("ruleset").agg(F.count(F.lit(1)).alias("rules"))


def unpaired_rules(table: DataFrame, asked: str = "text", answered: str = "datalog") -> DataFrame:
    """Rules to ask with that have no rule to answer with under the same id."""
    known = table.filter(F.col("target") == answered).select("rule_id")
    return table.filter(F.col("target") == asked).join(known, "rule_id", "left_anti")


def paired_rules(table: DataFrame, asked: str = "text", answered: str = "datalog") -> DataFrame:
    """Asking and answering rules under one id; raises if a partner is missing."""
    missing = unpaired_rules(table, asked, answered).select("rule_id").limit(5).collect()
    if missing:
        raise ValueError(f"no {answered} rule for {[row['rule_id'] for row in missing]}")
    partner = table.filter(F.col("target") == answered).select(
        "rule_id", F.col("ruleset").alias("partner_ruleset")
    )
    return table.filter(F.col("target") == asked).join(partner, "rule_id")


def any_applies(rules: Sequence[Rule]) -> Column:
    """Whether some rule fits. A filter on this is cheap; one on the rendered rule
    would make Spark render twice."""
    fits = F.lit(False)
    for rule in rules:
        fits = fits | F.coalesce(F.expr(rule.condition), F.lit(False))
    return fits


def applicable(rules: Sequence[Rule]) -> Column:
    """Array of (rule_id, category, answertype, body) of the rules whose condition holds."""
    offers = [
        F.when(
            F.expr(rule.condition),
            F.struct(
                F.lit(rule.rule_id).alias("rule_id"),
                F.lit(rule.category).alias("category"),
                F.lit(rule.answertype).alias("answertype"),
                F.expr(rule.body).alias("body"),
            ),
        )
        for rule in rules
    ]
    return F.filter(F.array(*offers), lambda offer: offer.isNotNull())


def render(
    df: DataFrame, rules: Sequence[Rule], keys: Sequence[str] = (), seed: int | None = None
) -> DataFrame:
    """Adds ``rule STRUCT<rule_id, category, answertype, body>``, NULL if no rule fits.

    The first fitting rule without a seed; with one, a fitting rule drawn by the keys.
    """
    offers = applicable(rules)
    if seed is None:
        return df.withColumn("rule", F.get(offers, F.lit(0)))
    hashed = seed_hash(seed, *[F.col(key) for key in keys])
    ranked = F.transform(
        offers,
        lambda offer: F.struct(
            F.md5(F.concat_ws(":", hashed, offer["rule_id"])).alias("draw"), offer.alias("rule")
        ),
    )
    return df.withColumn("rule", F.array_min(ranked)["rule"])


def with_text(rendered: DataFrame, name: str = "text") -> DataFrame:
    """The body of the chosen rule with every line stripped; the rest of the rule as columns."""
    return rendered.withColumn(name, strip_each_line(strip(F.col("rule.body"))))


def variant(text: Column, seed: int, *keys: Column) -> Column:
    """One line of a multi-line text, drawn by seed and keys."""
    return pick(F.split(text, "\n"), seed, *keys)
