"""Facts (match_id, entity_id, attr, value) and questions put to them.

A pattern asks for entities, so facts are filtered and joined on
(match_id, entity_id); every function answers for all matches at once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ENTITY = ("match_id", "entity_id")
FIRST_ENTITY = 2
# Attributes of a match entity and of an event entity.
MATCH_ATTRS = ("id", "league", "hometeam", "awayteam", "score", "hometeam_goals", "awayteam_goals")
EVENT_ATTRS = (
    "type", "elapsed", "elapsed_plus", "minute", "sortorder", "team", "event_type", "id",
    "match_id", "subtype", "player1", "player2", "goal_type", "card_type",
)
INTEGER_ATTRS = ("elapsed", "elapsed_plus", "minute", "sortorder")


def wide_to_facts(
    wide: DataFrame, attrs: Mapping[str, str], keys: Sequence[str] = ENTITY
) -> DataFrame:
    """Columns to facts, NULLs left out. ``attrs`` maps column to attribute name."""
    texts = wide.select(*keys, *[F.col(c).cast("string").alias(c) for c in attrs])
    names = F.create_map(*[F.lit(item) for pair in attrs.items() for item in pair])
    long = texts.unpivot(list(keys), list(attrs), "__column", "value")
    return long.filter(F.col("value").isNotNull()).select(
        *keys, names[F.col("__column")].alias("attr"), "value"
    )


def facts_to_wide(
    facts: DataFrame, attrs: Sequence[str], keys: Sequence[str] = ENTITY
) -> DataFrame:
    """Facts to one column per named attribute; naming them saves a pass over the data."""
    return facts.groupBy(*keys).pivot("attr", list(attrs)).agg(F.first("value"))


def maps_to_facts(maps: DataFrame, key: str) -> DataFrame:
    """Rows of ``fact_maps`` to facts."""
    return maps.select(key, "entity_id", F.explode("entries").alias("entry")).select(
        key, "entity_id", "entry.attr", "entry.value"
    )


def namespaced(entries: Column) -> Column:
    """Prefixes attribute names: ``match/`` in a map with a non-empty score, else ``event/``.

    A prefix that is there already is replaced.
    """
    bare = F.transform(
        entries,
        lambda item: F.struct(
            F.substring_index(item["attr"], "/", -1).alias("attr"),
            item["value"].alias("value"),
            item["quoted"].alias("quoted"),
        ),
    )
    has_score = F.exists(bare, lambda item: (item["attr"] == "score") & (item["value"] != ""))
    prefix = F.when(has_score, F.lit("match/")).otherwise(F.lit("event/"))
    return F.transform(
        bare,
        lambda item: F.struct(
            F.concat(prefix, item["attr"]).alias("attr"),
            item["value"].alias("value"),
            item["quoted"].alias("quoted"),
        ),
    )


def pattern(facts: DataFrame, attr: str, value: str | None = None, name: str | None = None) -> DataFrame:
    """Entities that have ``attr`` (equal to ``value`` if given); ``name`` keeps the value."""
    wanted = F.col("attr") == attr
    if value is not None:
        wanted = wanted & (F.col("value") == value)
    kept = [F.col("value").alias(name)] if name else []
    return facts.filter(wanted).select(*ENTITY, *kept)


def all_patterns(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Entities that meet every pattern, with the values the patterns keep."""
    for other in others:
        first = first.join(other, list(ENTITY))
    return first


def entities_where(
    facts: DataFrame,
    equal: Mapping[str, str],
    present: Sequence[str] = (),
    values: Mapping[str, str] | None = None,
) -> DataFrame:
    """``all_patterns`` in one grouping, for attributes with one value per entity.

    ``equal`` gives attributes that must have a value, ``present`` attributes
    that must be there, ``values`` the names under which values are kept of
    further attributes that must be there.
    """
    values = dict(values or {})
    attr, value = F.col("attr"), F.col("value")
    tests = [(attr == name) & (value == wanted) for name, wanted in equal.items()]
    tests += [attr == name for name in present]
    any_of = F.lit(False)
    for test in [*tests, attr.isin(*values.values())]:
        any_of = any_of | test
    # Rows that meet no test are dropped before the shuffle; the tests are
    # booleans, which Spark can aggregate by hash.
    grouped = facts.filter(any_of).groupBy(*ENTITY).agg(
        *[F.bool_or(test).alias(f"__{number}") for number, test in enumerate(tests)],
        *[F.max(F.when(attr == name, value)).alias(column) for column, name in values.items()],
    )
    for number in range(len(tests)):
        grouped = grouped.filter(f"__{number}").drop(f"__{number}")
    return grouped.dropna(subset=list(values)) if values else grouped


def entity_count(found: DataFrame, name: str = "n") -> DataFrame:
    """Distinct entities per match. A match without any has no row, not a zero."""
    return found.groupBy("match_id").agg(F.count_distinct("entity_id").alias(name))


def with_parameters(found: DataFrame, parameters: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Keeps rows whose columns equal a parameter row; parameter columns are added."""
    for column, parameter in on.items():
        parameters = parameters.withColumnRenamed(parameter, column)
    return found.join(parameters, list(on))


def follow(found: DataFrame, reference: str, targets: DataFrame, target_key: str) -> DataFrame:
    """From a reference value to the entity it names."""
    return found.join(targets.withColumnRenamed(target_key, reference), reference)


def multi_valued(df: DataFrame, array: str, name: str) -> DataFrame:
    """One row per element of a multi-valued attribute."""
    return df.withColumn(name, F.explode(array)).drop(array)


def first_answer(
    answers: DataFrame, key: str, order: Sequence[Column], value: str = "value"
) -> DataFrame:
    """(key, value, ambiguous): one answer per key by an explicit order.

    An aggregate: each task reduces its rows to one per key before the shuffle.
    """
    ranked = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], F.col(value).alias("v"))
    return answers.groupBy(key).agg(
        F.min(ranked)["v"].alias(value), (F.count(F.lit(1)) > 1).alias("ambiguous")
    )


def chained(*steps: DataFrame, key: str, value: str = "value", strict: bool = False) -> DataFrame:
    """The answer of a chain of questions, one row per key that answered the first.

    An empty last step leaves the answer of the step before in place; with
    ``strict`` it gives NULL instead.
    """
    joined = steps[0].select(key, F.col(value).alias("__v0"))
    for number, step in enumerate(steps[1:], 1):
        joined = joined.join(step.select(key, F.col(value).alias(f"__v{number}")), key, "left")
    names = [f"__v{number}" for number in reversed(range(len(steps)))]
    answer = F.col(names[0]) if strict else F.coalesce(*names)
    return joined.select(key, answer.alias(value))


@dataclass(frozen=True)
class Step:
    """One question of a chain: ``answers`` holds (key, columns) for all keys.

    The columns in ``takes`` must equal the arguments, by position; an answer hands on the columns in ``gives``.
    Of several answers the first by ``order``, then by what it gives, counts.
    """

    answers: DataFrame
    gives: Sequence[str]
    takes: Sequence[str] = ()
    order: Sequence[str] = ()

    def first(self, key: str) -> DataFrame:
        """(key, __take0.., __gives): one answer per key and arguments, reduced before the shuffle."""
        taken = [F.col(c).cast("string").alias(f"__take{i}") for i, c in enumerate(self.takes)]
        gives = F.array(*[F.col(c).cast("string") for c in self.gives]).alias("g")
        rows = self.answers.select(key, *taken, F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(self.order)], gives).alias("__row"))
        by = [key, *[f"__take{i}" for i in range(len(self.takes))]]
        return rows.groupBy(*by).agg(F.min("__row")["g"].alias("__gives"))


def chain(start: DataFrame, steps: Sequence[Step], key: str, arguments: Sequence[str] = ()) -> DataFrame:
    """(key, value, step): the last answer of a chain of any length, and the number of the step that gave it.

    Each step is asked with what the first row of the last answer gave, at the beginning with the ``arguments``
    columns of ``start`` (one row per key). A step without an answer leaves arguments and answer as they are.
    Values are texts; ``value`` is NULL and ``step`` 0 where no step had an answer. A NULL argument equals nothing, and
    one that was not given counts as NULL.
    """
    given = F.array(*[F.col(c).cast("string") for c in arguments]) if arguments else F.array().cast("array<string>")
    none = F.lit(None).cast("array<string>")
    state = start.select(key, given.alias("__args"), none.alias("value"), F.lit(0).alias("step"))
    for number, step in enumerate(steps, 1):
        asked = [F.get("__args", F.lit(i)).alias(f"__take{i}") for i in range(len(step.takes))]
        by = [key, *[f"__take{i}" for i in range(len(step.takes))]]
        found = state.select("*", *asked).join(step.first(key), by, "left")
        state = found.select(
            key,
            F.coalesce("__gives", "__args").alias("__args"),
            F.coalesce("__gives", "value").alias("value"),
            F.when(F.col("__gives").isNotNull(), number).otherwise(F.col("step")).alias("step"),
        )
    return state.drop("__args")


def with_match_facts(events: DataFrame, matches: DataFrame, key: str = "match_id") -> DataFrame:
    """Match columns copied to every event of the match; an event's own value wins."""
    shared = [c for c in matches.columns if c in events.columns and c != key]
    renamed = matches.select(
        key, *[F.col(c).alias(f"__{c}" if c in shared else c) for c in matches.columns if c != key]
    )
    joined = events.join(renamed, key, "left")
    for column in shared:
        joined = joined.withColumn(column, F.coalesce(column, f"__{column}"))
    return joined.drop(*[f"__{c}" for c in shared])


def copied_match_facts(facts: DataFrame) -> DataFrame:
    """Facts in which every event also carries its match's facts, unless it has that attribute.

    Only patterns that mix both kinds need this; ask the plain facts otherwise.
    """
    on_match = F.col("attr").startswith("match/")
    owner = facts.filter(on_match)
    events = facts.filter(~on_match).select(*ENTITY).distinct()
    copied = owner.select("match_id", "attr", "value").join(events, "match_id")
    own = facts.select(*ENTITY, "attr")
    missing = copied.join(own, [*ENTITY, "attr"], "left_anti")
    return facts.unionByName(missing.select(*facts.columns))


def add_facts(facts: DataFrame, more: DataFrame) -> DataFrame:
    """Set union: adding a known fact changes nothing."""
    return facts.unionByName(more).distinct()


def compare_and_set(
    facts: DataFrame, updates: DataFrame, keys: Sequence[str] = (*ENTITY, "attr")
) -> DataFrame:
    """Sets ``new`` where the value is still ``expected``, all facts at once.

    Updates are joined by key and expected value; of several that expect the same the least ``new`` is
    set. See ``changes.compare_and_set_in_order`` for updates that follow one another.
    """
    single = updates.groupBy(*keys, "expected").agg(F.min("new").alias("__new"), F.lit(True).alias("__update"))
    single = single.withColumnsRenamed({key: f"__of_{key}" for key in keys})
    on = F.col("value").eqNullSafe(F.col("expected"))
    for key in keys:
        on = on & (F.col(key) == F.col(f"__of_{key}"))
    joined = facts.join(single, on, "left")
    changed = F.when(F.col("__update"), F.col("__new")).otherwise(F.col("value"))
    return joined.select(*keys, changed.alias("value"))


def match_entities(matches: DataFrame) -> DataFrame:
    """Matches as fact entities, with the attribute names of a match map."""
    return matches.select(
        "match_id",
        F.lit(FIRST_ENTITY).cast("bigint").alias("entity_id"),
        F.concat(F.lit("match_"), F.col("match_id").cast("string")).alias("id"),
        "league",
        "hometeam",
        "awayteam",
        "score",
        F.col("home_goals").alias("hometeam_goals"),
        F.col("away_goals").alias("awayteam_goals"),
    )


def event_entities(events: DataFrame) -> DataFrame:
    """Numbered events (pos from 1) as fact entities behind their match."""
    return events.select(
        F.col("match_id"),
        (F.col("pos") + FIRST_ENTITY).alias("entity_id"),
        F.col("event_kind").alias("type"),
        "elapsed",
        "elapsed_plus",
        "minute",
        F.coalesce("sortorder", F.lit(0)).alias("sortorder"),
        "team",
        "event_type",
        F.concat(F.lit("event_"), F.col("event_id")).alias("id"),
        "subtype",
        F.col("player1.name").alias("player1"),
        F.col("player2.name").alias("player2"),
        "goal_type",
        "card_type",
    )


def facts_of(matches: DataFrame, events: DataFrame) -> DataFrame:
    """All facts of scored matches and their numbered events."""
    match_facts = wide_to_facts(
        match_entities(matches), {name: f"match/{name}" for name in MATCH_ATTRS}
    )
    owner = F.concat(F.lit("match_"), F.col("match_id").cast("string"))
    wide = event_entities(events).withColumn("owner", owner)
    names = {name: f"event/{name}" for name in EVENT_ATTRS if name != "match_id"}
    return match_facts.unionByName(wide_to_facts(wide, {**names, "owner": "event/match_id"}))


def entity_entries(wide: DataFrame, attrs: Mapping[str, str], numbers: Sequence[str]) -> Column:
    """Columns as the (attr, value, quoted) array that ``render_entries`` takes."""
    return F.array(
        *[
            F.struct(
                F.lit(name).alias("attr"),
                wide[column].cast("string").alias("value"),
                F.lit(column not in numbers).alias("quoted"),
            )
            for column, name in attrs.items()
        ]
    )
