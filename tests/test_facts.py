import os

import pytest
from pyspark.sql import functions as F

from matchlore.operators import facts as fx
from matchlore.sources import fact_text as ft

TEXT = '''
;;# data
[
{:match/id "match_3"
:match/score "1:0"}

{:event/type "goal"
:event/player1 "Jo \\"El\\" {O}"
:event/minute -4}

]
'''


def test_scan_fact_text(spark):
    texts = spark.createDataFrame([(3, TEXT), (4, "[\n]")], "match_id bigint, text string")
    got = fx.maps_to_facts(ft.fact_maps(texts, "match_id"), "match_id").collect()
    assert {tuple(r) for r in got} == {
        (3, 2, "match/id", "match_3"), (3, 2, "match/score", "1:0"), (3, 3, "event/type", "goal"),
        (3, 3, "event/player1", 'Jo "El" {O}'), (3, 3, "event/minute", "-4"),
    }


def test_written_text_reads_back(spark, tmp_path):
    texts = spark.createDataFrame([(3, TEXT)], "match_id bigint, text string")
    maps = ft.fact_maps(texts, "match_id")
    lines = maps.select(
        "match_id", (F.col("entity_id") - 2).alias("pos"), ft.render_entries(F.col("entries")).alias("line")
    )
    written = ft.fact_texts(lines, "match_id")
    assert written.count() == 1
    folder = tmp_path / "facts"
    folder.mkdir()
    (folder / "report_3.dl").write_text(written.first()["text"])
    files = ft.read_fact_files(spark, str(folder))
    read = files.select(ft.match_id_of_path(F.col("path")).alias("match_id"), "text")
    again = fx.maps_to_facts(ft.fact_maps(read, "match_id"), "match_id")
    assert set(again.collect()) == set(fx.maps_to_facts(maps, "match_id").collect())


def test_a_long_match_keeps_its_entities_apart(spark):
    maps = spark.range(5000).select(
        F.lit(1).alias("match_id"), F.col("id").alias("pos"),
        F.format_string('{:event/id "%d"}', "id").alias("line"),
    )
    read = fx.maps_to_facts(ft.fact_maps(ft.fact_texts(maps, "match_id"), "match_id"), "match_id")
    assert read.filter("entity_id <> CAST(value AS BIGINT) + 2").count() == 0
    assert read.select("entity_id").distinct().count() == 5000


def facts(spark):
    rows = [
        (1, 2, "event/type", "card"), (1, 2, "event/minute", "5"), (1, 3, "event/type", "card"),
        (1, 4, "event/type", "goal"), (1, 4, "event/minute", "9"), (2, 2, "event/type", "goal"),
    ]
    return spark.createDataFrame(rows, "match_id bigint, entity_id bigint, attr string, value string")


def test_count_of_pattern(spark):
    f = facts(spark)
    both = fx.all_patterns(fx.pattern(f, "event/minute"), fx.pattern(f, "event/type", "card"))
    once = fx.entities_where(f, {"event/type": "card"}, ["event/minute"])
    kept = fx.entities_where(f, {"event/type": "card"}, values={"minute": "event/minute"})
    assert [tuple(r) for r in kept.collect()] == [(1, 2, "5")]
    # A match without any is not in the result.
    assert [tuple(r) for r in fx.entity_count(both).collect()] == [(1, 1)]
    assert [tuple(r) for r in fx.entity_count(once).collect()] == [(1, 1)]


def test_wide_and_back(spark):
    f = facts(spark)
    wide = fx.facts_to_wide(f, ["event/type", "event/minute"])
    long = fx.wide_to_facts(wide, {"event/type": "event/type", "event/minute": "event/minute"})
    assert set(long.collect()) == set(f.collect())


def test_chain_falls_through(spark):
    first = spark.createDataFrame([(1, "a"), (2, "b")], "match_id bigint, value string")
    second = spark.createDataFrame([(1, "c")], "match_id bigint, value string")
    loose = fx.chained(first, second, key="match_id").collect()
    strict = fx.chained(first, second, key="match_id", strict=True).collect()
    assert {tuple(r) for r in loose} == {(1, "c"), (2, "b")}
    assert {tuple(r) for r in strict} == {(1, "c"), (2, None)}


def test_match_facts_are_copied_unless_present(spark):
    rows = [
        (1, 2, "match/league", "L"), (1, 3, "event/type", "goal"), (1, 4, "event/type", "card"),
        (1, 4, "match/league", "own"),
    ]
    f = spark.createDataFrame(rows, "match_id bigint, entity_id bigint, attr string, value string")
    got = {tuple(r) for r in fx.copied_match_facts(f.filter("value <> 'own'")).collect()}
    assert (1, 3, "match/league", "L") in got and len(got) == 5


def test_compare_and_set(spark):
    f = facts(spark).filter("attr = 'event/minute'")
    change = spark.createDataFrame(
        [(1, 2, "event/minute", "5", "6"), (1, 4, "event/minute", "5", "6")],
        "match_id bigint, entity_id bigint, attr string, expected string, new string",
    )
    got = {(r["entity_id"], r["value"]) for r in fx.compare_and_set(f, change).collect()}
    assert got == {(2, "6"), (4, "9")}


def test_folder_of_fact_files(spark, tmp_path):
    """A small folder with subfolders: match first, quotes in values, names with dots, an empty file and one without a number."""
    bodies = {
        "a/match_11.dl": '{:match/id "match_11"\n:match/score "2:1"}\n\n' + "\n\n".join(
            f'{{:event/type "{kind}"\n:event/team "{team}"\n:event/minute {minute}\n:event/elapsed {minute}\n:event/elapsed_plus 0}}'
            for kind, team, minute in (("goal", "home", 4), ("card", "away", 30), ("goal", "away", 44), ("corner", "home", 61), ("goal", "home", 90))
        ),
        "a/match_12.dl": '{:match/id "match_12"\n:match/score "0:0"}\n\n{:event/type "card"\n:event/player1 "O\\"N {x} \\\\ :y 1"\n:event/minute 7}',
        "b/c/match_13.dl": '{:match/id "match_13"\n:match/score "0:0"\n:match/note ""}',
        "b/match_14.dl": "",
        "b/readme.dl": '{:match/id "none"}',
    }
    for name, body in bodies.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(f"\n;;# data\n[\n{body}\n\n]\n\n")
    files = ft.read_fact_files(spark, str(tmp_path))
    assert files.count() == 5
    texts = files.select(ft.match_id_of_path(F.col("path")).alias("match_id"), "text")
    maps = ft.fact_maps(texts, "match_id")
    found = fx.maps_to_facts(maps, "match_id")
    by_match = {r["match_id"]: (r["e"], r["f"]) for r in found.groupBy("match_id").agg(
        F.countDistinct("entity_id").alias("e"), F.count("*").alias("f")).collect()}
    assert by_match == {11: (6, 27), 12: (2, 5), 13: (1, 3), None: (1, 1)}
    assert {r["value"] for r in found.where("attr = 'event/player1'").collect()} == {'O"N {x} \\ :y 1'}
    assert [r["value"] for r in found.where("attr = 'match/note'").collect()] == [""]
    goals = found.where("attr = 'event/type' AND value = 'goal'").select("match_id", "entity_id").join(
        found.where("attr = 'event/team'"), ["match_id", "entity_id"]).groupBy("match_id").pivot("value", ["home", "away"]).count()
    assert [tuple(r) for r in goals.collect()] == [(11, 2, 1)]
    again = fx.maps_to_facts(ft.fact_maps(ft.fact_texts(maps.select(
        "match_id", (F.col("entity_id") - 2).alias("pos"), ft.render_entries(F.col("entries")).alias("line")), "match_id"), "match_id"), "match_id")
    assert sorted(map(str, again.collect())) == sorted(map(str, found.collect()))


@pytest.mark.skipif("FACT_CORPUS_DIR" not in os.environ, reason="no fact corpus given")
def test_fact_corpus_invariants(spark):
    """Totals and rules that hold in the published corpus of 7,472 files."""
    files = ft.read_fact_files(spark, os.environ["FACT_CORPUS_DIR"])
    texts = files.select(ft.match_id_of_path(F.col("path")).alias("match_id"), "text")
    maps = ft.fact_maps(texts, "match_id").cache()
    all_facts = fx.maps_to_facts(maps, "match_id").cache()
    assert (maps.count(), all_facts.count()) == (69_767, 740_113)
    kinds = dict(map(tuple, all_facts.filter("attr = 'event/type'").groupBy("value").count().collect()))
    assert kinds == {
        "card": 26_380, "goal": 16_516, "foulcommit": 6_052, "cross": 5_884, "shotoff": 2_720,
        "shoton": 2_410, "corner": 2_333,
    }
    attrs = ["event/type", "event/team", "event/minute", "event/elapsed", "event/elapsed_plus",
             "event/sortorder", "event/id"]
    wide = fx.facts_to_wide(all_facts, attrs + ["match/score"])
    events = wide.filter("`event/type` IS NOT NULL").select(
        "match_id", "entity_id", *[F.col(f"`{a}`").alias(a.split("/")[1]) for a in attrs]
    ).cache()
    assert events.filter("int(minute) <> int(elapsed) + int(elapsed_plus)").count() == 0
    # The stored order is the canonical one; on equal keys a cross precedes its corner.
    from matchlore.operators.events import order_events

    ordered = order_events(
        events.withColumn("minute", F.col("minute").cast("int"))
        .withColumn("sortorder", F.col("sortorder").cast("int"))
        .withColumn("event_id", F.substring_index("id", "_", -1))
        .withColumn("kind_no", F.when(F.col("type") == "corner", 1).otherwise(0))
        .withColumn("position", F.lit(0))
    )
    assert ordered.filter("pos + 2 <> entity_id").count() == 0
    goals = events.filter("type = 'goal'").groupBy("match_id").agg(
        F.concat_ws(":", F.count_if(F.col("team") == "home"), F.count_if(F.col("team") == "away")).alias("counted")
    )
    scores = wide.filter("`match/score` IS NOT NULL").select("match_id", F.col("`match/score`").alias("score"))
    joined = scores.join(goals, "match_id", "left").fillna("0:0", ["counted"])
    assert joined.filter("score <> counted").count() == 0
    short = texts.filter(F.size(F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")) >= 50)
    assert short.count() == 5_552
