import pytest
from pyspark.sql import functions as F

from matchlore.operators import events as ev
from matchlore.operators import model
from matchlore.sources.xml_events import event_documents, event_elements


def element(**tags):
    body = "".join(f"<{k}>{v}</{k}>" for k, v in tags.items())
    return f"<value>{body}</value>"


def parsed(spark, *texts, **options):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id bigint, goal string")
    return ev.event_fields(event_elements(event_documents(rows, kinds=["goal"])), **options)


def test_fields_from_xml(spark):
    xml = "<goal>" + element(
        Id=7, ELAPSED=45, elapsed_plus=2, sortorder=-1, n=295, comment="x", player1=" Unknown Player ",
        event_incident_typefk=3, type="goal", subtype="a &amp; b", card_type="", other="kept",
        stats="<a>1</a>",
    ) + "</goal>"
    row = parsed(spark, xml).first().asDict()
    assert (row["event_id"], row["minute"], row["sortorder"]) == ("7", 47, -1)
    assert (row["event_type"], row["event_type_id"], row["subtype"]) == ("goal", "3", "a & b")
    assert row["card_type"] is None and row["player1"] == "Unknown Player"
    assert row["extra"] == {"other": "kept"}


@pytest.mark.parametrize("blank", [None, "", "  \n", "<goal />", "<goal></goal>"])
def test_blank_documents_have_no_events(spark, blank):
    assert parsed(spark, blank).count() == 0


def test_malformed_fails(spark):
    with pytest.raises(Exception, match="MALFORMED"):
        parsed(spark, "<goal><value>").collect()


def test_numbers_strict_or_null(spark):
    xml = "<goal>" + element(id=1, elapsed="x") + "</goal>"
    assert parsed(spark, xml, strict=False).first()["elapsed"] is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        parsed(spark, xml).collect()


def test_event_ids_sort_as_text(spark):
    rows = [(1, 4, 0, i, 0, n) for n, i in enumerate(["9", "10", "2"])]
    df = spark.createDataFrame(
        rows, "match_id int, minute int, sortorder int, event_id string, kind_no int, position int"
    )
    got = ev.order_events(df).orderBy("pos").select("event_id").collect()
    assert [r[0] for r in got] == ["10", "2", "9"]


TEAMS = [(1, 100, "Home", "H"), (2, 200, "Away", "A"), (3, 300, "Else", "E"), (9, 100, "Second", "S")]
PLAYERS = [(11, 1, "Ana"), (12, 2, "Bo")]


@pytest.fixture
def world(spark):
    teams = spark.createDataFrame(
        TEAMS, "id bigint, team_api_id bigint, team_long_name string, team_short_name string"
    )
    players = spark.createDataFrame(PLAYERS, "id bigint, player_api_id bigint, player_name string")
    overview = spark.createDataFrame(
        [(m, "Home", "Away") for m in (1, 2, 3)], "match_id bigint, hometeam string, awayteam string"
    )
    good = element(id=1, elapsed=1, team=100, player1=1)
    bad_last = element(id=2, elapsed=80, team=300)
    deleted = element(id=3, elapsed=90, team=200, **{"del": 1})
    no_team = element(id=4, elapsed=2)
    docs = {
        1: f"<card>{good}{no_team}{deleted}</card>",
        2: f"<card>{good}{bad_last}</card>",
        3: "<card>" + element(id=5, elapsed=3, team=200, player1=77, card_type="y2") + "</card>",
    }
    matches = spark.createDataFrame(
        [(m, x) + (None,) * 7 for m, x in docs.items()],
        "id bigint, card string, goal string, shoton string, shotoff string, foulcommit string, "
        "cross string, corner string, possession string",
    )
    return matches, overview, teams, players


@pytest.mark.parametrize("whole, want", [(True, {(1, "1"), (3, "5")}), (False, {(1, "1"), (2, "1"), (3, "5")})])
def test_usable_events(world, whole, want):
    got = ev.match_events(*world, whole_match_rule=whole).collect()
    assert {(r["match_id"], r["event_id"]) for r in got} == want
    by_match = {r["match_id"]: r for r in got}
    assert by_match[1]["team"] == "home" and by_match[1]["player1"]["name"] == "Ana"
    assert by_match[3]["card_type"] == "y"
    assert tuple(by_match[3]["player1"]) == (77, "unknown", False)


def test_empty_possession_is_invalid(spark):
    df = spark.createDataFrame(
        [("home", "possession", None, None), ("home", "possession", "1", None), ("home", "card", None, None)],
        "team string, event_kind string, homepos string, awaypos string",
    )
    assert [r[0] for r in df.select(ev.is_invalid()).collect()] == [True, False, False]


def test_first_team_of_a_key_wins(spark, world):
    keys = spark.createDataFrame([(100,), (400,), (None,)], "k bigint")
    got = model.lookup_team(keys, "k", world[2], "t").orderBy(F.desc_nulls_last("k")).collect()
    assert [(r["k"], r["t_longname"]) for r in got] == [(400, None), (100, "Home"), (None, None)]


def test_lineup_skips_missing_slots(spark, world):
    matches = spark.createDataFrame(
        [(1, 1.0, float("nan"), None, 5.0)],
        "id bigint, home_player_1 double, home_player_2 double, away_player_1 double, away_player_2 double",
    )
    got = model.lineups(matches, world[3], slots=(1, 2)).orderBy("side").collect()
    assert [(r["side"], r["slot"], r["id"], r["name"], r["valid"]) for r in got] == [
        ("away", 2, 5, "unknown", False), ("home", 1, 11, "Ana", True),
    ]


def test_score_counts_goal_events(spark):
    matches = spark.createDataFrame([(1, 9, 9), (2, 4, 1)], "match_id bigint, home_goals int, away_goals int")
    goals = spark.createDataFrame(
        [(1, "goal", "home"), (1, "goal", "away"), (1, "goal", "home"), (1, "card", "home")],
        "match_id bigint, event_kind string, team string",
    )
    got = {r["match_id"]: r["score"] for r in model.recomputed_score(matches, goals).collect()}
    assert got == {1: "2:1", 2: "0:0"}


def test_texts_that_begin_with_a_written_bracket(spark):
    xml = (
        "<goal><value><subtype>&lt;3 fans</subtype><a>&#60;x&#x3C;</a><b><![CDATA[<i>y]]></b><c><d>1</d></c>"
        "<e>  <f>2</f></e><g/></value></goal>"
    )
    frame = spark.createDataFrame([(1, "goal", 0, xml)], "match_id int, event_kind string, kind_no int, xml string")
    (row,) = event_elements(frame).collect()
    filled = {k: v for k, v in row["tags"].items() if v}
    assert filled == {"subtype": "<3 fans", "a": "<x<", "b": "<i>y"}
