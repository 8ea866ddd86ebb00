"""The given tables read as matches, teams, players, events and texts.

Each function has its SQL twin below it, so that a query and its check start
from the same rows. All of them keep every row of the table they read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlore.functions.text import WHITE_SPACE
from matchlore.sources.tables import read_table

SEED = 42


def strip_sql(text: str) -> str:
    return f"trim({text}, '{WHITE_SPACE}')"


def countries(spark: SparkSession, folder: str) -> DataFrame:
    """Regions as countries."""
    region = read_table(spark, folder, "region", "r_regionkey", "r_name")
    return region.select(F.col("r_regionkey").cast("bigint").alias("id"), F.col("r_name").alias("name"))


def leagues(spark: SparkSession, folder: str) -> DataFrame:
    """Nations as leagues; one whose key is a multiple of seven has no country."""
    nation = read_table(spark, folder, "nation", "n_nationkey", "n_name", "n_regionkey")
    country = F.when(F.col("n_nationkey") % 7 != 0, F.col("n_regionkey"))
    return nation.select(
        F.col("n_nationkey").cast("bigint").alias("id"),
        F.col("n_name").alias("name"),
        country.cast("bigint").alias("country_id"),
    )


def teams(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as teams."""
    supplier = read_table(spark, folder, "supplier", "s_suppkey", "s_name", "s_nationkey")
    key = F.col("s_suppkey")
    return supplier.select(
        key.alias("id"),
        (key + 1000).alias("team_api_id"),
        F.col("s_name").alias("team_long_name"),
        F.concat(F.lit("S"), key.cast("string")).alias("team_short_name"),
        F.col("s_nationkey").cast("bigint").alias("league_id"),
    )


def players(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as players: some event users have no row."""
    supplier = read_table(spark, folder, "supplier", "s_suppkey", "s_name")
    return supplier.select(
        (F.col("s_suppkey") + 5000).alias("id"),
        F.col("s_suppkey").alias("player_api_id"),
        F.col("s_name").alias("player_name"),
    )


def matches(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as matches; keys of teams reach past the last supplier now and then."""
    orders = read_table(spark, folder, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    goals = F.floor("o_totalprice").cast("bigint")
    return orders.select(
        key.alias("id"),
        (key + 100000).alias("match_api_id"),
        (customer % 6).alias("country_id"),
        (customer % 25).alias("league_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("date"),
        (customer % 110 + 1000).alias("home_team_api_id"),
        (key % 90 + 1000).alias("away_team_api_id"),
        F.when(key % 13 != 0, goals % 4).alias("home_team_goal"),
        (goals % 3).alias("away_team_goal"),
    )


TEAMS_SQL = """teams AS (
  SELECT s_suppkey AS id, s_suppkey + 1000 AS team_api_id, s_name AS team_long_name,
         'S' || s_suppkey AS team_short_name, CAST(s_nationkey AS BIGINT) AS league_id
  FROM supplier)"""

MATCHES_SQL = """matches AS (
  SELECT o_orderkey AS id, o_orderkey + 100000 AS match_api_id, o_custkey % 6 AS country_id,
         o_custkey % 25 AS league_id, o_orderdate AS date, o_custkey % 110 + 1000 AS home_team_api_id,
         o_orderkey % 90 + 1000 AS away_team_api_id,
         CASE WHEN o_orderkey % 13 <> 0 THEN CAST(floor(o_totalprice) AS BIGINT) % 4 END AS home_team_goal,
         CAST(floor(o_totalprice) AS BIGINT) % 3 AS away_team_goal
  FROM orders)"""

LEAGUES_SQL = """leagues AS (
  SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name,
         CASE WHEN n_nationkey % 7 <> 0 THEN CAST(n_regionkey AS BIGINT) END AS country_id
  FROM nation)"""


def match_events(spark: SparkSession, folder: str, spread: bool = False) -> DataFrame:
    """The event stream as match events: a user is a match, ``k`` the minute."""
    events = read_table(spark, folder, "events", spread=spread)
    key = F.col("event_id")
    elapsed = F.get_json_object("props", "$.k").cast("bigint")
    plus = F.when(key % 7 != 0, key % 3)
    return events.select(
        F.col("user_id").alias("match_id"),
        F.col("event_type").alias("event_kind"),
        F.lit(0).alias("kind_no"),
        F.lit(0).alias("position"),
        key.alias("eid"),
        key.cast("string").alias("event_id"),
        elapsed.alias("elapsed"),
        plus.alias("elapsed_plus"),
        (elapsed + F.coalesce(plus, F.lit(0))).alias("minute"),
        F.when(key % 5 != 0, F.floor("value").cast("bigint") % 4).alias("sortorder"),
        F.when(key % 11 != 0, F.when(key % 2 == 0, "home").otherwise("away")).alias("team"),
        F.concat(F.lit("Ana Maria P"), (key % 9).cast("string")).alias("player1"),
        F.when(key % 4 == 0, F.concat(F.lit("Jo O'Q"), (key % 6).cast("string"))).alias("player2"),
        F.when(key % 17 == 0, "1").alias("del"),
        "ts",
        "value",
    )


EVENTS_SQL = """ev AS (
  SELECT user_id AS match_id, event_type AS event_kind, event_id AS eid,
         CAST(event_id AS VARCHAR) AS event_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS elapsed,
         CASE WHEN event_id % 7 <> 0 THEN event_id % 3 END AS elapsed_plus,
         CAST(json_extract_string(props, '$.k') AS BIGINT)
           + CASE WHEN event_id % 7 <> 0 THEN event_id % 3 ELSE 0 END AS minute,
         CASE WHEN event_id % 5 <> 0 THEN CAST(floor(value) AS BIGINT) % 4 END AS sortorder,
         CASE WHEN event_id % 11 <> 0 THEN CASE WHEN event_id % 2 = 0 THEN 'home' ELSE 'away' END END AS team,
         'Ana Maria P' || (event_id % 9) AS player1,
         CASE WHEN event_id % 4 = 0 THEN 'Jo O''Q' || (event_id % 6) END AS player2,
         CASE WHEN event_id % 17 = 0 THEN '1' END AS del, ts, value
  FROM events)"""

# Canonical order of match events.
ORDER_SQL = "minute NULLS LAST, coalesce(sortorder, 0), event_id NULLS FIRST"


def match_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as matches with one goal count per side, some of them unknown."""
    customer = read_table(spark, folder, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    key = F.col("c_custkey")
    return customer.select(
        key.alias("match_id"),
        F.col("c_mktsegment").alias("league"),
        F.col("c_name").alias("hometeam"),
        F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("awayteam"),
        F.when(key % 10 != 0, key % 4).alias("home_goals"),
        (key % 3).alias("away_goals"),
    )


MATCH_NUMBERS_SQL = """mn AS (
  SELECT c_custkey AS match_id, c_mktsegment AS league, c_name AS hometeam,
         'NATION_' || c_nationkey AS awayteam,
         CASE WHEN c_custkey % 10 <> 0 THEN c_custkey % 4 END AS home_goals,
         c_custkey % 3 AS away_goals
  FROM customer)"""
