"""A third and more of the rows on one key, with dimensions too large to broadcast."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from sabermill.operators import merge as m
from sabermill.plans import intermediate, marts

GAMES = 30000


@pytest.fixture
def large_dimensions(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def skewed_games(spark):
    """Most games at one home team, and no save pitcher in most of them."""
    n = F.col("id")
    return spark.range(GAMES, numPartitions=8).select(
        n.alias("game_pk"), F.lit("R").alias("game_type"), F.lit(2024).alias("season"),
        F.lit(None).cast("date").alias("game_date"),
        F.lit(None).cast("timestamp").alias("game_datetime"),
        F.lit("F").alias("game_status_code"),
        F.when(n % 3 == 0, n % 40).otherwise(7).alias("home_team_id"),
        (n % 40).alias("away_team_id"),
        (n % 11).cast("int").alias("home_score"), (n % 7).cast("int").alias("away_score"),
        F.lit(1).alias("venue_id"), F.sha2(n.cast("string"), 256).alias("venue_name"),
        (n % 300).alias("winning_pitcher_id"), (n % 301).alias("losing_pitcher_id"),
        F.when(n % 10 == 0, n % 300).alias("save_pitcher_id"), F.lit(9).alias("innings"),
        F.lit("day").alias("day_night"), F.lit("s").alias("series_description"),
        F.lit(1).alias("series_game_number"), F.lit("N").alias("double_header"),
    )


def test_hot_home_team_and_null_pitchers_are_split_and_kept(spark, large_dimensions):
    teams = spark.range(40).select(
        F.col("id").alias("team_id"), F.concat(F.lit("T"), "id").alias("team_full_name"),
        F.concat(F.lit("A"), "id").alias("team_abbreviation"), F.lit("L").alias("league_name"),
        F.when(F.col("id") != 5, "East").alias("division_name"),
    )
    players = spark.range(300).select(
        F.col("id").alias("player_id"), F.concat(F.lit("P"), "id").alias("full_name")
    )
    summary = marts.fct_game_summary(skewed_games(spark), teams, players)
    got = Counter((r.home_team_name, r.save_pitcher_name) for r in summary.collect())
    assert sum(got.values()) == GAMES
    want = Counter(
        (f"T{i % 40 if i % 3 == 0 else 7}", f"P{i % 300}" if i % 10 == 0 else None)
        for i in range(GAMES)
    )
    assert got == want
    assert "skew=true" in summary._jdf.queryExecution().executedPlan().toString()

    standings = intermediate.int_team_standings(
        intermediate.int_game_results(skewed_games(spark)), teams
    )
    played = {r.team_id: r.games_played for r in standings.collect()}
    assert sum(played.values()) == 2 * GAMES and max(played, key=played.get) == 7


def test_merge_with_a_hot_key_and_many_keyless_rows(spark, large_dimensions, rows):
    target = spark.range(2000).select(
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"), F.lit("old").alias("v")
    )
    n = F.col("id")
    batch = spark.range(30000).select(
        n.alias("seq"), F.when(n % 3 == 0, 4).when(n % 3 == 1, n).alias("k"),
        F.concat(F.lit("v"), n).alias("v"),
    )
    merged = m.merge(target, batch, ["k"], "seq")
    assert rows(merged.where("k = 4")) == [(4, "v29997")]
    assert merged.where("k is null").count() == 1000 + 10000
    assert merged.where("k is not null").count() == len(
        {*range(0, 2000, 2), 4, *(i for i in range(30000) if i % 3 == 1)}
    )
