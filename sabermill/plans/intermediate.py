"""The five intermediate models."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from sabermill.functions import batting, contact, pitching, team
from sabermill.operators.unpivot import views_of_each_row

FINAL = "F"
REGULAR = "R"
BATTER = "batter"
PITCHER = "pitcher"

_GAME_FACTS = ["game_pk", "game_type", "season", "game_date", "game_datetime"]
_GAME_SETTING = [
    "venue_id", "venue_name", "winning_pitcher_id", "losing_pitcher_id", "save_pitcher_id",
    "innings", "day_night", "series_description", "series_game_number", "double_header",
]
_BATTING_COUNTS = [
    "games_played", "plate_appearances", "at_bats", "runs", "hits", "doubles", "triples",
    "home_runs", "rbi", "stolen_bases", "caught_stealing", "walks", "strikeouts",
    "hit_by_pitch", "sacrifice_bunts", "sacrifice_flies", "intentional_walks", "total_bases",
    "ground_into_double_play",
]
_PITCHING_COUNTS = [
    "wins", "losses", "games", "games_started", "games_finished", "complete_games", "shutouts",
    "saves", "save_opportunities", "holds", "blown_saves", "innings_pitched", "hits_allowed",
    "runs_allowed", "earned_runs", "home_runs_allowed", "walks", "strikeouts", "hit_batsmen",
    "wild_pitches", "balks",
]


def int_game_results(games: DataFrame) -> DataFrame:
    """Final games seen from both sides, two rows per game."""
    home, away = F.col("home_score"), F.col("away_score")

    def side(is_home: bool) -> dict:
        own, other = (home, away) if is_home else (away, home)
        ids = ("home_team_id", "away_team_id") if is_home else ("away_team_id", "home_team_id")
        return {
            "is_home": F.lit(is_home),
            "team_id": F.col(ids[0]),
            "opponent_id": F.col(ids[1]),
            "runs_scored": own,
            "runs_allowed": other,
            "is_win": own > other,
            "is_loss": own < other,
        }

    played = games.where(
        (F.col("game_status_code") == FINAL) & home.isNotNull() & away.isNotNull()
    )
    return views_of_each_row(played, [*_GAME_FACTS, *_GAME_SETTING], [side(True), side(False)])


def int_player_season_batting(stats: DataFrame) -> DataFrame:
    """Regular-season batting of a player over all teams of a season."""
    summed = (
        stats.where(F.col("game_type") == REGULAR)
        .groupBy("player_id", "season")
        .agg(*[F.sum(c).alias(c) for c in _BATTING_COUNTS])
    )
    with_singles = summed.withColumn(
        "singles",
        batting.singles(F.col("hits"), F.col("doubles"), F.col("triples"), F.col("home_runs")),
    )
    return with_singles.select(
        "*",
        batting.batting_average().alias("batting_average"),
        batting.on_base_percentage().alias("on_base_percentage"),
        batting.slugging_percentage().alias("slugging_percentage"),
        batting.on_base_plus_slugging().alias("on_base_plus_slugging"),
        batting.woba().alias("woba"),
    )


def int_player_season_pitching(stats: DataFrame) -> DataFrame:
    """Regular-season pitching of a player over all teams of a season."""
    summed = (
        stats.where(F.col("game_type") == REGULAR)
        .groupBy("player_id", "season")
        .agg(*[F.sum(c).alias(c) for c in _PITCHING_COUNTS])
    )
    return summed.select(
        "*",
        pitching.era().alias("era"),
        pitching.whip().alias("whip"),
        pitching.strikeout_walk_ratio().alias("strikeout_walk_ratio"),
        pitching.per_nine("strikeouts").alias("strikeouts_per_9"),
        pitching.per_nine("walks").alias("walks_per_9"),
        pitching.per_nine("hits_allowed").alias("hits_per_9"),
        pitching.batting_average_against().alias("batting_average_against"),
        pitching.fip().alias("fip"),
    )


def _batted_balls(pitches: DataFrame) -> DataFrame:
    return pitches.where(F.col("play_result").isNotNull() & F.col("exit_velocity").isNotNull())


def contact_metrics(pitches: DataFrame, role: str) -> DataFrame:
    """Batted-ball metrics of one role; what a plan needs that reads one role only."""
    return (
        _batted_balls(pitches)
        .groupBy(F.col(f"{role}_id").alias("player_id"), "season")
        .agg(*contact.totals())
        .select("player_id", "season", F.lit(role).alias("player_role"), *contact.summary())
    )


def int_statcast_metrics(pitches: DataFrame) -> DataFrame:
    """Batted-ball metrics of both roles from one scan of the pitches.

    Both views of a pitch come from a generator: unlike grouping sets it lets a filter on the
    season pass on to the pitches.
    """
    sides = [
        {"player_id": F.col(f"{role}_id"), "player_role": F.lit(role)}
        for role in (BATTER, PITCHER)
    ]
    return (
        views_of_each_row(_batted_balls(pitches), ["season", *contact.MEASURES], sides)
        .groupBy("player_id", "season", "player_role")
        .agg(*contact.totals())
        .select("player_id", "season", "player_role", *contact.summary())
    )


def team_records(results: DataFrame) -> DataFrame:
    won, lost, home = F.col("is_win"), F.col("is_loss"), F.col("is_home")
    return (
        results.where(F.col("game_type") == REGULAR)
        .groupBy("team_id", "season")
        .agg(
            F.count(F.lit(1)).alias("games_played"),
            F.count_if(won).alias("wins"),
            F.count_if(lost).alias("losses"),
            F.sum("runs_scored").alias("runs_scored"),
            F.sum("runs_allowed").alias("runs_allowed"),
            F.count_if(home & won).alias("home_wins"),
            F.count_if(home & lost).alias("home_losses"),
            F.count_if(~home & won).alias("away_wins"),
            F.count_if(~home & lost).alias("away_losses"),
        )
        .withColumn("win_pct", team.win_pct())
    )


def int_team_standings(results: DataFrame, teams: DataFrame) -> DataFrame:
    """Season records with games behind the best team of the division.

    The best share is a window over the handful of teams of a division and season, so a filter on
    the season reaches the games, and building the plan runs no job.
    """
    records = (
        team_records(results)
        .join(teams, "team_id", "inner")
        .select(
            "team_id", "season", "team_full_name", "team_abbreviation", "league_name",
            "division_name", "games_played", "wins", "losses", "win_pct", "runs_scored",
            "runs_allowed",
            (F.col("runs_scored") - F.col("runs_allowed")).alias("run_differential"),
            "home_wins", "home_losses", "away_wins", "away_losses",
        )
    )
    best = F.max("win_pct").over(W.partitionBy("season", "division_name"))
    has_division = F.col("division_name").isNotNull()
    return (
        records.withColumn("best_win_pct", F.when(has_division, best))
        .withColumn("games_behind", team.games_behind())
        .select(*records.columns, "games_behind")
    )
