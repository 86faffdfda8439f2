"""The seven marts.

No join carries a broadcast hint: Spark broadcasts a dimension when its measured size is under
the session's threshold and otherwise shuffles, splitting hot keys (adaptive skew join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sabermill.functions import batting, pitching, team
from sabermill.operators.ranking import competition_ranks
from sabermill.plans.intermediate import BATTER, FINAL, PITCHER, REGULAR

# Fixed value: batted balls a player needs in a season to be ranked.
MIN_BATTED_BALLS = 50


def dim_players(players: DataFrame, teams: DataFrame) -> DataFrame:
    current = teams.select(
        F.col("team_id").alias("current_team_id"),
        F.col("team_full_name").alias("current_team_name"),
        F.col("team_abbreviation").alias("current_team_abbreviation"),
    )
    return players.join(current, "current_team_id", "left").select(
        "player_id", "full_name", "first_name", "last_name", "jersey_number", "birth_date",
        "birth_city", "birth_country", "height", "weight", "position_code", "position_name",
        "position_type", "bat_side", "pitch_hand", "current_team_id", "current_team_name",
        "current_team_abbreviation", "mlb_debut_date", "is_active",
    )


def dim_teams(teams: DataFrame) -> DataFrame:
    return teams.select(
        "team_id", "team_full_name", "team_code", "team_abbreviation", "team_name",
        "location_name", "league_id", "league_name", "division_id", "division_name", "venue_id",
        "venue_name", "sport_id", "is_active", "first_year_of_play",
    )


def fct_batting_performance(
    season_batting: DataFrame, contact: DataFrame, players: DataFrame
) -> DataFrame:
    """Season batting of known players with their batted-ball metrics.

    The metrics join first: both sides are already spread by (player, season).
    """
    metrics = contact.where(F.col("player_role") == BATTER).select(
        "player_id", "season", "barrel_pct", "hard_hit_pct", "avg_exit_velocity",
        "avg_launch_angle", "max_exit_velocity", F.col("avg_expected_batting_avg").alias("xba"),
        F.col("avg_expected_woba").alias("xwoba"),
    )
    people = players.select("player_id", "full_name", "position_name", "position_type", "bat_side")
    return (
        season_batting.join(metrics, ["player_id", "season"], "left")
        .join(people, "player_id", "inner")
        .select(
            "player_id", "season", "full_name", "position_name", "position_type", "bat_side",
            "games_played", "plate_appearances", "at_bats", "runs", "hits", "doubles", "triples",
            "home_runs", "singles", "rbi", "stolen_bases", "caught_stealing", "walks",
            "strikeouts", "hit_by_pitch", "sacrifice_flies", "total_bases",
            "ground_into_double_play", "batting_average", "on_base_percentage",
            "slugging_percentage", "on_base_plus_slugging", "woba", "barrel_pct", "hard_hit_pct",
            "avg_exit_velocity", "avg_launch_angle", "max_exit_velocity", "xba", "xwoba",
            batting.isolated_power().alias("iso"),
            batting.per_plate_appearance("walks").alias("walk_pct"),
            batting.per_plate_appearance("strikeouts").alias("strikeout_pct"),
            batting.babip().alias("babip"),
        )
    )


def fct_pitching_performance(
    season_pitching: DataFrame, contact: DataFrame, players: DataFrame
) -> DataFrame:
    metrics = contact.where(F.col("player_role") == PITCHER).select(
        "player_id", "season", F.col("barrel_pct").alias("barrel_pct_against"),
        F.col("hard_hit_pct").alias("hard_hit_pct_against"),
        F.col("avg_exit_velocity").alias("avg_exit_velocity_against"),
        F.col("avg_expected_woba").alias("xwoba_against"),
    )
    people = players.select("player_id", "full_name", "position_name", "pitch_hand")
    return (
        season_pitching.join(metrics, ["player_id", "season"], "left")
        .join(people, "player_id", "inner")
        .select(
            "player_id", "season", "full_name", "position_name", "pitch_hand", "wins", "losses",
            pitching.win_share().alias("win_pct"),
            "games", "games_started", "games_finished", "complete_games", "shutouts", "saves",
            "save_opportunities", "holds", "blown_saves", "innings_pitched", "hits_allowed",
            "runs_allowed", "earned_runs", "home_runs_allowed", "walks", "strikeouts",
            "hit_batsmen", "wild_pitches", "era", "whip", "fip", "strikeout_walk_ratio",
            "strikeouts_per_9", "walks_per_9", "hits_per_9", "batting_average_against",
            pitching.per_batter_faced("strikeouts").alias("strikeout_pct"),
            pitching.per_batter_faced("walks").alias("walk_pct"),
            "barrel_pct_against", "hard_hit_pct_against", "avg_exit_velocity_against",
            "xwoba_against",
        )
    )


def fct_game_summary(games: DataFrame, teams: DataFrame, players: DataFrame) -> DataFrame:
    """Final games with the names behind their ids; a tie or a missing score counts as away."""

    def team_names(side: str) -> DataFrame:
        return teams.select(
            F.col("team_id").alias(f"{side}_team_id"),
            F.col("team_full_name").alias(f"{side}_team_name"),
            F.col("team_abbreviation").alias(f"{side}_team_abbreviation"),
        )

    def pitcher_name(kind: str) -> DataFrame:
        return players.select(
            F.col("player_id").alias(f"{kind}_pitcher_id"),
            F.col("full_name").alias(f"{kind}_pitcher_name"),
        )

    named = games.where(F.col("game_status_code") == FINAL)
    for side in ("home", "away"):
        named = named.join(team_names(side), f"{side}_team_id", "left")
    for kind in ("winning", "losing", "save"):
        named = named.join(pitcher_name(kind), f"{kind}_pitcher_id", "left")

    home, away = F.col("home_score"), F.col("away_score")
    home_won = home > away
    return named.select(
        "game_pk", "game_type", "season", "game_date", "game_datetime", "home_team_id",
        "home_team_name", "home_team_abbreviation", "away_team_id", "away_team_name",
        "away_team_abbreviation", "home_score", "away_score",
        F.abs(home - away).alias("run_margin"),
        F.when(home_won, "home").otherwise("away").alias("winner"),
        F.when(home_won, F.col("home_team_id")).otherwise(F.col("away_team_id"))
        .alias("winning_team_id"),
        F.when(home_won, F.col("away_team_id")).otherwise(F.col("home_team_id"))
        .alias("losing_team_id"),
        "winning_pitcher_id", "winning_pitcher_name", "losing_pitcher_id", "losing_pitcher_name",
        "save_pitcher_id", "save_pitcher_name", "innings",
        F.coalesce(F.col("innings") > 9, F.lit(False)).alias("is_extra_innings"),
        "venue_id", "venue_name", "day_night", "series_description", "series_game_number",
        "double_header",
    )


def fct_statcast_leaders(
    contact: DataFrame, players: DataFrame, min_batted_balls: int = MIN_BATTED_BALLS
) -> DataFrame:
    """Qualified player-seasons with their rank in each metric; low values lead for pitchers."""
    people = players.select("player_id", "full_name", "position_name")
    qualified = (
        contact.where(F.col("total_batted_balls") >= min_batted_balls)
        .join(people, "player_id", "inner")
        .select(
            "player_id", "season", "player_role", "full_name", "position_name",
            "total_batted_balls", "barrels", "barrel_pct", "hard_hits", "hard_hit_pct",
            "avg_exit_velocity", "avg_launch_angle", "max_exit_velocity",
            F.col("avg_expected_batting_avg").alias("xba"),
            F.col("avg_expected_woba").alias("xwoba"),
        )
    )
    return competition_ranks(
        qualified,
        within=["season", "player_role"],
        metrics={
            "exit_velo_rank": "avg_exit_velocity",
            "barrel_pct_rank": "barrel_pct",
            "hard_hit_pct_rank": "hard_hit_pct",
            "xwoba_rank": "xwoba",
        },
        ascending=F.col("player_role") == PITCHER,
    )


def team_batting(stats: DataFrame) -> DataFrame:
    counts = [
        "games_played", "plate_appearances", "at_bats", "hits", "home_runs", "rbi",
        "stolen_bases", "walks", "strikeouts", "hit_by_pitch", "sacrifice_flies", "total_bases",
    ]
    summed = (
        stats.where(F.col("game_type") == REGULAR)
        .groupBy("team_id", "season")
        .agg(*[F.sum(c).alias(c) for c in counts])
    )
    return summed.select(
        "team_id",
        "season",
        F.col("games_played").alias("team_games_batted"),
        *[F.col(c).alias(f"team_{c}") for c in counts[1:9]],
        batting.batting_average().alias("team_batting_average"),
        batting.on_base_percentage().alias("team_obp"),
        batting.slugging_percentage().alias("team_slg"),
    )


def team_pitching(stats: DataFrame) -> DataFrame:
    counts = [
        "innings_pitched", "earned_runs", "strikeouts", "walks", "hits_allowed",
        "home_runs_allowed", "saves",
    ]
    summed = (
        stats.where(F.col("game_type") == REGULAR)
        .groupBy("team_id", "season")
        .agg(*[F.sum(c).alias(c) for c in counts])
    )
    return summed.select(
        "team_id",
        "season",
        F.col("innings_pitched").alias("team_innings_pitched"),
        F.col("earned_runs").alias("team_earned_runs"),
        F.col("strikeouts").alias("team_pitching_strikeouts"),
        F.col("walks").alias("team_pitching_walks"),
        F.col("hits_allowed").alias("team_hits_allowed"),
        F.col("home_runs_allowed").alias("team_home_runs_allowed"),
        F.col("saves").alias("team_saves"),
        pitching.era().alias("team_era"),
        pitching.whip().alias("team_whip"),
    )


def fct_team_season_summary(
    standings: DataFrame, batting_stats: DataFrame, pitching_stats: DataFrame
) -> DataFrame:
    """Standings with the team's summed batting and pitching and its expected wins."""
    key = ["team_id", "season"]
    return (
        standings.join(team_batting(batting_stats), key, "left")
        .join(team_pitching(pitching_stats), key, "left")
        .select(
            *key, "team_full_name", "team_abbreviation", "league_name", "division_name",
            "games_played", "wins", "losses", "win_pct", "games_behind", "run_differential",
            "home_wins", "home_losses", "away_wins", "away_losses", "runs_scored",
            "runs_allowed", "team_batting_average", "team_obp", "team_slg",
            team.team_ops().alias("team_ops"),
            "team_home_runs", "team_rbi", "team_stolen_bases",
            F.col("team_walks").alias("team_batting_walks"),
            F.col("team_strikeouts").alias("team_batting_strikeouts"),
            "team_era", "team_whip", "team_pitching_strikeouts", "team_pitching_walks",
            "team_saves", "team_home_runs_allowed",
            team.pythagorean_win_pct().alias("pythagorean_win_pct"),
            team.pythagorean_wins().alias("pythagorean_wins"),
        )
    )
