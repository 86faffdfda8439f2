"""Dashboard queries as functions of the marts.

Parameters are typed arguments. Ordered results end in a unique key, so a board that cuts at n
rows is the same on every run; NULLs sort last in both directions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sabermill.functions import pitching, team
from sabermill.functions.rates import mean
from sabermill.plans.intermediate import REGULAR

# The six division slices in the long form the pages filter on.
DIVISION_PAGES = {
    "al_east": "American League East",
    "al_central": "American League Central",
    "al_west": "American League West",
    "nl_east": "National League East",
    "nl_central": "National League Central",
    "nl_west": "National League West",
}


def high(name: str) -> Column:
    return F.col(name).desc_nulls_last()


def low(name: str) -> Column:
    return F.col(name).asc_nulls_last()


def top(df: DataFrame, order: list[Column], n: int, columns: list) -> DataFrame:
    """The first ``n`` rows by ``order``; every task keeps its own ``n`` before they merge."""
    return df.orderBy(*order).limit(n).select(*columns)


def pick_list(df: DataFrame, column: str, newest_first: bool = False) -> DataFrame:
    values = df.select(column).distinct()
    if newest_first:
        return values.orderBy(high(column))
    return values.where(F.col(column).isNotNull()).orderBy(column)


def with_current_team(fact: DataFrame, players: DataFrame) -> DataFrame:
    return fact.join(players.select("player_id", "current_team_name"), "player_id", "left")


# Front page


def total_games(summary: DataFrame) -> DataFrame:
    runs = F.col("home_score") + F.col("away_score")
    totals = summary.where(F.col("game_type") == REGULAR).agg(
        F.count(F.lit(1)).alias("total_games"),
        F.countDistinct("season").alias("seasons"),
        F.sum(runs).alias("total_runs"),
        F.count(runs).alias("_scored"),
        F.count_if("is_extra_innings").alias("extra_inning_games"),
    )
    average = mean(F.col("total_runs"), F.col("_scored"), 1)
    return totals.select(
        "total_games", "seasons", "total_runs", average.alias("avg_runs_per_game"),
        F.when(F.col("total_games") > 0, F.col("extra_inning_games")).alias("extra_inning_games"),
    )


def total_home_runs(batting: DataFrame) -> DataFrame:
    return batting.agg(F.coalesce(F.sum("home_runs"), F.lit(0)).alias("total_home_runs"))


def top_teams(teams: DataFrame, n: int = 10) -> DataFrame:
    return top(
        teams,
        [high("win_pct"), low("team_id"), low("season")],
        n,
        ["team_abbreviation", "team_full_name", "wins", "losses", "win_pct", "run_differential",
         "season"],
    )


def recent_games(summary: DataFrame, n: int = 20) -> DataFrame:
    text = lambda name: F.col(name).cast("string")
    return top(
        summary.where(F.col("game_type") == REGULAR),
        [high("game_date"), low("game_pk")],
        n,
        [
            "game_date",
            F.concat("away_team_name", F.lit(" @ "), "home_team_name").alias("matchup"),
            F.concat(text("away_score"), F.lit(" - "), text("home_score")).alias("score"),
            F.when(F.col("winner") == "home", F.col("home_team_name"))
            .otherwise(F.col("away_team_name"))
            .alias("winning_team"),
            "winning_pitcher_name",
            "losing_pitcher_name",
            "save_pitcher_name",
            F.when(F.col("is_extra_innings"), "Yes").otherwise("No").alias("extras"),
        ],
    )


def team_scatter(teams: DataFrame) -> DataFrame:
    return teams.select(
        "team_abbreviation", "team_full_name", "win_pct", "run_differential", "division_name",
        "season",
    )


# Batting page


def batting_leaders(
    batting: DataFrame, players: DataFrame, season: int, min_pa: int = 0
) -> DataFrame:
    """The base of the batting boards: one season, enough plate appearances."""
    qualified = batting.where(
        (F.col("season") == season) & (F.col("plate_appearances") >= min_pa)
    )
    return (
        with_current_team(qualified, players)
        .select(
            "player_id", "full_name", "position_name", "season", "games_played",
            "plate_appearances", "batting_average", "on_base_percentage", "slugging_percentage",
            "on_base_plus_slugging", "woba", "iso", "babip", "walk_pct", "strikeout_pct",
            "home_runs", "rbi", "stolen_bases", "hits", "runs", "doubles", "triples", "xba",
            "xwoba", "barrel_pct", "hard_hit_pct", "avg_exit_velocity", "current_team_name",
        )
        .orderBy(high("on_base_plus_slugging"), low("player_id"))
    )


def hr_leaders(leaders: DataFrame, n: int = 20) -> DataFrame:
    return top(
        leaders.where(F.col("home_runs") > 0),
        [high("home_runs"), low("player_id")],
        n,
        ["full_name", "position_name", "home_runs", "rbi", "on_base_plus_slugging", "iso",
         "barrel_pct", "avg_exit_velocity"],
    )


def woba_leaders(leaders: DataFrame, n: int = 20) -> DataFrame:
    return top(
        leaders.where(F.col("woba").isNotNull()),
        [high("woba"), low("player_id")],
        n,
        ["full_name", "position_name", "current_team_name", "plate_appearances", "woba",
         "on_base_plus_slugging", "xwoba", "batting_average", "iso", "walk_pct",
         "strikeout_pct"],
    )


def sb_leaders(leaders: DataFrame, n: int = 15) -> DataFrame:
    return top(
        leaders.where(F.col("stolen_bases") > 0),
        [high("stolen_bases"), low("player_id")],
        n,
        ["full_name", "stolen_bases", "games_played", "batting_average", "on_base_percentage"],
    )


def avg_leaders(leaders: DataFrame, n: int = 20) -> DataFrame:
    return top(
        leaders.where(F.col("batting_average").isNotNull()),
        [high("batting_average"), low("player_id")],
        n,
        ["full_name", "position_name", "current_team_name", "plate_appearances",
         "batting_average", "on_base_percentage", "slugging_percentage", "babip", "hits",
         "doubles", "triples"],
    )


# Pitching page

ROLES = {"all": None, "starter": pitching.is_starter, "reliever": pitching.is_reliever}


def pitching_leaders(
    pitchers: DataFrame, players: DataFrame, season: int, min_ip: float = 0, role: str = "all"
) -> DataFrame:
    """The base of the pitching boards: one season, enough innings, one role or all."""
    qualified = pitchers.where(
        (F.col("season") == season) & (F.col("innings_pitched") >= F.lit(min_ip))
    )
    in_role = ROLES[role]
    if in_role is not None:
        qualified = qualified.where(in_role())
    return (
        with_current_team(qualified, players)
        .select(
            "player_id", "full_name", "position_name", "pitch_hand", "season", "wins", "losses",
            "win_pct", "era", "whip", "fip", "innings_pitched", "strikeouts", "walks",
            "strikeout_pct", "walk_pct", "strikeout_walk_ratio", "strikeouts_per_9",
            "walks_per_9", "hits_per_9", "batting_average_against", "games", "games_started",
            "saves", "holds", "barrel_pct_against", "hard_hit_pct_against",
            "avg_exit_velocity_against", "xwoba_against", "current_team_name",
            pitching.role().alias("role"),
        )
        .orderBy(low("era"), low("player_id"))
    )


def k_leaders(leaders: DataFrame, n: int = 20) -> DataFrame:
    return top(
        leaders,
        [high("strikeouts"), low("player_id")],
        n,
        ["full_name", "role", "strikeouts", "innings_pitched", "strikeouts_per_9",
         "strikeout_pct", "era"],
    )


def fip_leaders(leaders: DataFrame, n: int = 20) -> DataFrame:
    return top(
        leaders.where(F.col("fip").isNotNull()),
        [low("fip"), low("player_id")],
        n,
        ["full_name", "current_team_name", "role", "fip", "era", "whip", "innings_pitched",
         "strikeouts", "walks", "strikeout_walk_ratio"],
    )


def whip_leaders(leaders: DataFrame, n: int = 20) -> DataFrame:
    return top(
        leaders.where(F.col("whip").isNotNull()),
        [low("whip"), low("player_id")],
        n,
        ["full_name", "current_team_name", "role", "whip", "era", "fip", "innings_pitched",
         "hits_per_9", "walks_per_9"],
    )


def save_leaders(leaders: DataFrame, n: int = 15) -> DataFrame:
    return top(
        leaders.where(F.col("saves") > 0),
        [high("saves"), low("player_id")],
        n,
        ["full_name", "current_team_name", "saves", "holds", "era", "whip", "innings_pitched",
         "strikeouts"],
    )


# Standings page


def standings(teams: DataFrame, season: int) -> DataFrame:
    return (
        teams.where(F.col("season") == season)
        .select(
            "team_id", "team_full_name", "team_abbreviation", "league_name", "division_name",
            "wins", "losses", "win_pct", "games_behind", "run_differential", "runs_scored",
            "runs_allowed", "home_wins", "home_losses", "away_wins", "away_losses",
            "team_batting_average", "team_ops", "team_era", "team_whip", "team_home_runs",
            "team_stolen_bases", "team_pitching_strikeouts", "team_saves",
            "pythagorean_win_pct", "pythagorean_wins", "season",
        )
        .orderBy(low("division_name"), high("win_pct"), low("team_id"))
    )


def division_standings(season_standings: DataFrame, division: str) -> DataFrame:
    return season_standings.where(F.col("division_name") == division)


def team_comparison(season_standings: DataFrame) -> DataFrame:
    return season_standings.orderBy(high("win_pct"), low("team_id")).select(
        "team_abbreviation", "team_full_name", "team_ops", "team_era", "team_batting_average",
        "team_whip", "team_home_runs", "team_stolen_bases", "team_pitching_strikeouts",
        "win_pct", "division_name",
    )


def pythagorean_comparison(season_standings: DataFrame) -> DataFrame:
    return (
        season_standings.withColumn("luck_factor", team.luck())
        .orderBy(high("luck_factor"), low("team_id"))
        .select(
            "team_abbreviation",
            "team_full_name",
            F.col("wins").alias("actual_wins"),
            "pythagorean_wins",
            "luck_factor",
            "division_name",
        )
    )


# Batted-ball page


def statcast_data(leaders: DataFrame, players: DataFrame, season: int, role: str) -> DataFrame:
    """The base of the batted-ball boards: one season and role."""
    chosen = leaders.where((F.col("season") == season) & (F.col("player_role") == role))
    return (
        with_current_team(chosen, players)
        .select(
            "player_id", "full_name", "position_name", "player_role", "total_batted_balls",
            "barrel_pct", "hard_hit_pct", "avg_exit_velocity", "max_exit_velocity", "xba",
            "xwoba", "exit_velo_rank", "barrel_pct_rank", "hard_hit_pct_rank", "xwoba_rank",
            "current_team_name",
        )
        .orderBy(high("avg_exit_velocity"), low("player_id"))
    )


def ev_leaders(data: DataFrame, n: int = 20) -> DataFrame:
    return top(
        data,
        [high("avg_exit_velocity"), low("player_id")],
        n,
        ["full_name", "position_name", "current_team_name", "avg_exit_velocity",
         "max_exit_velocity", "barrel_pct", "hard_hit_pct", "total_batted_balls",
         "exit_velo_rank"],
    )


def barrel_leaders(data: DataFrame, n: int = 20) -> DataFrame:
    return top(
        data,
        [high("barrel_pct"), low("player_id")],
        n,
        ["full_name", "position_name", "current_team_name", "barrel_pct", "hard_hit_pct",
         "avg_exit_velocity", "xwoba", "total_batted_balls", "barrel_pct_rank"],
    )


def hard_hit_leaders(data: DataFrame, n: int = 20) -> DataFrame:
    return top(
        data,
        [high("hard_hit_pct"), low("player_id")],
        n,
        ["full_name", "position_name", "current_team_name", "hard_hit_pct", "barrel_pct",
         "avg_exit_velocity", "xwoba", "total_batted_balls", "hard_hit_pct_rank"],
    )


def xwoba_leaders(data: DataFrame, n: int = 20) -> DataFrame:
    return top(
        data.where(F.col("xwoba").isNotNull()),
        [high("xwoba"), low("player_id")],
        n,
        ["full_name", "position_name", "current_team_name", "xwoba", "xba", "barrel_pct",
         "hard_hit_pct", "avg_exit_velocity", "total_batted_balls", "xwoba_rank"],
    )


# Player page


def player_info(players: DataFrame, player_id: int) -> DataFrame:
    return players.where(F.col("player_id") == player_id).select(
        "player_id", "full_name", "first_name", "last_name", "jersey_number", "birth_date",
        "birth_city", "birth_country", "height", "weight", "position_code", "position_name",
        "position_type", "bat_side", "pitch_hand", "current_team_name",
        "current_team_abbreviation", "mlb_debut_date",
        F.when(F.col("is_active"), "Active").otherwise("Inactive").alias("status"),
    )


# Column headings of the player page.
BATTING_HEADINGS = {
    "season": "season", "games_played": "G", "plate_appearances": "PA", "at_bats": "AB",
    "hits": "H", "doubles": "2B", "triples": "3B", "home_runs": "HR", "rbi": "RBI",
    "runs": "R", "stolen_bases": "SB", "walks": "BB", "strikeouts": "K",
    "batting_average": "AVG", "on_base_percentage": "OBP", "slugging_percentage": "SLG",
    "on_base_plus_slugging": "OPS", "woba": "woba", "iso": "ISO", "babip": "BABIP",
    "walk_pct": "BB_pct", "strikeout_pct": "K_pct", "xba": "xba", "xwoba": "xwoba",
    "barrel_pct": "barrel_pct", "hard_hit_pct": "hard_hit_pct",
    "avg_exit_velocity": "avg_exit_velocity",
}
PITCHING_HEADINGS = {
    "season": "season", "wins": "W", "losses": "L", "era": "ERA", "games": "G",
    "games_started": "GS", "saves": "SV", "holds": "HLD", "innings_pitched": "IP",
    "strikeouts": "K", "walks": "BB", "whip": "WHIP", "fip": "FIP",
    "strikeouts_per_9": "K_per_9", "walks_per_9": "BB_per_9", "hits_per_9": "H_per_9",
    "strikeout_walk_ratio": "K_BB", "batting_average_against": "BAA", "strikeout_pct": "K_pct",
    "walk_pct": "BB_pct", "barrel_pct_against": "barrel_pct_against",
    "hard_hit_pct_against": "hard_hit_pct_against",
    "avg_exit_velocity_against": "avg_exit_velocity_against", "xwoba_against": "xwoba_against",
}
CONTACT_HEADINGS = {
    "season": "season", "player_role": "player_role", "total_batted_balls": "BBE",
    "barrel_pct": "barrel_pct", "hard_hit_pct": "hard_hit_pct",
    "avg_exit_velocity": "avg_exit_velocity", "max_exit_velocity": "max_exit_velocity",
    "xba": "xba", "xwoba": "xwoba", "exit_velo_rank": "exit_velo_rank",
    "barrel_pct_rank": "barrel_pct_rank", "hard_hit_pct_rank": "hard_hit_pct_rank",
    "xwoba_rank": "xwoba_rank",
}


def box_score(fact: DataFrame, headings: dict[str, str]) -> DataFrame:
    return fact.select(*[F.col(name).alias(short) for name, short in headings.items()])


def player_history(fact: DataFrame, headings: dict[str, str], player_id: int) -> DataFrame:
    mine = fact.where(F.col("player_id") == player_id)
    return box_score(mine, headings).orderBy(high("season"))
