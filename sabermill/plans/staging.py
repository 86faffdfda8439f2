"""Staging projections: rename, cast, keep. Lazy, so they fuse into whatever reads them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Raw name -> staged name.
TEAM_NAMES = {
    "name": "team_full_name",
    "abbreviation": "team_abbreviation",
    "active": "is_active",
}
PLAYER_NAMES = {
    "primary_number": "jersey_number",
    "primary_position_code": "position_code",
    "primary_position_name": "position_name",
    "primary_position_type": "position_type",
    "active": "is_active",
}
GAME_NAMES = {"status_code": "game_status_code", "status_detail": "game_status_detail"}
SCHEDULE_NAMES = {"id": "schedule_id", **GAME_NAMES}
BATTING_NAMES = {
    "id": "batting_stats_id",
    "obp": "on_base_percentage",
    "slg": "slugging_percentage",
    "ops": "on_base_plus_slugging",
    "ground_into_dp": "ground_into_double_play",
}
PITCHING_NAMES = {"id": "pitching_stats_id"}
PITCH_NAMES = {
    "id": "statcast_id",
    "game_year": "season",
    "batter": "batter_id",
    "pitcher": "pitcher_id",
    "events": "play_result",
    "description": "play_description",
    "zone": "pitch_zone",
    "stand": "batter_side",
    "p_throws": "pitcher_throws",
    "home_team": "home_team_abbreviation",
    "away_team": "away_team_abbreviation",
    "type": "pitch_result_type",
    "pitch_type": "pitch_type_code",
    "pfx_x": "horizontal_movement",
    "pfx_z": "vertical_movement",
    "sz_top": "strike_zone_top",
    "sz_bot": "strike_zone_bottom",
    "launch_speed": "exit_velocity",
    "hit_distance_sc": "hit_distance",
    "hc_x": "hit_coord_x",
    "hc_y": "hit_coord_y",
    "estimated_ba_using_speedangle": "expected_batting_avg",
    "estimated_woba_using_speedangle": "expected_woba",
    "launch_speed_angle": "launch_speed_angle_bucket",
    "inning_topbot": "inning_half",
    "outs_when_up": "outs",
    "balls": "ball_count",
    "strikes": "strike_count",
    "on_1b": "runner_on_1b_id",
    "on_2b": "runner_on_2b_id",
    "on_3b": "runner_on_3b_id",
    "if_fielding_alignment": "infield_alignment",
    "of_fielding_alignment": "outfield_alignment",
}


def stg_teams(raw: DataFrame) -> DataFrame:
    year = F.col("first_year_of_play").try_cast("int")
    return raw.withColumnsRenamed(TEAM_NAMES).withColumn("first_year_of_play", year)


def stg_players(raw: DataFrame) -> DataFrame:
    return raw.withColumnsRenamed(PLAYER_NAMES)


def stg_games(raw: DataFrame) -> DataFrame:
    return raw.withColumnsRenamed(GAME_NAMES)


def stg_schedule(raw: DataFrame) -> DataFrame:
    return raw.withColumnsRenamed(SCHEDULE_NAMES)


def stg_batting_stats(raw: DataFrame) -> DataFrame:
    return raw.withColumnsRenamed(BATTING_NAMES)


def stg_pitching_stats(raw: DataFrame) -> DataFrame:
    return raw.withColumnsRenamed(PITCHING_NAMES)


def stg_statcast(raw: DataFrame) -> DataFrame:
    return raw.withColumnsRenamed(PITCH_NAMES)
