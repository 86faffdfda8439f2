"""Column layouts of the seven raw tables, as Spark DDL."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and types of the raw layer.
RAW = {
    "teams": """
        team_id INT NOT NULL, name STRING NOT NULL, team_code STRING, abbreviation STRING NOT NULL,
        team_name STRING, location_name STRING, league_id INT, league_name STRING,
        division_id INT, division_name STRING, venue_id INT, venue_name STRING, sport_id INT,
        active BOOLEAN, first_year_of_play STRING, loaded_at TIMESTAMP NOT NULL""",
    "players": """
        player_id INT NOT NULL, full_name STRING NOT NULL, first_name STRING, last_name STRING,
        primary_number STRING, birth_date DATE, birth_city STRING, birth_country STRING,
        height STRING, weight INT, primary_position_code STRING, primary_position_name STRING,
        primary_position_type STRING, bat_side STRING, pitch_hand STRING, current_team_id INT,
        mlb_debut_date DATE, active BOOLEAN, loaded_at TIMESTAMP NOT NULL""",
    "games": """
        game_pk INT NOT NULL, game_type STRING, season INT NOT NULL, game_date DATE NOT NULL,
        game_datetime TIMESTAMP, status_code STRING, status_detail STRING,
        home_team_id INT NOT NULL, away_team_id INT NOT NULL, home_score INT, away_score INT,
        home_wins INT, home_losses INT, away_wins INT, away_losses INT, venue_id INT,
        venue_name STRING, winning_pitcher_id INT, losing_pitcher_id INT, save_pitcher_id INT,
        innings INT, day_night STRING, series_description STRING, series_game_number INT,
        double_header STRING, loaded_at TIMESTAMP NOT NULL""",
    "batting_stats": """
        id BIGINT NOT NULL, player_id INT NOT NULL, season INT NOT NULL, team_id INT,
        league_id INT, game_type STRING, games_played INT, at_bats INT, runs INT, hits INT,
        doubles INT, triples INT, home_runs INT, rbi INT, stolen_bases INT, caught_stealing INT,
        walks INT, strikeouts INT, batting_average DECIMAL(5,3), obp DECIMAL(5,3),
        slg DECIMAL(5,3), ops DECIMAL(5,3), plate_appearances INT, total_bases INT,
        ground_into_dp INT, hit_by_pitch INT, sacrifice_bunts INT, sacrifice_flies INT,
        intentional_walks INT, loaded_at TIMESTAMP NOT NULL""",
    "pitching_stats": """
        id BIGINT NOT NULL, player_id INT NOT NULL, season INT NOT NULL, team_id INT,
        league_id INT, game_type STRING, wins INT, losses INT, era DECIMAL(6,2), games INT,
        games_started INT, games_finished INT, complete_games INT, shutouts INT, saves INT,
        save_opportunities INT, holds INT, blown_saves INT, innings_pitched DECIMAL(6,1),
        hits_allowed INT, runs_allowed INT, earned_runs INT, home_runs_allowed INT, walks INT,
        strikeouts INT, hit_batsmen INT, whip DECIMAL(5,2), batting_average_against DECIMAL(5,3),
        wild_pitches INT, balks INT, strikeout_walk_ratio DECIMAL(5,2),
        strikeouts_per_9 DECIMAL(5,2), walks_per_9 DECIMAL(5,2), hits_per_9 DECIMAL(5,2),
        loaded_at TIMESTAMP NOT NULL""",
    "statcast": """
        id BIGINT NOT NULL, game_pk INT, game_date DATE NOT NULL, game_year INT,
        batter INT NOT NULL, pitcher INT NOT NULL, batter_name STRING, pitcher_name STRING,
        events STRING, description STRING, zone INT, stand STRING, p_throws STRING,
        home_team STRING, away_team STRING, type STRING, pitch_type STRING, pitch_name STRING,
        release_speed DECIMAL(5,1), release_spin_rate INT, release_extension DECIMAL(4,1),
        release_pos_x DECIMAL(5,2), release_pos_z DECIMAL(5,2), pfx_x DECIMAL(6,2),
        pfx_z DECIMAL(6,2), plate_x DECIMAL(5,2), plate_z DECIMAL(5,2), vx0 DECIMAL(8,3),
        vy0 DECIMAL(8,3), vz0 DECIMAL(8,3), ax DECIMAL(8,3), ay DECIMAL(8,3), az DECIMAL(8,3),
        sz_top DECIMAL(5,2), sz_bot DECIMAL(5,2), effective_speed DECIMAL(5,1),
        launch_speed DECIMAL(5,1), launch_angle DECIMAL(5,1), hit_distance_sc DECIMAL(6,1),
        hc_x DECIMAL(6,1), hc_y DECIMAL(6,1), estimated_ba_using_speedangle DECIMAL(5,3),
        estimated_woba_using_speedangle DECIMAL(5,3), babip_value DECIMAL(5,3),
        iso_value DECIMAL(5,3), launch_speed_angle INT, at_bat_number INT, pitch_number INT,
        inning INT, inning_topbot STRING, outs_when_up INT, balls INT, strikes INT, on_1b INT,
        on_2b INT, on_3b INT, if_fielding_alignment STRING, of_fielding_alignment STRING,
        loaded_at TIMESTAMP NOT NULL""",
    "schedule": """
        id BIGINT NOT NULL, game_pk INT NOT NULL, game_date DATE NOT NULL, game_type STRING,
        season INT, status_code STRING, status_detail STRING, home_team_id INT,
        home_team_name STRING, away_team_id INT, away_team_name STRING, venue_id INT,
        venue_name STRING, game_datetime TIMESTAMP, day_night STRING, series_description STRING,
        series_game_number INT, games_in_series INT, double_header STRING, scheduled_innings INT,
        loaded_at TIMESTAMP NOT NULL""",
}

# The columns a keyed merge matches on, and what a new row gets for a column
# the batch does not carry.
KEYS = {
    "teams": ["team_id"],
    "players": ["player_id"],
    "games": ["game_pk"],
    "schedule": ["game_pk", "game_date"],
    "batting_stats": ["player_id", "season", "team_id", "game_type"],
    "pitching_stats": ["player_id", "season", "team_id", "game_type"],
}
DEFAULTS = {
    "teams": {"sport_id": 1, "active": True},
    "players": {"active": True},
    "batting_stats": {"game_type": "R"},
    "pitching_stats": {"game_type": "R"},
    "schedule": {"scheduled_innings": 9},
}
PITCH_KEY = ["game_pk", "at_bat_number", "pitch_number"]


def raw_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(RAW[table])
