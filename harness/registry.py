"""Every registered query: what Spark runs, the columns it shows and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from harness import adapter, fillers, oracle, payloads
from sabermill.functions import coerce
from sabermill.operators import merge, quality, sinks
from sabermill.plans import boards, intermediate, loads, suite
from sabermill.plans.warehouse import MARTS, Warehouse
from sabermill.schemas import DEFAULTS, KEYS, PITCH_KEY
from sabermill.sources.versions import VersionedTable, export_version, load_chunks, read_export
from sabermill.session import fresh_path, tune
from sabermill.sources import chunks, landing, pitches, tables
from sabermill.streaming import documents, ingest

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    build: Build
    spec: str
    sql: str | None


ENTRIES: dict[str, Entry] = {}

_SPARK_TYPES = {"i": "bigint", "s": "string", "b": "boolean", "t": "date"}

# Parameters of the dashboard inputs used throughout.
SEASON, MIN_PA, MIN_IP, PLAYER = 1998, 100, 30, 48


def shown(df: DataFrame, spec: str) -> DataFrame:
    return df.select(
        *[
            F.col(f"`{name}`").cast(_SPARK_TYPES.get(kind, "double")).alias(name)
            for name, kind in oracle.columns(spec)
        ]
    )


def add(name: str, build: Build, spec: str, sql: str | None) -> None:
    assert name not in ENTRIES, name
    ENTRIES[name] = Entry(lambda spark, sf: shown(build(tune(spark), sf), spec), spec, sql)


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse(adapter.raw_tables(spark, sf_dir))


def on(step: Callable[[Warehouse], DataFrame]) -> Build:
    return lambda spark, sf: step(warehouse(spark, sf))


def from_model(name: str, model: str, spec: str, part: str) -> None:
    add(name, on(lambda w: w.model(model)), spec, f"SELECT * FROM {part}")


# ---------------------------------------------------------------- staging and models

TEAM_SPEC = """team_id:i team_full_name:s team_code:s team_abbreviation:s team_name:s
    location_name:s league_id:i league_name:s division_id:i division_name:s venue_id:i
    venue_name:s sport_id:i is_active:b first_year_of_play:i"""
TEAM_SQL = """SELECT * REPLACE (TRY_CAST(first_year_of_play AS INTEGER) AS first_year_of_play),
    name AS team_full_name, abbreviation AS team_abbreviation, active AS is_active
    FROM raw_teams"""
PLAYER_SPEC = """player_id:i full_name:s first_name:s last_name:s jersey_number:s birth_date:t
    birth_city:s birth_country:s height:s weight:i position_code:s position_name:s
    position_type:s bat_side:s pitch_hand:s current_team_id:i mlb_debut_date:t is_active:b"""
PLAYER_NAMES = """primary_number AS jersey_number, primary_position_code AS position_code,
    primary_position_name AS position_name, primary_position_type AS position_type,
    active AS is_active"""
GAME_SPEC = """game_pk:i game_type:s season:i game_date:t game_status_code:s
    game_status_detail:s home_team_id:i away_team_id:i home_score:i away_score:i home_wins:i
    home_losses:i away_wins:i away_losses:i venue_id:i venue_name:s winning_pitcher_id:i
    losing_pitcher_id:i save_pitcher_id:i innings:i day_night:s series_description:s
    series_game_number:i double_header:s"""
STATUS = "status_code AS game_status_code, status_detail AS game_status_detail"
SCHEDULE_SPEC = """schedule_id:i game_pk:i game_date:t game_type:s season:i game_status_code:s
    game_status_detail:s home_team_id:i home_team_name:s away_team_id:i away_team_name:s
    venue_id:i venue_name:s day_night:s series_description:s series_game_number:i
    games_in_series:i double_header:s scheduled_innings:i"""
BATTING_COUNTS = """games_played:i plate_appearances:i at_bats:i runs:i hits:i doubles:i
    triples:i home_runs:i rbi:i stolen_bases:i caught_stealing:i walks:i strikeouts:i
    hit_by_pitch:i sacrifice_bunts:i sacrifice_flies:i intentional_walks:i total_bases:i
    ground_into_double_play:i"""
STG_BATTING_SPEC = f"""player_id:i season:i team_id:i league_id:i game_type:s {BATTING_COUNTS}
    batting_average:d3 on_base_percentage:d3 slugging_percentage:d3 on_base_plus_slugging:d3"""
PITCHING_COUNTS = """wins:i losses:i games:i games_started:i games_finished:i complete_games:i
    shutouts:i saves:i save_opportunities:i holds:i blown_saves:i innings_pitched:d1
    hits_allowed:i runs_allowed:i earned_runs:i home_runs_allowed:i walks:i strikeouts:i
    hit_batsmen:i wild_pitches:i balks:i"""
PITCHING_RATES = """era:d2 whip:d2 strikeout_walk_ratio:d2 strikeouts_per_9:d2 walks_per_9:d2
    hits_per_9:d2 batting_average_against:d3"""
STG_PITCHING_SPEC = f"""player_id:i season:i team_id:i league_id:i game_type:s
    {PITCHING_COUNTS} {PITCHING_RATES}"""
PITCH_SPEC = """game_pk:i game_date:t season:i batter_id:i pitcher_id:i batter_name:s
    play_result:s play_description:s pitch_zone:i batter_side:s pitcher_throws:s
    home_team_abbreviation:s away_team_abbreviation:s pitch_result_type:s pitch_type_code:s
    release_speed:d1 release_spin_rate:i horizontal_movement:d1 exit_velocity:d1
    launch_angle:d1 hit_distance:i expected_batting_avg:d3 expected_woba:d3 at_bat_number:i
    pitch_number:i inning:i ball_count:i strike_count:i"""
PITCH_SQL = """SELECT *, game_year AS season, batter AS batter_id, pitcher AS pitcher_id,
    events AS play_result, description AS play_description, zone AS pitch_zone,
    stand AS batter_side, p_throws AS pitcher_throws, home_team AS home_team_abbreviation,
    away_team AS away_team_abbreviation, type AS pitch_result_type,
    pitch_type AS pitch_type_code, pfx_x AS horizontal_movement, launch_speed AS exit_velocity,
    hit_distance_sc AS hit_distance, xba AS expected_batting_avg, xwoba AS expected_woba,
    balls AS ball_count, strikes AS strike_count FROM raw_statcast"""

add("P1_stg_teams", on(lambda w: w.stg_teams), TEAM_SPEC, TEAM_SQL)
add("P2_stg_players", on(lambda w: w.stg_players), PLAYER_SPEC,
    f"SELECT *, {PLAYER_NAMES} FROM raw_players")
add("P3_stg_games", on(lambda w: w.stg_games), GAME_SPEC, f"SELECT *, {STATUS} FROM raw_games")
add("P4_stg_schedule", on(lambda w: w.stg_schedule), SCHEDULE_SPEC,
    f"SELECT *, id AS schedule_id, {STATUS} FROM raw_schedule")
for _name, _model, _table in (("P3", "stg_games", "games"), ("P4", "stg_schedule", "schedule")):
    add(f"{_name}_{_model}_time", on(lambda w, m=_model: w.model(m).withColumn(
        "game_datetime", F.date_format("game_datetime", "yyyy-MM-dd HH:mm:ss"))),
        "game_pk:i game_datetime:s",
        f"""SELECT game_pk, strftime(CAST(game_datetime AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS game_datetime
        FROM raw_{_table}""")  # fmt: skip
add("P5_stg_batting_stats", on(lambda w: w.stg_batting_stats), STG_BATTING_SPEC,
    """SELECT *, ground_into_dp AS ground_into_double_play, obp AS on_base_percentage,
    slg AS slugging_percentage, obp + slg AS on_base_plus_slugging
    FROM raw_batting_stats""")  # fmt: skip
add("P6_stg_pitching_stats", on(lambda w: w.stg_pitching_stats), STG_PITCHING_SPEC,
    "SELECT * FROM raw_pitching_stats")
add("P7_stg_statcast", on(lambda w: w.stg_statcast), PITCH_SPEC, PITCH_SQL)
# Pitch columns that no given table has, as they are called in the staged view.
_STAGED_REST = {
    "pitcher_name": "pitcher_name", "pitch_name": "pitch_name",
    "release_extension": "release_extension", "release_pos_x": "release_pos_x",
    "release_pos_z": "release_pos_z", "pfx_z": "vertical_movement", "plate_x": "plate_x",
    "plate_z": "plate_z", "vx0": "vx0", "vy0": "vy0", "vz0": "vz0", "ax": "ax", "ay": "ay",
    "az": "az", "sz_top": "strike_zone_top", "sz_bot": "strike_zone_bottom",
    "effective_speed": "effective_speed", "hc_x": "hit_coord_x", "hc_y": "hit_coord_y",
    "launch_speed_angle": "launch_speed_angle_bucket", "inning_topbot": "inning_half",
    "outs_when_up": "outs", "on_1b": "runner_on_1b_id", "on_2b": "runner_on_2b_id",
    "on_3b": "runner_on_3b_id", "if_fielding_alignment": "infield_alignment",
    "of_fielding_alignment": "outfield_alignment",
}
add("P7_stg_statcast_rest", on(lambda w: w.stg_statcast),
    " ".join(f"{shown}:{fillers.KINDS[raw]}" for raw, shown in _STAGED_REST.items()),
    "SELECT " + ", ".join(f"{fillers.sql(raw)} AS {shown}" for raw, shown in _STAGED_REST.items())
    + " FROM lineitem")
add("P8_dim_teams", on(lambda w: w.dim_teams), TEAM_SPEC, TEAM_SQL)

RESULT_SPEC = """game_pk:i game_type:s season:i game_date:t is_home:b team_id:i opponent_id:i
    runs_scored:i runs_allowed:i is_win:b is_loss:b venue_id:i venue_name:s
    winning_pitcher_id:i losing_pitcher_id:i save_pitcher_id:i innings:i day_night:s
    series_description:s series_game_number:i double_header:s"""
SEASON_BATTING_SPEC = f"""player_id:i season:i {BATTING_COUNTS} singles:i batting_average:d3
    on_base_percentage:d3 slugging_percentage:d3 on_base_plus_slugging:d3 woba:d3"""
SEASON_PITCHING_SPEC = f"player_id:i season:i {PITCHING_COUNTS} {PITCHING_RATES} fip:d2"
CONTACT_SPEC = """player_id:i season:i player_role:s total_batted_balls:i barrels:i
    barrel_pct:d3 hard_hits:i hard_hit_pct:d3 avg_exit_velocity:d1 avg_launch_angle:d1
    max_exit_velocity:d1 avg_expected_batting_avg:d3 avg_expected_woba:d3"""
RECORD_SPEC = """team_id:i season:i team_full_name:s team_abbreviation:s league_name:s
    division_name:s games_played:i wins:i losses:i win_pct:d3 runs_scored:i runs_allowed:i
    run_differential:i home_wins:i home_losses:i away_wins:i away_losses:i"""
DIM_PLAYER_SPEC = f"{PLAYER_SPEC} current_team_name:s current_team_abbreviation:s"
BATTING_SPEC = """player_id:i season:i full_name:s position_name:s position_type:s bat_side:s
    games_played:i plate_appearances:i at_bats:i runs:i hits:i doubles:i triples:i home_runs:i
    singles:i rbi:i stolen_bases:i caught_stealing:i walks:i strikeouts:i hit_by_pitch:i
    sacrifice_flies:i total_bases:i ground_into_double_play:i batting_average:d3
    on_base_percentage:d3 slugging_percentage:d3 on_base_plus_slugging:d3 woba:d3 barrel_pct:d3
    hard_hit_pct:d3 avg_exit_velocity:d1 avg_launch_angle:d1 max_exit_velocity:d1 xba:d3
    xwoba:d3 iso:d3 walk_pct:d3 strikeout_pct:d3 babip:d3"""
PITCHING_SPEC = """player_id:i season:i full_name:s position_name:s pitch_hand:s wins:i losses:i
    win_pct:d3 games:i games_started:i games_finished:i complete_games:i shutouts:i saves:i
    save_opportunities:i holds:i blown_saves:i innings_pitched:d1 hits_allowed:i runs_allowed:i
    earned_runs:i home_runs_allowed:i walks:i strikeouts:i hit_batsmen:i wild_pitches:i era:d2
    whip:d2 fip:d2 strikeout_walk_ratio:d2 strikeouts_per_9:d2 walks_per_9:d2 hits_per_9:d2
    batting_average_against:d3 strikeout_pct:d3 walk_pct:d3 barrel_pct_against:d3
    hard_hit_pct_against:d3 avg_exit_velocity_against:d1 xwoba_against:d3"""
SUMMARY_SPEC = """game_pk:i game_type:s season:i game_date:t home_team_id:i home_team_name:s
    home_team_abbreviation:s away_team_id:i away_team_name:s away_team_abbreviation:s
    home_score:i away_score:i run_margin:i winner:s winning_team_id:i losing_team_id:i
    winning_pitcher_id:i winning_pitcher_name:s losing_pitcher_id:i losing_pitcher_name:s
    save_pitcher_id:i save_pitcher_name:s innings:i is_extra_innings:b venue_id:i venue_name:s
    day_night:s series_description:s series_game_number:i double_header:s"""
LEADERS_SPEC = """player_id:i season:i player_role:s full_name:s position_name:s
    total_batted_balls:i barrels:i barrel_pct:d3 hard_hits:i hard_hit_pct:d3
    avg_exit_velocity:d1 avg_launch_angle:d1 max_exit_velocity:d1 xba:d3 xwoba:d3
    exit_velo_rank:i barrel_pct_rank:i hard_hit_pct_rank:i xwoba_rank:i"""
TEAM_SEASON_SPEC = """team_id:i season:i team_full_name:s team_abbreviation:s league_name:s
    division_name:s games_played:i wins:i losses:i win_pct:d3 games_behind:d1
    run_differential:i home_wins:i home_losses:i away_wins:i away_losses:i runs_scored:i
    runs_allowed:i team_batting_average:d3 team_obp:d3 team_slg:d3 team_ops:d3 team_home_runs:i
    team_rbi:i team_stolen_bases:i team_batting_walks:i team_batting_strikeouts:i team_era:d2
    team_whip:d2 team_pitching_strikeouts:i team_pitching_walks:i team_saves:i
    team_home_runs_allowed:i pythagorean_win_pct:d3 pythagorean_wins:d0"""

# Model -> its SQL part and the columns compared.
MODELS = {
    "int_game_results": ("game_results", RESULT_SPEC),
    "int_player_season_batting": ("season_batting", SEASON_BATTING_SPEC),
    "int_player_season_pitching": ("season_pitching", SEASON_PITCHING_SPEC),
    "int_statcast_metrics": ("contact", CONTACT_SPEC),
    "int_team_standings": ("standings", f"{RECORD_SPEC} games_behind:d1"),
    "fct_batting_performance": ("batting", BATTING_SPEC),
    "fct_pitching_performance": ("pitching", PITCHING_SPEC),
    "fct_game_summary": ("summary", SUMMARY_SPEC),
    "fct_statcast_leaders": ("leaders", LEADERS_SPEC),
    "fct_team_season_summary": ("team_summary", TEAM_SEASON_SPEC),
}
for _model, (_part, _spec) in MODELS.items():
    from_model(_model, _model, _spec, _part)
add("dim_players", on(lambda w: w.dim_players), DIM_PLAYER_SPEC,
    f"SELECT *, {PLAYER_NAMES} FROM players")
add("dim_teams", on(lambda w: w.dim_teams), TEAM_SPEC, TEAM_SQL)

add("P9_role_tag", on(lambda w: w.int_statcast_metrics), "player_id:i season:i player_role:s",
    "SELECT * FROM contact")
add("P10_mart_aliases", on(lambda w: w.fct_pitching_performance),
    "player_id:i season:i barrel_pct_against:d3 hard_hit_pct_against:d3 xwoba_against:d3",
    "SELECT * FROM pitching")


def _headings(headings: dict[str, str], source_spec: str) -> tuple[str, str]:
    """The spec and the SELECT list of a box score."""
    kinds = dict(oracle.columns(source_spec))
    spec = " ".join(f"{short}:{kinds[name]}" for name, short in headings.items())
    return spec, ", ".join(f'{name} AS "{short}"' for name, short in headings.items())


BOX_SPEC, BOX_SELECT = _headings(boards.BATTING_HEADINGS, BATTING_SPEC)
add("P11_box_score_aliases",
    on(lambda w: boards.box_score(w.fct_batting_performance, boards.BATTING_HEADINGS)),
    BOX_SPEC, f"SELECT {BOX_SELECT} FROM batting")

# ---------------------------------------------------------------- filters


def _counted(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


add("F1_equals", on(lambda w: _counted(w.stg_games.where(
        (F.col("game_status_code") == "F") & (F.col("game_type") == "R")), "season")),
    "season:i n:i",
    """SELECT season, count(*) AS n FROM raw_games
    WHERE status_code = 'F' AND game_type = 'R' GROUP BY season""")  # fmt: skip
add("F2_not_null", on(lambda w: _counted(w.stg_statcast.where(
        F.col("play_result").isNotNull() & F.col("exit_velocity").isNotNull()), "season")),
    "season:i n:i",
    """SELECT game_year AS season, count(*) AS n FROM raw_statcast
    WHERE events IS NOT NULL AND launch_speed IS NOT NULL GROUP BY ALL""")  # fmt: skip
add("F3_minimum_sample",
    on(lambda w: w.int_statcast_metrics.where(F.col("total_batted_balls") >= 50)),
    "player_id:i season:i player_role:s total_batted_balls:i",
    "SELECT * FROM contact WHERE total_batted_balls >= 50")
add("F4_between", on(lambda w: _counted(
        w.stg_statcast.where(F.col("launch_angle").between(26, 30)), "season")),
    "season:i n:i",
    """SELECT game_year AS season, count(*) AS n FROM raw_statcast
    WHERE launch_angle BETWEEN 260 AND 300 GROUP BY ALL""")  # fmt: skip
add("F5_parameters", on(lambda w: boards.pitching_leaders(
        w.fct_pitching_performance, w.dim_players, SEASON, MIN_IP)),
    "player_id:i season:i innings_pitched:d1",
    f"SELECT * FROM pitching WHERE season = {SEASON} AND innings_pitched >= {MIN_IP * 10}",
)
for _role, _test in {"starter": ">", "reliever": "<="}.items():
    add(f"F6_role_{_role}", on(lambda w, role=_role: boards.pitching_leaders(
            w.fct_pitching_performance, w.dim_players, SEASON, 0, role)),
        "player_id:i games:i games_started:i role:s",
        f"SELECT * FROM pitching WHERE season = {SEASON} AND 2 * games_started {_test} games",
    )
add("F7_positive_values", on(lambda w: w.fct_batting_performance.where(
        (F.col("home_runs") > 0) & (F.col("stolen_bases") > 0) & F.col("woba").isNotNull())),
    "player_id:i season:i home_runs:i stolen_bases:i woba:d3",
    """SELECT * FROM batting WHERE home_runs > 0 AND stolen_bases > 0
    AND woba IS NOT NULL""")  # fmt: skip
add("F8_division_slice", on(lambda w: w.fct_team_season_summary.where(
        F.col("division_name") == "American League West")),
    "team_id:i season:i division_name:s wins:i",
    "SELECT * FROM team_summary WHERE division_name = 'American League West'")
add("F9_not_in_and_out_of_range", on(lambda w: _counted(w.stg_statcast.where(
        ~F.col("pitch_result_type").isin("B", "S")
        | quality.outside("release_speed", 40, 110)), "season", "pitch_result_type")),
    "season:i pitch_result_type:s n:i",
    """SELECT game_year AS season, type AS pitch_result_type, count(*) AS n FROM raw_statcast
    WHERE type NOT IN ('B', 'S') OR release_speed < 400 OR release_speed > 1100
    GROUP BY ALL""")  # fmt: skip
add("F10_having", on(lambda w: w.int_game_results.groupBy("game_pk").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if("is_win").alias("win_count"))
        .where((F.col("row_count") != 2) | (F.col("win_count") != 1))),
    "game_pk:i row_count:i win_count:i",
    """SELECT game_pk, count(*) AS row_count, count(*) FILTER (is_win) AS win_count
    FROM game_results GROUP BY game_pk HAVING row_count <> 2 OR win_count <> 1""")  # fmt: skip

# ---------------------------------------------------------------- joins

from_model("J2_batting_players", "fct_batting_performance",
           "player_id:i season:i full_name:s position_name:s", "batting")
from_model("J3_batting_contact", "fct_batting_performance",
           "player_id:i season:i barrel_pct:d3 xwoba:d3", "batting")
from_model("J4_pitching_players", "fct_pitching_performance",
           "player_id:i season:i full_name:s pitch_hand:s", "pitching")
from_model("J5_pitching_contact", "fct_pitching_performance",
           "player_id:i season:i hard_hit_pct_against:d3", "pitching")
from_model("J6_game_teams", "fct_game_summary",
           "game_pk:i home_team_name:s away_team_name:s", "summary")
from_model("J7_game_pitchers", "fct_game_summary",
           "game_pk:i winning_pitcher_name:s losing_pitcher_name:s save_pitcher_name:s",
           "summary")
from_model("J8_records_teams", "int_team_standings",
           "team_id:i season:i team_full_name:s league_name:s", "standings")
from_model("J9_division_best", "int_team_standings",
           "team_id:i season:i division_name:s games_behind:d1", "standings")
from_model("J10_standings_batting_pitching", "fct_team_season_summary",
           "team_id:i season:i team_obp:d3 team_era:d2", "team_summary")
from_model("J11_contact_players", "fct_statcast_leaders",
           "player_id:i season:i player_role:s full_name:s", "leaders")
add("J1_players_teams", on(lambda w: w.dim_players),
    "player_id:i current_team_id:i current_team_name:s current_team_abbreviation:s",
    "SELECT * FROM players")
add("J12_fact_current_team", on(lambda w: boards.with_current_team(
        w.int_player_season_batting, w.dim_players)),
    "player_id:i season:i current_team_name:s",
    """SELECT player_id, season, current_team_name FROM season_batting
    LEFT JOIN players USING (player_id)""")  # fmt: skip
CHECK_SPEC = "check:s table_name:s column_name:s violations:i"
add("J13_orphans", on(suite.either_team_missing), CHECK_SPEC,
    """SELECT 'relationships' AS "check", 'raw_games' AS table_name,
    'home_team_id, away_team_id' AS column_name, count(*) AS violations FROM raw_games
    WHERE home_team_id NOT IN (SELECT team_id FROM raw_teams)
    OR away_team_id NOT IN (SELECT team_id FROM raw_teams)""")  # fmt: skip

# ---------------------------------------------------------------- aggregates, ranks, unions

from_model("A1_player_season_batting", "int_player_season_batting", SEASON_BATTING_SPEC,
           "season_batting")
from_model("A2_player_season_pitching", "int_player_season_pitching", SEASON_PITCHING_SPEC,
           "season_pitching")
for _key, _role in {"A3": "batter", "A4": "pitcher"}.items():
    add(f"{_key}_contact_by_{_role}",
        on(lambda w, role=_role: intermediate.contact_metrics(w.stg_statcast, role)),
        CONTACT_SPEC, f"SELECT * FROM contact WHERE player_role = '{_role}'")
from_model("A5_contact_both_roles", "int_statcast_metrics", CONTACT_SPEC, "contact")
from_model("A6_conditional_counts", "int_statcast_metrics",
           "player_id:i season:i player_role:s barrels:i hard_hits:i", "contact")
add("A7_team_records", on(lambda w: intermediate.team_records(w.int_game_results)),
    """team_id:i season:i games_played:i wins:i losses:i runs_scored:i runs_allowed:i
    win_pct:d3 home_wins:i home_losses:i away_wins:i away_losses:i""",
    f"""SELECT *, {oracle.rounded("wins", "games_played", 3)} AS win_pct FROM (
    SELECT team_id, season, count(*) AS games_played, count(*) FILTER (is_win) AS wins,
      count(*) FILTER (is_loss) AS losses, sum(runs_scored) AS runs_scored,
      sum(runs_allowed) AS runs_allowed, count(*) FILTER (is_win AND is_home) AS home_wins,
      count(*) FILTER (is_loss AND is_home) AS home_losses,
      count(*) FILTER (is_win AND NOT is_home) AS away_wins,
      count(*) FILTER (is_loss AND NOT is_home) AS away_losses
    FROM game_results WHERE game_type = 'R' GROUP BY team_id, season)""")  # fmt: skip
add("A8_division_best", on(lambda w: w.int_team_standings
        .where(F.col("division_name").isNotNull()).groupBy("season", "division_name")
        .agg(F.max("win_pct").alias("best_win_pct"))),
    "season:i division_name:s best_win_pct:d3",
    """SELECT season, division_name, max(win_pct) AS best_win_pct FROM records
    WHERE division_name IS NOT NULL GROUP BY season, division_name""")  # fmt: skip
from_model("A9_team_batting", "fct_team_season_summary",
           """team_id:i season:i team_batting_average:d3 team_obp:d3 team_slg:d3
           team_home_runs:i team_rbi:i team_stolen_bases:i team_batting_walks:i
           team_batting_strikeouts:i""", "team_summary")  # fmt: skip
from_model("A10_team_pitching", "fct_team_season_summary",
           """team_id:i season:i team_era:d2 team_whip:d2 team_pitching_strikeouts:i
           team_pitching_walks:i team_saves:i team_home_runs_allowed:i""",
           "team_summary")
KPI_SPEC = "total_games:i seasons:i total_runs:i avg_runs_per_game:d1 extra_inning_games:i"
KPI_SQL = f"""SELECT count(*) AS total_games, count(DISTINCT season) AS seasons,
    sum(home_score + away_score) AS total_runs,
    {oracle.rounded("sum(home_score + away_score)", "count(home_score + away_score)", 1)}
      AS avg_runs_per_game,
    sum(CASE WHEN is_extra_innings THEN 1 ELSE 0 END) AS extra_inning_games
    FROM summary WHERE game_type = 'R'"""
HR_SQL = "SELECT coalesce(sum(home_runs), 0) AS total_home_runs FROM batting"
add("A11_global_kpis", on(lambda w: boards.total_games(w.fct_game_summary)), KPI_SPEC, KPI_SQL)
add("A12_global_sum", on(lambda w: boards.total_home_runs(w.fct_batting_performance)),
    "total_home_runs:i", HR_SQL)
add("A13_average_max_counts", on(lambda w: w.stg_statcast.groupBy("season").agg(
        F.count(F.lit(1)).alias("pitches"), F.count("exit_velocity").alias("measured"),
        F.countDistinct("batter_id").alias("batters"),
        F.max("exit_velocity").alias("fastest"), F.sum("exit_velocity").alias("total"))
        .withColumn("average", boards.mean(F.col("total"), F.col("measured"), 1))),
    "season:i pitches:i measured:i batters:i fastest:d1 average:d1",
    f"""SELECT game_year AS season, count(*) AS pitches, count(launch_speed) AS measured,
    count(DISTINCT batter) AS batters, max(launch_speed) AS fastest,
    {oracle.rounded("sum(launch_speed)", "count(launch_speed)", 0)} AS average
    FROM raw_statcast GROUP BY ALL""")  # fmt: skip
add("A14_distinct_values", on(lambda w: boards.pick_list(w.stg_teams, "division_name")),
    "division_name:s",
    "SELECT DISTINCT division_name FROM raw_teams WHERE division_name IS NOT NULL")

for _i, (_metric, _rank, _kind) in enumerate([
    ("avg_exit_velocity", "exit_velo_rank", "d1"), ("barrel_pct", "barrel_pct_rank", "d3"),
    ("hard_hit_pct", "hard_hit_pct_rank", "d3"), ("xwoba", "xwoba_rank", "d3"),
]):
    for _first, _role in ((1, "batter"), (5, "pitcher")):
        add(f"W{_first + _i}_{_role}_{_rank}",
            on(lambda w, role=_role: w.fct_statcast_leaders
               .where(F.col("player_role") == role)),
            f"player_id:i season:i {_metric}:{_kind} {_rank}:i",
            f"SELECT * FROM leaders WHERE player_role = '{_role}'")

from_model("U1_home_and_away", "int_game_results", RESULT_SPEC, "game_results")
from_model("U2_both_roles", "int_statcast_metrics",
           "player_id:i season:i player_role:s total_batted_balls:i", "contact")
from_model("U3_both_leaderboards", "fct_statcast_leaders",
           "player_id:i season:i player_role:s exit_velo_rank:i xwoba_rank:i",
           "leaders")
add("U4_distinct", on(lambda w: w.stg_statcast.select("batter_id", "season").distinct()),
    "batter_id:i season:i",
    "SELECT DISTINCT batter AS batter_id, game_year AS season FROM raw_statcast")

# ---------------------------------------------------------------- metrics

METRICS = {
    "M1_singles": ("int_player_season_batting", "singles:i"),
    "M2_batting_average": ("int_player_season_batting", "batting_average:d3"),
    "M3_on_base_percentage": ("int_player_season_batting", "on_base_percentage:d3"),
    "M4_slugging_percentage": ("int_player_season_batting", "slugging_percentage:d3"),
    "M5_on_base_plus_slugging": ("int_player_season_batting", "on_base_plus_slugging:d3"),
    "M6_woba": ("int_player_season_batting", "woba:d3"),
    "M7_era": ("int_player_season_pitching", "era:d2"),
    "M8_whip": ("int_player_season_pitching", "whip:d2"),
    "M9_strikeout_walk_ratio": ("int_player_season_pitching", "strikeout_walk_ratio:d2"),
    "M10_strikeouts_per_9": ("int_player_season_pitching", "strikeouts_per_9:d2"),
    "M11_walks_per_9": ("int_player_season_pitching", "walks_per_9:d2"),
    "M12_hits_per_9": ("int_player_season_pitching", "hits_per_9:d2"),
    "M13_average_against": ("int_player_season_pitching", "batting_average_against:d3"),
    "M14_fip": ("int_player_season_pitching", "fip:d2"),
    "M15_barrels": ("int_statcast_metrics", "player_role:s barrels:i barrel_pct:d3"),
    "M16_hard_hits": ("int_statcast_metrics", "player_role:s hard_hits:i hard_hit_pct:d3"),
    "M17_contact_averages": (
        "int_statcast_metrics",
        """player_role:s avg_exit_velocity:d1 avg_launch_angle:d1 max_exit_velocity:d1
        avg_expected_batting_avg:d3 avg_expected_woba:d3""",
    ),
    "M21_iso": ("fct_batting_performance", "iso:d3"),
    "M22_batting_shares": ("fct_batting_performance", "walk_pct:d3 strikeout_pct:d3"),
    "M23_babip": ("fct_batting_performance", "babip:d3"),
    "M24_pitcher_win_pct": ("fct_pitching_performance", "win_pct:d3"),
    "M25_pitching_shares": ("fct_pitching_performance", "strikeout_pct:d3 walk_pct:d3"),
}
for _key, (_model, _columns) in METRICS.items():
    from_model(_key, _model, f"player_id:i season:i {_columns}", MODELS[_model][0])
TEAM_METRICS = {
    "M18_team_win_pct": ("int_team_standings", "win_pct:d3"),
    "M19_run_differential": ("int_team_standings", "run_differential:i"),
    "M20_games_behind": ("int_team_standings", "games_behind:d1"),
    "M27_team_ops": ("fct_team_season_summary", "team_ops:d3"),
    "M28_pythagorean": (
        "fct_team_season_summary", "pythagorean_win_pct:d3 pythagorean_wins:d0",
    ),
}
for _key, (_model, _columns) in TEAM_METRICS.items():
    from_model(_key, _model, f"team_id:i season:i {_columns}", MODELS[_model][0])
from_model("M26_winner_and_margin", "fct_game_summary",
           """game_pk:i run_margin:i winner:s winning_team_id:i losing_team_id:i
           is_extra_innings:b""", "summary")  # fmt: skip
add("M29_role", on(lambda w: w.int_player_season_pitching.withColumn(
        "role", boards.pitching.role())),
    "player_id:i season:i role:s",
    """SELECT *, CASE WHEN 2 * games_started > games THEN 'Starter' ELSE 'Reliever' END AS role
    FROM season_pitching""")  # fmt: skip
add("M30_luck", on(lambda w: w.fct_team_season_summary.withColumn(
        "luck_factor", boards.team.luck())),
    "team_id:i season:i luck_factor:d0",
    "SELECT *, wins - pythagorean_wins AS luck_factor FROM team_summary")

# ---------------------------------------------------------------- landing


def landed(kind: str, schema: str, flatten: Callable[[DataFrame], DataFrame]) -> Build:
    make = getattr(payloads, kind)
    return lambda spark, sf: flatten(landing.parse_payloads(make(spark, sf), "doc", schema))


add("S1_flatten_teams", landed("teams", landing.TEAMS_PAYLOAD, landing.flatten_teams),
    """team_id:i name:s team_code:s abbreviation:s team_name:s location_name:s league_id:i
    league_name:s division_id:i division_name:s venue_id:i venue_name:s sport_id:i active:b
    first_year_of_play:s""",
    """SELECT * REPLACE (CASE WHEN team_id % 4 = 1 THEN 11 ELSE 1 END AS sport_id,
    team_id % 3 = 0 OR active AS active) FROM raw_teams""")  # fmt: skip

_SPOTS_SQL = """SELECT player_id, arg_min(roster_team_id, place) AS roster_team_id FROM (
    SELECT o_custkey AS player_id, o_orderkey // 150 AS roster_team_id,
      2 * o_orderkey AS place FROM orders
    UNION ALL
    SELECT o_custkey // 2, o_orderkey // 150, 2 * o_orderkey + 1 FROM orders)
    GROUP BY player_id"""


def roster_spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed("rosters", landing.ROSTER_PAYLOAD, landing.first_roster_spots)(spark, sf_dir)


def landed_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = landing.parse_payloads(payloads.people(spark, sf_dir), "doc", landing.PEOPLE_PAYLOAD)
    return landing.flatten_players(people, roster_spots(spark, sf_dir))


add("S2_flatten_players", landed_players,
    """player_id:i full_name:s first_name:s last_name:s primary_number:s birth_date:t weight:i
    primary_position_code:s primary_position_name:s primary_position_type:s bat_side:s
    current_team_id:i active:b""",
    f"""SELECT p.* REPLACE (CASE WHEN player_id % 7 = 0 THEN '' ELSE full_name END AS full_name,
      player_id % 3 = 0 OR active AS active,
      CASE WHEN player_id % 17 = 0 OR player_id % 19 = 0 OR player_id // 15 = 0
        THEN s.roster_team_id ELSE player_id // 15 END AS current_team_id)
    FROM raw_players AS p LEFT JOIN ({_SPOTS_SQL}) AS s USING (player_id)""")  # fmt: skip
add("S3_first_roster_spot", roster_spots, "player_id:i roster_team_id:i", _SPOTS_SQL)
_LANDED_STATUS = "CASE status_code WHEN 'F' THEN 'F' WHEN 'P' THEN 'FT' ELSE 'S' END"
add("S4_flatten_schedule",
    landed("schedule", landing.SCHEDULE_PAYLOAD, landing.flatten_schedule),
    """game_pk:i game_date:t game_type:s season:i status_code:s status_detail:s home_team_id:i
    home_team_name:s away_team_id:i away_team_name:s venue_id:i venue_name:s day_night:s
    series_description:s series_game_number:i games_in_series:i double_header:s
    scheduled_innings:i""",
    f"""SELECT * REPLACE (CASE WHEN game_pk % 3 = 0 THEN 7 ELSE 9 END AS scheduled_innings,
    {_LANDED_STATUS} AS status_code) FROM raw_schedule""")  # fmt: skip
_INNINGS_SQL = """CASE WHEN game_pk % 2 = 0 THEN coalesce(innings, 9)
    WHEN game_pk % 3 = 0 THEN 7 END"""
add("S5_flatten_games", landed("schedule", landing.SCHEDULE_PAYLOAD, landing.flatten_games),
    """game_pk:i game_type:s season:i game_date:t status_code:s status_detail:s home_team_id:i
    away_team_id:i home_score:i away_score:i home_wins:i home_losses:i away_wins:i
    away_losses:i venue_id:i venue_name:s winning_pitcher_id:i losing_pitcher_id:i
    save_pitcher_id:i innings:i day_night:s series_description:s series_game_number:i
    double_header:s""",
    f"""SELECT * REPLACE ({_INNINGS_SQL} AS innings, {_LANDED_STATUS} AS status_code)
    FROM raw_games WHERE {_LANDED_STATUS} IN ('F', 'FT', 'FR', 'FO')""")  # fmt: skip
add("S6_innings_played", landed("schedule", landing.SCHEDULE_PAYLOAD, landing.flatten_games),
    "game_pk:i innings:i",
    f"""SELECT game_pk, {_INNINGS_SQL} AS innings FROM raw_games
    WHERE {_LANDED_STATUS} IN ('F', 'FT', 'FR', 'FO')""")  # fmt: skip
add("S7_pick_stat_group",
    landed("hitting", landing.HITTING_PAYLOAD, lambda d: d.select(
        "season", F.size(landing.stat_splits("hitting")).alias("splits"))
        .groupBy("season").agg(F.count(F.lit(1)).alias("people"),
                               F.sum("splits").alias("splits"))),
    "season:i people:i splits:i",
    """SELECT year(l_shipdate) AS season, count(*) AS people, count(*) AS splits
    FROM lineitem GROUP BY ALL""")  # fmt: skip
_LINE_SQL = """SELECT *, CAST(l_quantity AS INTEGER) AS q, l_linenumber AS n,
    year(l_shipdate) AS season, CASE WHEN l_linenumber = 7 THEN 'P' ELSE 'R' END AS game_type,
    l_suppkey AS team_id, 103 + l_suppkey % 2 AS league_id FROM lineitem"""
add("S8_flatten_batting",
    landed("hitting", landing.HITTING_PAYLOAD, landing.flatten_batting_stats),
    """player_id:i season:i team_id:i league_id:i game_type:s games_played:i at_bats:i hits:i
    home_runs:i walks:i batting_average:d3 ops:d3 runs:i""",
    f"""SELECT *, l_partkey AS player_id, 1 AS games_played,
      CASE WHEN q % 9 <> 0 THEN q END AS at_bats, CASE WHEN q % 10 <> 0 THEN q // 4 END AS hits,
      q // 16 AS home_runs, n AS walks, CASE WHEN q % 5 <> 0 THEN q * 7 END AS batting_average,
      1000 + q * 3 AS ops, NULL AS runs FROM ({_LINE_SQL}) WHERE n <> 6""")  # fmt: skip
add("S9_flatten_pitching",
    landed("pitching", landing.PITCHING_PAYLOAD, landing.flatten_pitching_stats),
    """player_id:i season:i team_id:i league_id:i game_type:s wins:i games:i
    innings_pitched:d1 era:d2 home_runs_allowed:i batting_average_against:d3 losses:i""",
    f"""SELECT *, l_orderkey // 10 AS player_id, q % 2 AS wins, 1 AS games,
      CASE WHEN q % 7 <> 0 THEN q // 3 * 10 + q % 3 ELSE 0 END AS innings_pitched,
      CASE WHEN q % 4 <> 0 THEN q % 9 * 100 + 25 END AS era, q // 25 AS home_runs_allowed,
      q * 9 AS batting_average_against, NULL AS losses
    FROM ({_LINE_SQL}) WHERE n <> 6""")  # fmt: skip




def _rest_entry(name: str, kind: str, rest: list[str], table: str, payload: str, flatten, player: str) -> None:
    """All statistics that the entry above doesn't compare."""
    places = payloads.places_of(table)
    spec = " ".join(f"{c}:{f'd{places[c]}' if places[c] else 'i'}" for c in rest)
    values = ", ".join(f"CASE WHEN q % 7 <> 0 THEN {payloads.rest_number(i)} END AS {c}" for i, c in enumerate(rest))
    add(name, landed(kind, payload, flatten), f"player_id:i season:i team_id:i {spec}",
        f"SELECT *, {player} AS player_id, {values} FROM ({_LINE_SQL}) WHERE n <> 6")


_rest_entry("S8_flatten_batting_rest", "hitting_rest", payloads.HITTING_REST, "batting_stats",
            landing.HITTING_PAYLOAD, landing.flatten_batting_stats, "l_partkey")
_rest_entry("S9_flatten_pitching_rest", "pitching_rest", payloads.PITCHING_REST, "pitching_stats",
            landing.PITCHING_PAYLOAD, landing.flatten_pitching_stats, "l_orderkey // 10")


# ---------------------------------------------------------------- landed loads

# Where the key of a document lies; documents of every 11th key land cut off.
_LOADS = {
    "teams": (payloads.teams, "$.teams[0].id"),
    "players": (payloads.people, "$.people[0].id"),
    "games": (payloads.schedule, "$.dates[0].games[0].gamePk"),
    "schedule": (payloads.schedule, "$.dates[0].games[0].gamePk"),
    "batting_stats": (payloads.hitting, "$.player_id"),
    "pitching_stats": (payloads.pitching, "$.player_id"),
}


def load_inputs(spark: SparkSession, sf_dir: str, table: str) -> tuple[DataFrame, DataFrame]:
    """Documents, some cut off, and a table that holds the rows with an even key already."""
    make, path = _LOADS[table]
    key = F.get_json_object("doc", path).cast("bigint")
    cut = F.expr("left(doc, length(doc) - 3)")
    texts = make(spark, sf_dir).select(F.when(key % 11 == 3, cut).otherwise(F.col("doc")).alias("doc"))
    stored = adapter.raw_tables(spark, sf_dir)[table]
    stored = stored.where(F.col(KEYS[table][0]) % 2 == 0)
    if table == "teams":
        stored = stored.withColumn("name", F.lit("stored"))
    elif "status_detail" in stored.columns:
        stored = stored.withColumn("status_detail", F.lit("stored"))
    return texts, stored


def loaded(spark: SparkSession, sf_dir: str, table: str) -> loads.Load:
    texts, stored = load_inputs(spark, sf_dir, table)
    rosters = None
    if table == "players":
        rosters = landing.parse_payloads(payloads.rosters(spark, sf_dir), "doc", landing.ROSTER_PAYLOAD)
    return loads.load(texts, "doc", table, stored, rosters)


def merged_load(table: str) -> Build:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = loaded(spark, sf_dir, table).merged
        return rows.withColumn("has_id", F.col("id").isNotNull()) if "id" in rows.columns else rows

    return build


def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each load read, couldn't read, and kept."""
    return reduce(DataFrame.unionByName, [
        loaded(spark, sf_dir, t).counts.select(F.lit(t).alias("table_name"), "*") for t in _LOADS
    ])


# Lines of a landed file: a compressed file is read by one task.
_LANDED_LINES = 20000


def streamed(spark: SparkSession, sf_dir: str) -> str:
    """Schedule documents that land twice, some cut off, over a store that holds the rows with an even key."""
    folder, landed = fresh_path(spark, "documents"), fresh_path(spark, "landed")
    texts, stored = load_inputs(spark, sf_dir, "schedule")
    VersionedTable.create(f"{folder}/{documents.TABLE}", stored, KEYS["schedule"])
    for _ in range(2):
        texts.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", _LANDED_LINES).text(landed)
        stream = documents.document_stream(spark, landed, one_per_file=False)
        documents.load_stream(stream, "schedule", folder).awaitTermination()
    return folder


def streamed_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents.open_table(spark, streamed(spark, sf_dir), "schedule").read()
    return rows.withColumn("has_id", F.col("id").isNotNull())


def streamed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each batch what it read and kept, and the documents among its rejects."""
    folder = streamed(spark, sf_dir)
    rejects = documents.read_rejects(spark, folder).groupBy("batch").agg(F.count("content").alias("rejects"))
    return documents.read_counts(spark, folder).join(rejects, "batch")


_STORED_GAME = "game_pk % 11 = 3 AND game_pk % 2 = 0"
add("L1_load_teams", merged_load("teams"),
    "team_id:i name:s team_code:s league_id:i division_name:s sport_id:i active:b",
    """SELECT * REPLACE (CASE WHEN team_id % 4 = 1 THEN 11 ELSE 1 END AS sport_id,
      team_id % 3 = 0 OR active AS active) FROM raw_teams WHERE team_id % 11 <> 3
    UNION ALL SELECT * REPLACE ('stored' AS name) FROM raw_teams
    WHERE team_id % 11 = 3 AND team_id % 2 = 0""")  # fmt: skip
_SCHEDULE_SPEC = """game_pk:i game_date:t season:i status_code:s status_detail:s home_team_id:i
    scheduled_innings:i has_id:b"""
_SCHEDULE_SQL = f"""SELECT *, true AS has_id FROM (
    SELECT * REPLACE (CASE WHEN game_pk % 3 = 0 THEN 7 ELSE 9 END AS scheduled_innings,
      {_LANDED_STATUS} AS status_code) FROM raw_schedule WHERE game_pk % 11 <> 3
    UNION ALL SELECT * REPLACE ('stored' AS status_detail) FROM raw_schedule
    WHERE {_STORED_GAME})"""
add("L2_load_schedule", merged_load("schedule"), _SCHEDULE_SPEC, _SCHEDULE_SQL)
add("L3_load_games", merged_load("games"),
    "game_pk:i game_date:t season:i status_code:s status_detail:s home_score:i innings:i",
    f"""SELECT * REPLACE ({_INNINGS_SQL} AS innings, {_LANDED_STATUS} AS status_code)
    FROM raw_games WHERE {_LANDED_STATUS} IN ('F', 'FT', 'FR', 'FO') AND game_pk % 11 <> 3
    UNION ALL SELECT * REPLACE ('stored' AS status_detail) FROM raw_games
    WHERE game_pk % 2 = 0 AND (game_pk % 11 = 3
      OR {_LANDED_STATUS} NOT IN ('F', 'FT', 'FR', 'FO'))""")  # fmt: skip


def _load_count_sql(table: str, documents: str, key: str, rows: str) -> str:
    return f"""SELECT '{table}' AS table_name, count(*) AS documents,
      count(*) FILTER ({key} % 11 = 3) AS unreadable,
      count(*) FILTER ({key} % 11 <> 3 AND {rows}) AS rows, 0 AS incomplete,
      count(*) FILTER ({key} % 11 <> 3 AND {rows}) AS kept FROM {documents}"""


add("L4_load_counts", load_counts,
    "table_name:s documents:i unreadable:i rows:i incomplete:i kept:i",
    " UNION ALL ".join([
        _load_count_sql("teams", "raw_teams", "team_id", "true"),
        _load_count_sql("players", "raw_players", "player_id", "true"),
        _load_count_sql("games", "raw_games", "game_pk",
                        f"{_LANDED_STATUS} IN ('F', 'FT', 'FR', 'FO')"),
        _load_count_sql("schedule", "raw_schedule", "game_pk", "true"),
        _load_count_sql("batting_stats", "lineitem", "l_partkey", "l_linenumber <> 6"),
        _load_count_sql("pitching_stats", "lineitem", "(l_orderkey // 10)", "l_linenumber <> 6"),
    ]))
add("L5_stream_schedule", streamed_schedule, _SCHEDULE_SPEC, _SCHEDULE_SQL)
add("L6_stream_counts", streamed_counts,
    "batch:i documents:i unreadable:i rows:i incomplete:i kept:i rejects:i",
    """SELECT batch, count(*) AS documents, count(*) FILTER (game_pk % 11 = 3) AS unreadable,
      count(*) FILTER (game_pk % 11 <> 3) AS rows, 0 AS incomplete,
      count(*) FILTER (game_pk % 11 <> 3) AS kept, count(*) FILTER (game_pk % 11 = 3) AS rejects
    FROM raw_schedule, (SELECT unnest([0, 1]) AS batch) GROUP BY batch""")  # fmt: skip


def _texts(spark: SparkSession, sf_dir: str, text: Column, parsed: Callable) -> DataFrame:
    """How many texts per flag are readable, and their sum."""
    rows = adapter.table(spark, sf_dir, "lineitem").select("l_returnflag", text.alias("text"))
    return rows.select("l_returnflag", parsed(F.col("text")).alias("v")).groupBy(
        "l_returnflag"
    ).agg(
        F.count(F.lit(1)).alias("n"), F.count("v").alias("readable"), F.sum("v").alias("total")
    )


add("S10_safe_int", lambda spark, sf: _texts(
        spark, sf,
        F.when(F.col("l_linenumber") == 1, "").when(F.col("l_linenumber") == 2, "12.0")
        .otherwise(F.col("l_partkey").cast("string")), coerce.safe_int),
    "l_returnflag:s n:i readable:i total:i",
    """SELECT l_returnflag, count(*) AS n, count(*) FILTER (l_linenumber > 2) AS readable,
    sum(l_partkey) FILTER (l_linenumber > 2) AS total FROM lineitem GROUP BY ALL""")  # fmt: skip
add("S11_safe_numeric", lambda spark, sf: _texts(
        spark, sf,
        F.when(F.col("l_linenumber") == 1, ".---").when(F.col("l_linenumber") == 2, "-.--")
        .otherwise(F.concat(F.lit("."), F.lpad((F.col("l_partkey") % 1000).cast("string"), 3,
                                               "0"))),
        lambda c: coerce.safe_numeric(c, "decimal(5,3)")),
    "l_returnflag:s n:i readable:i total:d3",
    """SELECT l_returnflag, count(*) AS n, count(*) FILTER (l_linenumber > 2) AS readable,
    sum(l_partkey % 1000) FILTER (l_linenumber > 2) AS total
    FROM lineitem GROUP BY ALL""")  # fmt: skip

_LANDED_SQL = """SELECT l_orderkey AS game_pk, CAST(l_shipdate AS DATE) AS game_date,
    year(l_shipdate) AS game_year, CASE WHEN l_linenumber <> 5 THEN l_suppkey END AS batter,
    CASE WHEN l_partkey % 23 <> 0 THEN l_partkey END AS pitcher, 'B' || l_suppkey AS batter_name,
    NULL AS pitcher_name, CASE WHEN l_linestatus = 'F' THEN 'single' END AS events,
    l_returnflag AS description,
    CASE WHEN CAST(l_quantity AS INTEGER) % 3 <> 0 THEN CAST(l_quantity AS INTEGER) END AS zone,
    CASE WHEN l_returnflag <> 'N' THEN 600 + 10 * CAST(l_quantity AS INTEGER) + l_linenumber END
      AS launch_speed,
    10 * (l_partkey % 800 - 200) AS launch_angle, l_linenumber AS at_bat_number,
    1 + l_partkey % 6 AS pitch_number, NULL AS inning FROM lineitem"""
LANDED_SPEC = """game_pk:i game_date:t game_year:i batter:i pitcher:i batter_name:s
    pitcher_name:s events:s description:s zone:i launch_speed:d1 launch_angle:d1
    at_bat_number:i pitch_number:i inning:i"""


def landed_pitches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.landed_pitches(adapter.table(spark, sf_dir, "lineitem"))


add("S12_map_pitch_columns", lambda spark, sf: pitches.map_columns(landed_pitches(spark, sf)),
    "batter_name:s pitcher_name:s events:s description:s inning:i",
    f"SELECT * FROM ({_LANDED_SQL})")
add("S13_coerce_pitches", lambda spark, sf: pitches.coerce(
        pitches.map_columns(landed_pitches(spark, sf))),
    LANDED_SPEC, f"SELECT * FROM ({_LANDED_SQL})")
_COMPLETE_SQL = f"""SELECT * FROM ({_LANDED_SQL})
    WHERE batter IS NOT NULL AND pitcher IS NOT NULL AND game_date IS NOT NULL"""
add("S14_complete_pitches", lambda spark, sf: pitches.pitch_rows(landed_pitches(spark, sf)),
    LANDED_SPEC, _COMPLETE_SQL)


_REST_SPEC = " ".join(f"{c}:{fillers.KINDS[c]}" for c in payloads.LANDED_REST)
_REST_SQL = "SELECT " + ", ".join(f"{fillers.sql(c)} AS {c}" for c in payloads.LANDED_REST)
add("S13_coerce_pitches_rest", lambda spark, sf: pitches.coerce(
        pitches.map_columns(landed_pitches(spark, sf))),
    f"{_REST_SPEC} release_extension:d1",
    f"{_REST_SQL}, NULL AS release_extension FROM lineitem")


def games_per_chunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks over the span of the schedule and how many games fall in each."""
    games = adapter.raw_table(spark, sf_dir, "schedule")
    span = games.agg(F.min("game_date").alias("start"), F.max("game_date").alias("end"))
    per_day = _counted(games, "game_date").withColumnRenamed("game_date", "day")
    return (
        chunks.days_of(chunks.date_chunks(span))
        .join(per_day, "day", "left")
        .groupBy("chunk_id", "chunk_start", "chunk_end")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("games"))
    )


add("S15_date_chunks", games_per_chunk, "chunk_id:i chunk_start:t chunk_end:t games:i",
    """SELECT c.chunk_id, c.chunk_start, c.chunk_end, count(game_pk) AS games FROM (
      SELECT i AS chunk_id, CAST(first + CAST(5 * i AS INTEGER) AS DATE) AS chunk_start,
        least(CAST(first + CAST(5 * i + 4 AS INTEGER) AS DATE), last) AS chunk_end
      FROM (SELECT min(game_date) AS first, max(game_date) AS last FROM raw_schedule),
        range(100000) AS r(i) WHERE first + CAST(5 * i AS INTEGER) <= last) AS c
    LEFT JOIN raw_schedule AS s ON s.game_date BETWEEN c.chunk_start AND c.chunk_end
    GROUP BY ALL""")  # fmt: skip


def _sizes(frames: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in frames.items()
    ]
    return quality.together(counts)


def stored_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw tables written whole to storage and read back with their declared schemas."""
    folder = fresh_path(spark, "raw")
    written = {
        name: df.select(*[F.col(c.name).cast(c.dataType) for c in tables.raw_schema(name)])
        for name, df in adapter.raw_tables(spark, sf_dir).items()
    }
    sinks.export_tables(written, folder)
    return _sizes(tables.read_raw(spark, folder))


add("S16_table_source", stored_raw, "table_name:s n:i", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS n FROM raw_{name}"
    for name in adapter.RAW_TABLES))



def stored_models(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Models over raw tables that were written whole and read back with their declared schemas."""
    folder = fresh_path(spark, "raw")
    written = {
        name: df.select(*[F.col(c.name).cast(c.dataType) for c in tables.raw_schema(name)])
        for name, df in adapter.raw_tables(spark, sf_dir).items()
    }
    sinks.export_tables(written, folder)
    return Warehouse(tables.read_raw(spark, folder))


add("S16_stored_games", lambda spark, sf: stored_models(spark, sf).stg_games, GAME_SPEC,
    f"SELECT *, {STATUS} FROM raw_games")
add("S16_stored_statcast", lambda spark, sf: stored_models(spark, sf).stg_statcast, PITCH_SPEC,
    PITCH_SQL)

_SEED_VALUES = ", ".join(
    "(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")"
    for row in tables.seed_rows()
)
_SEED_SQL = f"""SELECT coalesce(s.team_id, t.team_id) AS team_id,
    coalesce(s.name, t.name) AS name, coalesce(s.abbreviation, t.abbreviation) AS abbreviation,
    t.team_code, coalesce(s.team_name, t.team_name) AS team_name,
    coalesce(s.location_name, t.location_name) AS location_name, t.league_id,
    coalesce(s.league_name, t.league_name) AS league_name,
    CASE WHEN s.team_id IS NULL THEN t.division_name ELSE s.division_name END AS division_name,
    t.venue_id, CASE WHEN t.team_id IS NULL THEN 1 ELSE t.sport_id END AS sport_id,
    CASE WHEN s.team_id IS NULL THEN t.active ELSE s.active END AS active
    FROM raw_teams AS t FULL JOIN (VALUES {_SEED_VALUES}) AS s({", ".join(tables.SEED_COLUMNS)},
      active) ON s.team_id = t.team_id"""
add("S17_seed_teams", lambda spark, sf: tables.seed_teams(adapter.raw_table(spark, sf, "teams")),
    """team_id:i name:s abbreviation:s team_code:s team_name:s location_name:s league_id:i
    league_name:s division_name:s venue_id:i sport_id:i active:b""", _SEED_SQL)  # fmt: skip

# ---------------------------------------------------------------- sinks and merges


def appended_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "pitches")
    for _ in range(2):
        sinks.append(adapter.raw_table(spark, sf_dir, "statcast"), path, partition_by="game_year")
    return warehouse_over(spark, sf_dir, statcast=spark.read.parquet(path)).stg_statcast


def warehouse_over(spark: SparkSession, sf_dir: str, **tables: DataFrame) -> Warehouse:
    return Warehouse({**adapter.raw_tables(spark, sf_dir), **tables})


add("K1_append", appended_twice, PITCH_SPEC,
    f"SELECT * FROM ({PITCH_SQL}) UNION ALL SELECT * FROM ({PITCH_SQL})")


def schedule_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrections from line items: many per game, most games known, some new."""
    lines = adapter.table(spark, sf_dir, "lineitem")
    return lines.select(
        (F.col("l_orderkey") + F.col("l_suppkey") % 3 * 1000000).alias("game_pk"),
        F.concat(F.lit("Revised "), F.col("l_partkey").cast("string")).alias("status_detail"),
        F.col("l_suppkey").alias("venue_id"),
        F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_linenumber").alias("seq"),
    )


_BATCH_SQL = """SELECT game_pk, arg_min(d, seq) AS first_detail, arg_max(d, seq) AS last_detail,
    arg_min(v, seq) AS first_venue, arg_max(v, seq) AS last_venue FROM (
      SELECT l_orderkey + l_suppkey % 3 * 1000000 AS game_pk, 'Revised ' || l_partkey AS d,
        l_suppkey AS v, row(l_shipdate, l_partkey, l_suppkey, l_linenumber) AS seq
      FROM lineitem) GROUP BY game_pk"""
MERGE_SPEC = "game_pk:i status_detail:s venue_id:i home_team_id:i scheduled_innings:i"


def _merged(update: list[str] | None) -> Build:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return merge.merge(
            adapter.raw_table(spark, sf_dir, "schedule"), schedule_batch(spark, sf_dir), ["game_pk"], "seq",
            update_columns=update, defaults=DEFAULTS["schedule"],
        )

    return build


def _merged_sql(detail: str, venue: str) -> str:
    return f"""SELECT coalesce(t.game_pk, b.game_pk) AS game_pk, {detail} AS status_detail,
    {venue} AS venue_id, t.home_team_id,
    CASE WHEN t.game_pk IS NULL THEN 9 ELSE t.scheduled_innings END AS scheduled_innings
    FROM raw_schedule AS t FULL JOIN ({_BATCH_SQL}) AS b ON b.game_pk = t.game_pk"""


_NEW_VENUE = "CASE WHEN t.game_pk IS NULL THEN b.first_venue ELSE t.venue_id END"
add("K2_upsert", _merged(None), MERGE_SPEC, _merged_sql(
    "coalesce(b.last_detail, t.status_detail)", "coalesce(b.last_venue, t.venue_id)"))
add("K3_partial_upsert", _merged(["status_detail"]), MERGE_SPEC, _merged_sql(
    "coalesce(b.last_detail, t.status_detail)", _NEW_VENUE))
add("K4_insert_only", _merged([]), MERGE_SPEC, _merged_sql(
    "CASE WHEN t.game_pk IS NULL THEN b.first_detail ELSE t.status_detail END", _NEW_VENUE))




def merged_files(spark: SparkSession, sf_dir: str, update: list[str] | None) -> DataFrame:
    """The same merge into a versioned table, and once more under the same name, which does nothing."""
    target = adapter.raw_table(spark, sf_dir, "schedule")
    stored = VersionedTable.create(fresh_path(spark, "schedule"), target, ["game_pk"])
    for _ in range(2):
        stored.merge(schedule_batch(spark, sf_dir), ["game_pk"], "seq", update, DEFAULTS["schedule"], load="batch")
    return stored.read()


add("K2_upsert_files", lambda spark, sf: merged_files(spark, sf, None), MERGE_SPEC, _merged_sql(
    "coalesce(b.last_detail, t.status_detail)", "coalesce(b.last_venue, t.venue_id)"))
add("K4_insert_files", lambda spark, sf: merged_files(spark, sf, []), MERGE_SPEC, _merged_sql(
    "CASE WHEN t.game_pk IS NULL THEN b.first_detail ELSE t.status_detail END", _NEW_VENUE))


def compound_key_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A compound key with a NULL part: such rows never match and are all inserted."""
    target = adapter.raw_table(spark, sf_dir, "batting_stats")
    q = F.col("l_quantity").cast("int")
    batch = adapter.table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("player_id"),
        F.year("l_shipdate").alias("season"),
        F.when(F.col("l_linenumber") != 3, F.col("l_suppkey")).alias("team_id"),
        F.when(F.col("l_linenumber") == 7, "P").otherwise("R").alias("game_type"),
        (q + 1000).alias("rbi"),
        F.struct("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice").alias("seq"),
    )
    merged = merge.merge(target, batch, KEYS["batting_stats"], "seq")
    keyed = F.col("team_id").isNotNull()
    return merged.groupBy("season", keyed.alias("keyed")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("rbi").alias("rbi"), F.sum("hits").alias("hits")
    )


add("K5_compound_keys", compound_key_upsert, "season:i keyed:b n:i rbi:i hits:i",
    """WITH batch AS (SELECT l_partkey AS player_id, year(l_shipdate) AS season,
      CASE WHEN l_linenumber <> 3 THEN l_suppkey END AS team_id,
      CASE WHEN l_linenumber = 7 THEN 'P' ELSE 'R' END AS game_type,
      CAST(l_quantity AS INTEGER) + 1000 AS rbi,
      row(l_orderkey, l_linenumber, l_quantity, l_extendedprice) AS seq FROM lineitem),
    last_rows AS (SELECT player_id, season, team_id, game_type, arg_max(rbi, seq) AS rbi
      FROM batch WHERE team_id IS NOT NULL GROUP BY ALL)
    SELECT season, true AS keyed, count(*) AS n, sum(coalesce(b.rbi, t.rbi)) AS rbi,
      sum(t.hits) AS hits
    FROM raw_batting_stats AS t FULL JOIN last_rows AS b USING (player_id, season, team_id, game_type)
    GROUP BY season
    UNION ALL
    SELECT season, false, count(*), sum(rbi), NULL FROM batch WHERE team_id IS NULL
    GROUP BY season""")  # fmt: skip
add("K6_view", lambda spark, sf: sinks.replace_view(
        warehouse(spark, sf).stg_games, "sabermill_stg_games").sparkSession.sql(
        "SELECT * FROM sabermill_stg_games"),
    GAME_SPEC, f"SELECT *, {STATUS} FROM raw_games")
add("K7_table", lambda spark, sf: sinks.replace_table(
        warehouse(spark, sf).int_statcast_metrics, fresh_path(spark, "metrics")),
    CONTACT_SPEC, "SELECT * FROM contact")


def exported(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = warehouse(spark, sf_dir)
    paths = sinks.export_tables({m: w.model(m) for m in MARTS}, fresh_path(spark, "marts"))
    return _sizes(sinks.read_tables(spark, paths))


_MART_PARTS = {
    "dim_players": "players", "dim_teams": "raw_teams",
    **{name: part for name, (part, _) in MODELS.items() if name.startswith("fct_")},
}
add("K8_export_marts", exported, "table_name:s n:i", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS n FROM {part}"
    for name, part in _MART_PARTS.items()))


def exported_version(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A mart of the second of two exports."""
    folder, w = fresh_path(spark, "export"), warehouse(spark, sf_dir)
    export_version({name: w.model(name).limit(0)}, folder)
    export_version({name: w.model(name), "dim_teams": w.dim_teams}, folder)
    return read_export(spark, folder)[name]


for _name, (_part, _spec) in MODELS.items():
    if _name in MARTS:
        add(f"K8_export_{_name}", lambda spark, sf, n=_name: exported_version(spark, sf, n), _spec,
            f"SELECT * FROM {_part}")


def chunk_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pitches loaded year by year of days: one chunk fails at first, and one is loaded twice."""
    landed = pitches.pitch_rows(landed_pitches(spark, sf_dir))
    stored = VersionedTable.create(fresh_path(spark, "chunked"), landed.limit(0))
    span = landed.agg(F.min("game_date"), F.max("game_date")).first()
    parts = [(r.chunk_start, r.chunk_end) for r in chunks.chunks_between(spark, *span, chunk_days=366).collect()]
    failed = []

    def fetch(start, end):
        if start == parts[-1][0] and not failed:
            failed.append(start)
            raise OSError("no answer")
        return landed

    load_chunks(stored, parts, fetch, "game_date")
    load_chunks(stored, parts, fetch, "game_date")
    load_chunks(stored, parts[:1], fetch, "game_date", again=True)
    return stored.read()


add("S15_chunk_load", chunk_loaded, LANDED_SPEC, _COMPLETE_SQL)

# ---------------------------------------------------------------- incremental ingest


def _landed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = adapter.table(spark, sf_dir, "lineitem").schema
    lines = ingest.landed_stream(spark, sf_dir, schema, pathGlobFilter="lineitem.parquet")
    return payloads.landed_pitches(lines)


def ingested_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the same landed file store it once."""
    path, checkpoint = fresh_path(spark, "stream"), fresh_path(spark, "stream-checkpoint")
    for _ in range(2):
        ingest.append_stream(_landed_stream(spark, sf_dir), path, checkpoint).awaitTermination()
    return ingest.read_appended(spark, path)


def ingested_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "keyed-stream")
    for _ in range(2):
        ingest.keyed_stream(_landed_stream(spark, sf_dir), path, buckets=8).awaitTermination()
    return ingest.read_store(spark, path)


add("I1_ingest_append", ingested_once, LANDED_SPEC, _COMPLETE_SQL)
add("I1_ingest_keyed", ingested_by_key,
    LANDED_SPEC,
    f"""SELECT * FROM ({_COMPLETE_SQL}) QUALIFY row_number() OVER (
    PARTITION BY {", ".join(PITCH_KEY)} ORDER BY game_date, batter, pitcher) = 1""")  # fmt: skip

# ---------------------------------------------------------------- data quality

# Model -> SQL that has its columns under their published names.
_STAGED = {
    "stg_teams": TEAM_SQL,
    "stg_players": f"SELECT *, {PLAYER_NAMES} FROM raw_players",
    "stg_games": f"SELECT *, {STATUS} FROM raw_games",
    "stg_schedule": f"SELECT *, id AS schedule_id, {STATUS} FROM raw_schedule",
    "stg_batting_stats": "SELECT *, row_number() OVER () AS batting_stats_id FROM raw_batting_stats",
    "stg_pitching_stats": "SELECT *, row_number() OVER () AS pitching_stats_id FROM raw_pitching_stats",
    "stg_statcast": f"""SELECT *, row(l_orderkey, l_linenumber, l_partkey, l_suppkey)
        AS statcast_id FROM ({PITCH_SQL})""",
    "dim_players": f"SELECT *, {PLAYER_NAMES} FROM players",
    "dim_teams": TEAM_SQL,
    **{name: f"SELECT * FROM {part}" for name, (part, _) in MODELS.items()},
    "raw_teams": "SELECT * FROM raw_teams",
    "raw_players": "SELECT * FROM raw_players",
    "raw_games": "SELECT * FROM raw_games",
    "raw_schedule": "SELECT * FROM raw_schedule",
    "raw_batting_stats": "SELECT *, row_number() OVER () AS id FROM raw_batting_stats",
    "raw_pitching_stats": "SELECT *, row_number() OVER () AS id FROM raw_pitching_stats",
    "raw_statcast": """SELECT *, row(l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id
        FROM raw_statcast""",
}


def _check_sql(check: str, table: str, column: str, violations: str, tail: str) -> str:
    return (
        f"""SELECT '{check}' AS "check", '{table}' AS table_name, '{column}' AS column_name, """
        f"{violations} AS violations {tail}"
    )


def _count_sql(check: str, table: str, column: str, bad: str) -> str:
    rows = f"FROM ({_STAGED[table]}) AS t"
    return _check_sql(check, table, column, f"count(*) FILTER ({bad})", rows)


def _all(statements: list[str]) -> str:
    return "\nUNION ALL ".join(statements)


def _keys() -> list[tuple[str, str]]:
    return [*((f"raw_{t}", c) for t, c in suite.RAW_KEYS.items()), *suite.UNIQUE.items()]


def _unique_sql(table: str, column: str) -> str:
    repeated = f"""(SELECT {column} FROM ({_STAGED[table]}) WHERE {column} IS NOT NULL
        GROUP BY {column} HAVING count(*) > 1)"""
    return _check_sql("unique", table, column, "count(*)", f"FROM {repeated}")


def _related_sql(check: str, table: str, column: str, parent: str, parent_column: str) -> str:
    orphans = f"""FROM ({_STAGED[table]}) AS c WHERE {column} IS NOT NULL AND NOT EXISTS (
        SELECT 1 FROM ({_STAGED[parent]}) AS p WHERE p.{parent_column} = c.{column})"""
    return _check_sql(check, table, column, "count(*)", orphans)


def _accepted_sql(divisions: list[str]) -> str:
    statements = []
    for table, columns in suite.ACCEPTED.items():
        for column, values in columns.items():
            allowed = divisions if column == "division_name" else values
            listed = ", ".join(f"'{v}'" for v in allowed)
            statements.append(
                _count_sql("accepted_values", table, column, f"{column} NOT IN ({listed})")
            )
    return _all(statements)


add("D1_unique", on(suite.uniqueness), CHECK_SPEC, _all([_unique_sql(t, c) for t, c in _keys()]))
add("D2_not_null", on(suite.completeness), CHECK_SPEC, _all([
    _count_sql("not_null", t, c, f"{c} IS NULL")
    for t, c in [*((f"raw_{t}", c) for t, c in suite.RAW_KEYS.items()),
                 *((t, c) for t, cs in suite.NOT_NULL.items() for c in cs.split())]]))
add("D3_accepted_values", on(suite.accepted_values), CHECK_SPEC, _accepted_sql(suite.DIVISIONS))
add("D3_accepted_values_long_divisions",
    on(lambda w: suite.accepted_values(w, list(boards.DIVISION_PAGES.values()))), CHECK_SPEC,
    _accepted_sql(adapter.DIVISIONS))
add("D4_relationships", on(suite.relationships), CHECK_SPEC,
    _all([_related_sql("relationships", *r) for r in suite.RELATED]))
_SPEED_OUT = "release_speed < 400 OR release_speed > 1100"
_EXIT_OUT = "exit_velocity < 100 OR exit_velocity > 1250"
_NO_SCORE = "game_status_code = 'F' AND (home_score IS NULL OR away_score IS NULL"
add("D5_ranges", on(suite.ranges), CHECK_SPEC, _all([
    _count_sql("in_range", t, c, bad) for t, c, bad in [
        ("stg_batting_stats", "batting_average",
         "batting_average < 0 OR batting_average > 1000"),
        ("stg_pitching_stats", "era", "era < 0"),
        ("stg_statcast", "release_speed", _SPEED_OUT),
        ("stg_statcast", "exit_velocity", _EXIT_OUT),
        ("stg_statcast", "release_speed, exit_velocity", f"{_SPEED_OUT} OR {_EXIT_OUT}"),
        ("int_player_season_pitching", "fip",
         "innings_pitched > 0 AND (fip < -500 OR fip > 3000)"),
        ("fct_batting_performance", "walk_pct", "walk_pct < 0 OR walk_pct > 1000"),
        ("fct_batting_performance", "strikeout_pct",
         "strikeout_pct < 0 OR strikeout_pct > 1000"),
    ]] + [
    _count_sql("scored", "stg_games", "home_score, away_score", f"{_NO_SCORE})"),
    _count_sql("scored_in_range", "stg_games", "home_score, away_score",
               f"{_NO_SCORE} OR home_score < 0 OR away_score < 0)")]))
add("D6_tolerances", on(suite.tolerances), CHECK_SPEC, _all([
    _count_sql("ops_near_sum", "int_player_season_batting", "on_base_plus_slugging",
               "abs(on_base_plus_slugging - on_base_percentage - slugging_percentage) > 5"),
    _count_sql("expected_wins_near_wins", "fct_team_season_summary", "pythagorean_wins",
               "abs(pythagorean_wins - wins) > 15"),
    _count_sql("wins_and_losses_make_games", "int_team_standings", "games_played",
               "wins + losses <> games_played")]))
_SIDES_SQL = """(SELECT game_pk, count(*) AS sides, count(*) FILTER (is_win) AS won,
    count(*) FILTER (is_loss) AS lost FROM game_results GROUP BY game_pk)"""
add("D7_group_consistency", on(suite.game_consistency), CHECK_SPEC, _all([
    _check_sql(check, "int_game_results", "game_pk", f"count(*) FILTER ({bad})",
               f"FROM {_SIDES_SQL}")
    for check, bad in [
        ("two_rows_one_winner_one_loser", "sides <> 2 OR won <> 1 OR lost <> 1"),
        ("two_rows", "sides <> 2"), ("one_winner", "won <> 1")]]))
add("D8_minimum_rows", on(suite.minimum_rows), CHECK_SPEC, _all([
    _check_sql(f"at_least_{n}_rows", t, "", f"greatest({n} - count(*), 0)",
               f"FROM ({_STAGED[t]})")
    for t, n in [*((f"raw_{t}", n) for t, n in suite.MIN_ROWS.items()),
                 *((t, 1) for t in suite.FILLED_MARTS)]]))
add("D9_layer_sizes", on(suite.layer_sizes), CHECK_SPEC, _all([
    _check_sql("same_row_count", " = ".join(names), "", "max(n) - min(n)", "FROM (" + " UNION ALL "
               .join(f"SELECT count(*) AS n FROM ({_STAGED[t]})" for t in names) + ")")
    for names in suite.SAME_SIZE]))
add("D10_null_shares", on(suite.null_shares), CHECK_SPEC, _all([
    _check_sql(f"null_share_below_{limit}", f"raw_{t}", c,
               f"CASE WHEN 100 * (count(*) - count({c})) >= {round(float(limit) * 100)} * count(*)"
               " AND count(*) > 0 THEN 1 ELSE 0 END", f"FROM raw_{t}")
    for t, columns in suite.NULL_SHARES.items() for c, limit in columns.items()]))
add("D11_distinct_keys", on(suite.distinct_keys), CHECK_SPEC, _all([
    _check_sql("rows_equal_keys", t, c, f"count(*) - count(DISTINCT {c})",
               f"FROM ({_STAGED[t]})")
    for t, c in suite.DISTINCT_KEYS.items()]))
add("D12_traceability", on(suite.traceability), CHECK_SPEC,
    _all([_related_sql("traced", *r) for r in suite.TRACED]))

# ---------------------------------------------------------------- dashboard queries


def _slice(spec: str, names: str) -> str:
    kinds = dict(oracle.columns(spec))
    return " ".join(f"{n}:{kinds[n]}" for n in names.split())


add("Q1_total_games", on(lambda w: boards.total_games(w.fct_game_summary)), KPI_SPEC, KPI_SQL)
add("Q2_total_hr", on(lambda w: boards.total_home_runs(w.fct_batting_performance)),
    "total_home_runs:i", HR_SQL)
add("Q3_top_teams", on(lambda w: boards.top_teams(w.fct_team_season_summary)),
    _slice(TEAM_SEASON_SPEC, "team_abbreviation team_full_name wins losses win_pct "
           "run_differential season"),
    """SELECT * FROM team_summary ORDER BY win_pct DESC NULLS LAST, team_id, season
    LIMIT 10""")  # fmt: skip
add("Q4_recent_games", on(lambda w: boards.recent_games(w.fct_game_summary)),
    """game_date:t matchup:s score:s winning_team:s winning_pitcher_name:s
    losing_pitcher_name:s save_pitcher_name:s extras:s""",
    """SELECT *, away_team_name || ' @ ' || home_team_name AS matchup,
      away_score || ' - ' || home_score AS score,
      CASE winner WHEN 'home' THEN home_team_name ELSE away_team_name END AS winning_team,
      CASE WHEN is_extra_innings THEN 'Yes' ELSE 'No' END AS extras
    FROM summary WHERE game_type = 'R' ORDER BY game_date DESC, game_pk LIMIT 20""")  # fmt: skip
add("Q5_team_scatter", on(lambda w: boards.team_scatter(w.fct_team_season_summary)),
    _slice(TEAM_SEASON_SPEC, "team_abbreviation team_full_name win_pct run_differential "
           "division_name season"), "SELECT * FROM team_summary")  # fmt: skip
for _key, _model, _part in [
    ("Q6_batting_seasons", "fct_batting_performance", "batting"),
    ("Q14_pitching_seasons", "fct_pitching_performance", "pitching"),
    ("Q21_standings_seasons", "fct_team_season_summary", "team_summary"),
    ("Q31_statcast_seasons", "fct_statcast_leaders", "leaders"),
]:
    add(_key, on(lambda w, m=_model: boards.pick_list(w.model(m), "season", newest_first=True)),
        "season:i", f"SELECT DISTINCT season FROM {_part}")
add("Q7_positions", on(lambda w: boards.pick_list(w.fct_batting_performance, "position_name")),
    "position_name:s",
    "SELECT DISTINCT position_name FROM batting WHERE position_name IS NOT NULL")
for _key in ("Q8_batting_teams", "Q15_pitching_teams"):
    add(_key, on(lambda w: boards.pick_list(w.dim_players, "current_team_name")),
        "current_team_name:s",
        """SELECT DISTINCT current_team_name FROM players
        WHERE current_team_name IS NOT NULL""")  # fmt: skip


def _batting_base(w: Warehouse) -> DataFrame:
    return boards.batting_leaders(w.fct_batting_performance, w.dim_players, SEASON, MIN_PA)


def _pitching_base(w: Warehouse) -> DataFrame:
    return boards.pitching_leaders(w.fct_pitching_performance, w.dim_players, SEASON, MIN_IP)


def _standings_base(w: Warehouse) -> DataFrame:
    return boards.standings(w.fct_team_season_summary, SEASON)


def _contact_base(w: Warehouse) -> DataFrame:
    return boards.statcast_data(w.fct_statcast_leaders, w.dim_players, SEASON, "batter")


_BATTING_BASE_SQL = f"""SELECT b.*, p.current_team_name FROM batting AS b
    LEFT JOIN players AS p USING (player_id)
    WHERE b.season = {SEASON} AND b.plate_appearances >= {MIN_PA}"""
_PITCHING_BASE_SQL = f"""SELECT b.*, p.current_team_name FROM pitching AS b
    LEFT JOIN players AS p USING (player_id)
    WHERE b.season = {SEASON} AND b.innings_pitched >= {MIN_IP * 10}"""
_STANDINGS_BASE_SQL = f"SELECT * FROM team_summary WHERE season = {SEASON}"
_CONTACT_BASE_SQL = f"""SELECT b.*, p.current_team_name FROM leaders AS b
    LEFT JOIN players AS p USING (player_id)
    WHERE b.season = {SEASON} AND b.player_role = 'batter'"""
_WITH_TEAM = "current_team_name:s"


def board(
    key: str, base: Callable, step: Callable | None, sql: str, kinds: str, names: str,
    tail: str = "",
) -> None:
    """A board over its base query, with the same filter, order and cut in SQL."""
    def build(w: Warehouse) -> DataFrame:
        return step(base(w)) if step else base(w)

    add(key, on(build), _slice(kinds, names), f"SELECT * FROM ({sql}) {tail}")


_BATTING_KINDS = f"{BATTING_SPEC} {_WITH_TEAM}"
_PITCHING_KINDS = f"{PITCHING_SPEC} {_WITH_TEAM} role:s"
_CONTACT_KINDS = f"{LEADERS_SPEC} {_WITH_TEAM}"

board("Q9_batting_leaders", _batting_base, None, _BATTING_BASE_SQL, _BATTING_KINDS,
      """player_id full_name position_name season games_played plate_appearances
      batting_average on_base_percentage slugging_percentage on_base_plus_slugging woba iso
      babip walk_pct strikeout_pct home_runs rbi stolen_bases hits runs doubles triples xba
      xwoba barrel_pct hard_hit_pct avg_exit_velocity current_team_name""")  # fmt: skip
board("Q10_hr_leaders", _batting_base, boards.hr_leaders, _BATTING_BASE_SQL, _BATTING_KINDS,
      """full_name position_name home_runs rbi on_base_plus_slugging iso barrel_pct
      avg_exit_velocity""",
      "WHERE home_runs > 0 ORDER BY home_runs DESC, player_id LIMIT 20")
board("Q11_woba_leaders", _batting_base, boards.woba_leaders, _BATTING_BASE_SQL, _BATTING_KINDS,
      """full_name position_name current_team_name plate_appearances woba
      on_base_plus_slugging xwoba batting_average iso walk_pct strikeout_pct""",
      "WHERE woba IS NOT NULL ORDER BY woba DESC, player_id LIMIT 20")
board("Q12_sb_leaders", _batting_base, boards.sb_leaders, _BATTING_BASE_SQL, _BATTING_KINDS,
      "full_name stolen_bases games_played batting_average on_base_percentage",
      "WHERE stolen_bases > 0 ORDER BY stolen_bases DESC, player_id LIMIT 15")
board("Q13_avg_leaders", _batting_base, boards.avg_leaders, _BATTING_BASE_SQL, _BATTING_KINDS,
      """full_name position_name current_team_name plate_appearances batting_average
      on_base_percentage slugging_percentage babip hits doubles triples""",
      "WHERE batting_average IS NOT NULL ORDER BY batting_average DESC, player_id LIMIT 20",
)
board("Q16_pitching_leaders", _pitching_base, None, _PITCHING_BASE_SQL, _PITCHING_KINDS,
      """player_id full_name position_name pitch_hand season wins losses win_pct era whip fip
      innings_pitched strikeouts walks strikeout_pct walk_pct strikeout_walk_ratio
      strikeouts_per_9 walks_per_9 hits_per_9 batting_average_against games games_started saves
      holds barrel_pct_against hard_hit_pct_against avg_exit_velocity_against xwoba_against
      current_team_name role""")  # fmt: skip
board("Q17_k_leaders", _pitching_base, boards.k_leaders, _PITCHING_BASE_SQL, _PITCHING_KINDS,
      "full_name role strikeouts innings_pitched strikeouts_per_9 strikeout_pct era",
      "ORDER BY strikeouts DESC NULLS LAST, player_id LIMIT 20")
board("Q18_fip_leaders", _pitching_base, boards.fip_leaders, _PITCHING_BASE_SQL,
      _PITCHING_KINDS,
      """full_name current_team_name role fip era whip innings_pitched strikeouts walks
      strikeout_walk_ratio""",
      "WHERE fip IS NOT NULL ORDER BY fip, player_id LIMIT 20")
board("Q19_whip_leaders", _pitching_base, boards.whip_leaders, _PITCHING_BASE_SQL,
      _PITCHING_KINDS,
      "full_name current_team_name role whip era fip innings_pitched hits_per_9 walks_per_9",
      "WHERE whip IS NOT NULL ORDER BY whip, player_id LIMIT 20")
board("Q20_save_leaders", _pitching_base, boards.save_leaders, _PITCHING_BASE_SQL,
      _PITCHING_KINDS,
      "full_name current_team_name saves holds era whip innings_pitched strikeouts",
      "WHERE saves > 0 ORDER BY saves DESC, player_id LIMIT 15")
_STANDINGS_NAMES = """team_id team_full_name team_abbreviation league_name division_name wins
    losses win_pct games_behind run_differential runs_scored runs_allowed home_wins home_losses
    away_wins away_losses team_batting_average team_ops team_era team_whip team_home_runs
    team_stolen_bases team_pitching_strikeouts team_saves pythagorean_win_pct pythagorean_wins
    season"""
board("Q22_standings", _standings_base, None, _STANDINGS_BASE_SQL, TEAM_SEASON_SPEC,
      _STANDINGS_NAMES)
for _i, (_page, _division) in enumerate(boards.DIVISION_PAGES.items(), start=23):
    board(f"Q{_i}_{_page}", _standings_base,
          lambda s, d=_division: boards.division_standings(s, d), _STANDINGS_BASE_SQL,
          TEAM_SEASON_SPEC, _STANDINGS_NAMES,
          f"WHERE division_name = '{_division}'")
board("Q29_team_comparison", _standings_base, boards.team_comparison, _STANDINGS_BASE_SQL,
      TEAM_SEASON_SPEC,
      """team_abbreviation team_full_name team_ops team_era team_batting_average team_whip
      team_home_runs team_stolen_bases team_pitching_strikeouts win_pct
      division_name""")  # fmt: skip
add("Q30_pyth_comparison", on(lambda w: boards.pythagorean_comparison(_standings_base(w))),
    """team_abbreviation:s team_full_name:s actual_wins:i pythagorean_wins:d0 luck_factor:d0
    division_name:s""",
    f"""SELECT *, wins AS actual_wins, wins - pythagorean_wins AS luck_factor
    FROM ({_STANDINGS_BASE_SQL})""")  # fmt: skip
board("Q32_statcast_data", _contact_base, None, _CONTACT_BASE_SQL, _CONTACT_KINDS,
      """player_id full_name position_name player_role total_batted_balls barrel_pct
      hard_hit_pct avg_exit_velocity max_exit_velocity xba xwoba exit_velo_rank
      barrel_pct_rank hard_hit_pct_rank xwoba_rank current_team_name""")  # fmt: skip
board("Q33_ev_leaders", _contact_base, boards.ev_leaders, _CONTACT_BASE_SQL, _CONTACT_KINDS,
      """full_name position_name current_team_name avg_exit_velocity max_exit_velocity
      barrel_pct hard_hit_pct total_batted_balls exit_velo_rank""",
      "ORDER BY avg_exit_velocity DESC NULLS LAST, player_id LIMIT 20")
board("Q34_barrel_leaders", _contact_base, boards.barrel_leaders, _CONTACT_BASE_SQL,
      _CONTACT_KINDS,
      """full_name position_name current_team_name barrel_pct hard_hit_pct avg_exit_velocity
      xwoba total_batted_balls barrel_pct_rank""",
      "ORDER BY barrel_pct DESC NULLS LAST, player_id LIMIT 20")
board("Q35_hh_leaders", _contact_base, boards.hard_hit_leaders, _CONTACT_BASE_SQL,
      _CONTACT_KINDS,
      """full_name position_name current_team_name hard_hit_pct barrel_pct avg_exit_velocity
      xwoba total_batted_balls hard_hit_pct_rank""",
      "ORDER BY hard_hit_pct DESC NULLS LAST, player_id LIMIT 20")
board("Q36_xwoba_leaders", _contact_base, boards.xwoba_leaders, _CONTACT_BASE_SQL,
      _CONTACT_KINDS,
      """full_name position_name current_team_name xwoba xba barrel_pct hard_hit_pct
      avg_exit_velocity total_batted_balls xwoba_rank""",
      "WHERE xwoba IS NOT NULL ORDER BY xwoba DESC, player_id LIMIT 20")
add("Q37_player_info", on(lambda w: boards.player_info(w.dim_players, PLAYER)),
    _slice(DIM_PLAYER_SPEC, """player_id full_name first_name last_name jersey_number birth_date
    birth_city birth_country height weight position_code position_name position_type bat_side
    pitch_hand current_team_name current_team_abbreviation mlb_debut_date""") + " status:s",
    f"""SELECT *, {PLAYER_NAMES}, CASE WHEN active THEN 'Active' ELSE 'Inactive' END AS status
    FROM players WHERE player_id = {PLAYER}""")  # fmt: skip
add("Q38_player_batting", on(lambda w: boards.player_history(
        w.fct_batting_performance, boards.BATTING_HEADINGS, PLAYER)),
    BOX_SPEC, f"SELECT {BOX_SELECT} FROM batting WHERE player_id = {PLAYER}")
_PITCH_BOX_SPEC, _PITCH_BOX = _headings(boards.PITCHING_HEADINGS, PITCHING_SPEC)
add("Q39_player_pitching", on(lambda w: boards.player_history(
        w.fct_pitching_performance, boards.PITCHING_HEADINGS, PLAYER)),
    _PITCH_BOX_SPEC, f"SELECT {_PITCH_BOX} FROM pitching WHERE player_id = {PLAYER}")
_CONTACT_BOX_SPEC, _CONTACT_BOX = _headings(boards.CONTACT_HEADINGS, LEADERS_SPEC)
add("Q40_player_contact", on(lambda w: boards.player_history(
        w.fct_statcast_leaders, boards.CONTACT_HEADINGS, PLAYER)),
    _CONTACT_BOX_SPEC,
    f"SELECT {_CONTACT_BOX} FROM leaders WHERE player_id = {PLAYER}")


def queries() -> dict[str, Build]:
    return {name: entry.build for name, entry in ENTRIES.items()}


@lru_cache(maxsize=1)
def oracle_sql() -> dict[str, str]:
    return {
        name: oracle.statement(entry.sql, entry.spec)
        for name, entry in ENTRIES.items()
        if entry.sql is not None
    }
