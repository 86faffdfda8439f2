"""The same results in SQL for a second engine.

Decimals are kept as scaled whole numbers (tenths, thousandths) and every rounding is integer
arithmetic, so nothing here depends on how an engine divides decimals.
"""

from __future__ import annotations

import re

from harness.adapter import DIVISIONS


def rounded(num: str, den: str, places: int, guard: str | None = None) -> str:
    """``num / den`` to ``places`` places, half away from zero, times ``10**places``."""
    n, d = f"CAST(({num}) AS HUGEINT)", f"CAST(({den}) AS HUGEINT)"
    half_up = f"((2 * abs({n}) * {10**places} + {d}) // (2 * {d}))"
    return (
        f"CASE WHEN ({guard or den}) > 0 THEN CASE WHEN ({num}) < 0 THEN -1 ELSE 1 END"
        f" * {half_up} END"
    )


def _sums(*columns: str) -> str:
    return ", ".join(f"sum({c}) AS {c}" for c in columns)


_DIVISION_CASE = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(DIVISIONS))

_OBP_NUM = "hits + walks + hit_by_pitch"
_OBP_DEN = "at_bats + walks + hit_by_pitch + sacrifice_flies"
_WOBA_NUM = (
    "690 * walks + 720 * hit_by_pitch + 888 * singles + 1271 * doubles + 1616 * triples"
    " + 2101 * home_runs"
)
_FIP_NUM = "10 * (13 * home_runs_allowed + 3 * walks - 2 * strikeouts) * 100 + 320 * innings_pitched"
_FACED_10 = "innings_pitched * 3 + 10 * (hits_allowed + walks + hit_batsmen)"


def _contact(role: str) -> str:
    n = "count(*)"
    return f"""
    SELECT {role} AS player_id, game_year AS season, '{role}' AS player_role,
      {n} AS total_batted_balls,
      count(*) FILTER (launch_speed >= 980 AND launch_angle >= 260 AND launch_angle <= 300)
        AS barrels,
      count(*) FILTER (launch_speed >= 950) AS hard_hits,
      max(launch_speed) AS max_exit_velocity,
      {rounded("sum(launch_speed)", n, 0)} AS avg_exit_velocity,
      {rounded("sum(launch_angle)", "count(launch_angle)", 0)} AS avg_launch_angle,
      {rounded("sum(xba)", "count(xba)", 0)} AS avg_expected_batting_avg,
      {rounded("sum(xwoba)", "count(xwoba)", 0)} AS avg_expected_woba
    FROM raw_statcast WHERE events IS NOT NULL AND launch_speed IS NOT NULL
    GROUP BY ALL"""


def _leader_rank(metric: str, alias: str) -> str:
    up = f"CASE WHEN player_role = 'pitcher' THEN {metric} ELSE -{metric} END"
    return (
        f"rank() OVER (PARTITION BY player_role, season ORDER BY {up} ASC NULLS LAST) AS {alias}"
    )


_LINES = """SELECT *, CAST(l_quantity AS INTEGER) AS q, l_linenumber AS n,
      year(l_shipdate) AS season, CASE WHEN l_linenumber = 7 THEN 'P' ELSE 'R' END AS game_type
    FROM lineitem"""

# Named parts; each may use the ones it names.
PARTS = {
    "raw_teams": f"""
    SELECT s_suppkey AS team_id, s_name AS name, 'c' || s_suppkey AS team_code,
      'T' || s_suppkey AS abbreviation, 'Team ' || s_suppkey AS team_name,
      'NATION_' || s_nationkey AS location_name, 103 + s_nationkey % 6 // 3 AS league_id,
      CASE WHEN s_nationkey % 6 < 3 THEN 'American League' ELSE 'National League' END
        AS league_name,
      CASE WHEN s_nationkey <> 24 THEN 200 + s_nationkey % 6 END AS division_id,
      CASE WHEN s_nationkey <> 24 THEN CASE s_nationkey % 6 {_DIVISION_CASE} END END
        AS division_name,
      s_suppkey AS venue_id, 'Park ' || s_suppkey AS venue_name, 1 AS sport_id, s_acctbal >= 0 AS active,
      CASE WHEN s_suppkey % 50 = 7 THEN 'n/a'
        ELSE CAST(1900 + s_suppkey % 100 AS VARCHAR) END AS first_year_of_play
    FROM supplier""",
    "raw_players": """
    SELECT c_custkey AS player_id, c_name AS full_name, split_part(c_name, '#', 1) AS first_name,
      split_part(c_name, '#', 2) AS last_name, CAST(c_custkey % 100 AS VARCHAR) AS primary_number,
      CAST(DATE '1970-01-01' + CAST(c_custkey % 9000 AS INTEGER) AS DATE) AS birth_date,
      'City ' || c_nationkey AS birth_city, 'NATION_' || c_nationkey AS birth_country,
      (60 + c_custkey % 20) || 'in' AS height, 150 + c_custkey % 100 AS weight,
      CAST(c_custkey % 10 AS VARCHAR) AS primary_position_code,
      CASE WHEN c_custkey % 29 <> 0 THEN c_mktsegment END AS primary_position_name,
      CASE c_custkey % 3 WHEN 0 THEN 'Pitcher' WHEN 1 THEN 'Infielder' ELSE 'Outfielder' END
        AS primary_position_type,
      CASE c_custkey % 3 WHEN 0 THEN 'R' WHEN 1 THEN 'L' ELSE 'S' END AS bat_side,
      CASE c_custkey % 2 WHEN 0 THEN 'R' ELSE 'L' END AS pitch_hand,
      CASE WHEN c_custkey % 17 <> 0 THEN c_custkey // 15 END AS current_team_id,
      CAST(DATE '1970-01-01' + CAST(c_custkey % 9000 + 8000 AS INTEGER) AS DATE) AS mlb_debut_date,
      c_acctbal >= 0 AS active
    FROM customer""",
    "fixture": """
    SELECT *, CASE WHEN away_guess = home_team_id
        THEN home_team_id + CASE WHEN home_team_id % 2 = 0 THEN 1 ELSE -1 END
        ELSE away_guess END AS away_team_id
    FROM (SELECT o_orderkey AS game_pk, CAST(floor(o_totalprice) AS BIGINT) AS price,
        o_custkey AS custkey,
        CASE WHEN o_orderpriority = '1-URGENT' THEN 'P' ELSE 'R' END AS game_type,
        year(o_orderdate) AS season, CAST(o_orderdate AS DATE) AS game_date,
        o_orderdate AS game_datetime,
        o_orderstatus AS status_code,
        CASE o_orderstatus WHEN 'F' THEN 'Final' WHEN 'P' THEN 'Completed Early'
          ELSE 'Scheduled' END AS status_detail,
        o_custkey // 15 AS home_team_id, o_orderkey // 150 AS away_guess,
        CASE WHEN o_orderkey % 2 = 0 THEN 'day' ELSE 'night' END AS day_night,
        'Series ' || (o_orderkey % 3) AS series_description,
        1 + o_orderkey % 4 AS series_game_number,
        CASE WHEN o_orderkey % 20 = 0 THEN 'Y' ELSE 'N' END AS double_header
      FROM orders)""",
    "raw_games": """
    SELECT *, CASE WHEN status_code <> 'O' AND game_pk % 97 <> 0 THEN price % 13 END AS home_score,
      CASE WHEN status_code <> 'O' AND game_pk % 97 <> 0 THEN price // 13 % 13 END AS away_score,
      game_pk % 90 AS home_wins, game_pk % 70 AS home_losses, price % 90 AS away_wins,
      price % 70 AS away_losses, home_team_id AS venue_id, 'Park ' || home_team_id AS venue_name,
      custkey AS winning_pitcher_id, game_pk // 10 AS losing_pitcher_id,
      CASE WHEN game_pk % 3 = 0 THEN custkey // 2 END AS save_pitcher_id,
      CASE WHEN status_code = 'O' THEN NULL WHEN game_pk % 5 = 0 THEN 9 + game_pk % 4 ELSE 9 END
        AS innings
    FROM fixture""",
    "raw_schedule": """
    SELECT *, game_pk AS id, 'Team ' || home_team_id AS home_team_name,
      'Team ' || away_team_id AS away_team_name, home_team_id AS venue_id,
      'Park ' || home_team_id AS venue_name, 4 AS games_in_series,
      CASE WHEN double_header = 'Y' THEN 7 ELSE 9 END AS scheduled_innings
    FROM fixture""",
    "raw_batting_stats": f"""
    SELECT *, {rounded("hits", "at_bats", 3)} AS batting_average,
      {rounded(_OBP_NUM, _OBP_DEN, 3)} AS obp, {rounded("total_bases", "at_bats", 3)} AS slg
    FROM (SELECT *, 103 + team_id % 2 AS league_id, {_OBP_DEN} AS plate_appearances,
        hits + doubles + 2 * coalesce(triples, 0) + 3 * home_runs AS total_bases
      FROM (SELECT l_partkey AS player_id, season, l_suppkey AS team_id, game_type,
          count(*) AS games_played, sum(q - 1) AS at_bats, sum(q // 6) AS runs,
          sum(q // 4) AS hits, sum(q // 20) AS doubles,
          sum(q // 40) FILTER (l_returnflag <> 'N') AS triples, sum(q // 16) AS home_runs,
          sum(q // 3) AS rbi, sum(q % 3) AS stolen_bases, sum(q % 7 // 6) AS caught_stealing,
          sum(n) AS walks, sum(q // 5) AS strikeouts, sum(q % 11 // 10) AS ground_into_dp,
          sum(l_orderkey % 2) AS hit_by_pitch, sum(l_orderkey % 5 // 4) AS sacrifice_bunts,
          sum(l_orderkey % 3) AS sacrifice_flies, sum(n // 6) AS intentional_walks
        FROM ({_LINES}) GROUP BY ALL))""",
    "raw_pitching_stats": f"""
    SELECT *, 103 + team_id % 2 AS league_id,
      {rounded("90 * earned_runs", "innings_pitched", 2)} AS era,
      {rounded("10 * (walks + hits_allowed)", "innings_pitched", 2)} AS whip,
      {rounded("10 * hits_allowed", "innings_pitched * 3 + 10 * hits_allowed", 3,
               "innings_pitched")} AS batting_average_against,
      {rounded("strikeouts", "walks", 2)} AS strikeout_walk_ratio,
      {rounded("90 * strikeouts", "innings_pitched", 2)} AS strikeouts_per_9,
      {rounded("90 * walks", "innings_pitched", 2)} AS walks_per_9,
      {rounded("90 * hits_allowed", "innings_pitched", 2)} AS hits_per_9
    FROM (SELECT l_orderkey // 10 AS player_id, season, l_suppkey AS team_id, game_type,
        sum(q % 2) AS wins, sum((q + 1) % 2 * (n % 2)) AS losses, count(*) AS games,
        sum(n % 2) AS games_started, sum(n % 3 // 2) AS games_finished,
        sum(q // 48) AS complete_games, sum(q // 50) AS shutouts, sum(q // 44) AS saves,
        sum(q // 40) AS save_opportunities, sum(q % 9 // 8) AS holds,
        sum(q % 13 // 12) AS blown_saves,
        sum((q - 1) // 3 * 10 + (q - 1) % 3) AS innings_pitched, sum(q // 4) AS hits_allowed,
        sum(q % 5 + q % 2) AS runs_allowed, sum(q % 5) AS earned_runs,
        sum(q // 25) AS home_runs_allowed, sum(n - 1) AS walks, sum(q // 5) AS strikeouts,
        sum(l_partkey % 2) AS hit_batsmen, sum(l_partkey % 3) AS wild_pitches,
        sum(l_partkey % 7 // 6) AS balks
      FROM ({_LINES}) GROUP BY ALL)""",
    "raw_statcast": f"""
    SELECT l_orderkey AS game_pk, CAST(l_shipdate AS DATE) AS game_date, season AS game_year,
      l_suppkey AS batter, l_partkey // 20 * 16 AS pitcher, 'B' || l_suppkey AS batter_name,
      CASE WHEN n = 7 THEN NULL WHEN l_returnflag = 'N' THEN 'strikeout'
        WHEN l_linestatus = 'F' THEN 'single' ELSE 'field_out' END AS events,
      CASE WHEN l_returnflag <> 'N' THEN 'hit_into_play' ELSE 'swinging_strike' END AS description,
      1 + q % 14 AS zone, CASE l_partkey % 2 WHEN 0 THEN 'R' ELSE 'L' END AS stand,
      CASE l_partkey % 3 WHEN 0 THEN 'L' ELSE 'R' END AS p_throws, 'T' || l_suppkey AS home_team,
      'T' || (l_suppkey + 1) AS away_team,
      CASE l_returnflag WHEN 'N' THEN 'B' WHEN 'A' THEN 'S' ELSE 'X' END AS type,
      CASE q % 3 WHEN 0 THEN 'FF' WHEN 1 THEN 'SL' ELSE 'CH' END AS pitch_type,
      CASE WHEN l_partkey % 19 <> 0 THEN 350 + l_partkey % 800 END AS release_speed,
      2000 + l_partkey % 500 AS release_spin_rate, q - 25 AS pfx_x,
      CASE WHEN l_returnflag <> 'N' THEN 600 + 10 * q + n END AS launch_speed,
      CASE WHEN l_orderkey % 11 <> 0 THEN l_partkey % 800 - 200 END AS launch_angle,
      CASE WHEN l_returnflag <> 'N' THEN 8 * q END AS hit_distance_sc,
      CASE WHEN n % 3 <> 0 THEN l_orderkey % 1000 END AS xba,
      CASE WHEN n % 3 <> 0 THEN l_orderkey % 1000 * 2 END AS xwoba,
      n AS at_bat_number, 1 + l_partkey % 6 AS pitch_number, 1 + q % 9 AS inning,
      q % 4 AS balls, q % 3 AS strikes, l_linenumber, l_partkey, l_suppkey, l_orderkey
    FROM ({_LINES})""",
    "game_results": """
    SELECT game_pk, game_type, season, game_date, true AS is_home, home_team_id AS team_id,
      away_team_id AS opponent_id, home_score AS runs_scored, away_score AS runs_allowed,
      home_score > away_score AS is_win, home_score < away_score AS is_loss, venue_id, venue_name,
      winning_pitcher_id, losing_pitcher_id, save_pitcher_id, innings, day_night,
      series_description, series_game_number, double_header
    FROM raw_games
    WHERE status_code = 'F' AND home_score IS NOT NULL AND away_score IS NOT NULL
    UNION ALL
    SELECT game_pk, game_type, season, game_date, false, away_team_id, home_team_id, away_score,
      home_score, away_score > home_score, away_score < home_score, venue_id, venue_name,
      winning_pitcher_id, losing_pitcher_id, save_pitcher_id, innings, day_night,
      series_description, series_game_number, double_header
    FROM raw_games
    WHERE status_code = 'F' AND home_score IS NOT NULL AND away_score IS NOT NULL""",
    "season_batting": f"""
    SELECT *, {rounded("hits", "at_bats", 3)} AS batting_average,
      {rounded(_OBP_NUM, _OBP_DEN, 3)} AS on_base_percentage,
      {rounded("total_bases", "at_bats", 3)} AS slugging_percentage,
      {rounded(f"({_OBP_NUM}) * at_bats + total_bases * ({_OBP_DEN})", f"at_bats * ({_OBP_DEN})",
               3)} AS on_base_plus_slugging,
      {rounded(_WOBA_NUM, f"1000 * ({_OBP_DEN})", 3)} AS woba
    FROM (SELECT *, hits - doubles - triples - home_runs AS singles
      FROM (SELECT player_id, season, {_sums(
          "games_played", "plate_appearances", "at_bats", "runs", "hits", "doubles", "triples",
          "home_runs", "rbi", "stolen_bases", "caught_stealing", "walks", "strikeouts",
          "hit_by_pitch", "sacrifice_bunts", "sacrifice_flies", "intentional_walks",
          "total_bases")}, sum(ground_into_dp) AS ground_into_double_play
        FROM raw_batting_stats WHERE game_type = 'R' GROUP BY player_id, season))""",
    "season_pitching": f"""
    SELECT *, {rounded("90 * earned_runs", "innings_pitched", 2)} AS era,
      {rounded("10 * (walks + hits_allowed)", "innings_pitched", 2)} AS whip,
      {rounded("strikeouts", "walks", 2)} AS strikeout_walk_ratio,
      {rounded("90 * strikeouts", "innings_pitched", 2)} AS strikeouts_per_9,
      {rounded("90 * walks", "innings_pitched", 2)} AS walks_per_9,
      {rounded("90 * hits_allowed", "innings_pitched", 2)} AS hits_per_9,
      {rounded("10 * hits_allowed", "innings_pitched * 3 + 10 * hits_allowed", 3,
               "innings_pitched")} AS batting_average_against,
      {rounded(_FIP_NUM, "100 * innings_pitched", 2)} AS fip
    FROM (SELECT player_id, season, {_sums(
        "wins", "losses", "games", "games_started", "games_finished", "complete_games",
        "shutouts", "saves", "save_opportunities", "holds", "blown_saves", "innings_pitched",
        "hits_allowed", "runs_allowed", "earned_runs", "home_runs_allowed", "walks",
        "strikeouts", "hit_batsmen", "wild_pitches", "balks")}
      FROM raw_pitching_stats WHERE game_type = 'R' GROUP BY player_id, season)""",
    "contact": f"""
    SELECT *, {rounded("barrels", "total_batted_balls", 3)} AS barrel_pct,
      {rounded("hard_hits", "total_batted_balls", 3)} AS hard_hit_pct
    FROM ({_contact("batter")} UNION ALL BY NAME {_contact("pitcher")})""",
    "standings": f"""
    SELECT s.*, CASE WHEN best.top IS NOT NULL THEN
        {rounded("best.top * s.games_played - 1000 * s.wins", "1000", 1)} END AS games_behind
    FROM records AS s LEFT JOIN (SELECT season, division_name, max(win_pct) AS top FROM records
        WHERE division_name IS NOT NULL GROUP BY season, division_name) AS best
      ON s.season = best.season AND s.division_name = best.division_name""",
    "records": f"""
    SELECT r.*, runs_scored - runs_allowed AS run_differential,
      {rounded("wins", "games_played", 3)} AS win_pct, t.name AS team_full_name,
      t.abbreviation AS team_abbreviation, t.league_name, t.division_name
    FROM (SELECT team_id, season, count(*) AS games_played,
        count(*) FILTER (is_win) AS wins, count(*) FILTER (is_loss) AS losses,
        sum(runs_scored) AS runs_scored, sum(runs_allowed) AS runs_allowed,
        count(*) FILTER (is_home AND is_win) AS home_wins,
        count(*) FILTER (is_home AND is_loss) AS home_losses,
        count(*) FILTER (is_win AND NOT is_home) AS away_wins,
        count(*) FILTER (is_loss AND NOT is_home) AS away_losses
      FROM game_results WHERE game_type = 'R' GROUP BY team_id, season) AS r
      JOIN raw_teams AS t USING (team_id)""",
    "players": """
    SELECT p.*, t.name AS current_team_name, t.abbreviation AS current_team_abbreviation
    FROM raw_players AS p LEFT JOIN raw_teams AS t ON t.team_id = p.current_team_id""",
    "batting": f"""
    SELECT b.*, p.full_name, p.primary_position_name AS position_name,
      p.primary_position_type AS position_type, p.bat_side, c.barrel_pct, c.hard_hit_pct,
      c.avg_exit_velocity, c.avg_launch_angle, c.max_exit_velocity,
      c.avg_expected_batting_avg AS xba, c.avg_expected_woba AS xwoba,
      CASE WHEN at_bats > 0 THEN slugging_percentage - batting_average END AS iso,
      {rounded("walks", "plate_appearances", 3)} AS walk_pct,
      {rounded("strikeouts", "plate_appearances", 3)} AS strikeout_pct,
      {rounded("hits - home_runs", "at_bats - strikeouts - home_runs + sacrifice_flies", 3)}
        AS babip
    FROM season_batting AS b JOIN raw_players AS p ON p.player_id = b.player_id
      LEFT JOIN contact AS c ON c.player_role = 'batter' AND c.player_id = b.player_id
        AND c.season = b.season""",
    "pitching": f"""
    SELECT b.*, p.full_name, p.primary_position_name AS position_name, p.pitch_hand,
      {rounded("wins", "wins + losses", 3)} AS win_pct,
      {rounded("10 * strikeouts", _FACED_10, 3, "innings_pitched")} AS strikeout_pct,
      {rounded("10 * walks", _FACED_10, 3, "innings_pitched")} AS walk_pct,
      c.barrel_pct AS barrel_pct_against, c.hard_hit_pct AS hard_hit_pct_against,
      c.avg_exit_velocity AS avg_exit_velocity_against, c.avg_expected_woba AS xwoba_against,
      CASE WHEN 2 * games_started > games THEN 'Starter' ELSE 'Reliever' END AS role
    FROM season_pitching AS b JOIN raw_players AS p ON p.player_id = b.player_id
      LEFT JOIN contact AS c ON c.player_role = 'pitcher' AND c.player_id = b.player_id
        AND c.season = b.season""",
    "summary": """
    SELECT g.*, h.name AS home_team_name, h.abbreviation AS home_team_abbreviation,
      a.name AS away_team_name, a.abbreviation AS away_team_abbreviation,
      abs(home_score - away_score) AS run_margin,
      CASE WHEN home_score > away_score THEN 'home' ELSE 'away' END AS winner,
      CASE WHEN home_score > away_score THEN home_team_id ELSE away_team_id END
        AS winning_team_id,
      CASE WHEN home_score > away_score THEN away_team_id ELSE home_team_id END
        AS losing_team_id,
      w.full_name AS winning_pitcher_name, l.full_name AS losing_pitcher_name,
      s.full_name AS save_pitcher_name, coalesce(innings > 9, false) AS is_extra_innings
    FROM raw_games AS g LEFT JOIN raw_teams AS h ON h.team_id = g.home_team_id
      LEFT JOIN raw_teams AS a ON a.team_id = g.away_team_id
      LEFT JOIN raw_players AS w ON w.player_id = g.winning_pitcher_id
      LEFT JOIN raw_players AS l ON l.player_id = g.losing_pitcher_id
      LEFT JOIN raw_players AS s ON s.player_id = g.save_pitcher_id
    WHERE g.status_code = 'F'""",
    "leaders": f"""
    SELECT c.*, p.full_name, p.primary_position_name AS position_name,
      avg_expected_batting_avg AS xba, avg_expected_woba AS xwoba,
      {_leader_rank("avg_exit_velocity", "exit_velo_rank")},
      {_leader_rank("barrel_pct", "barrel_pct_rank")},
      {_leader_rank("hard_hit_pct", "hard_hit_pct_rank")},
      {_leader_rank("avg_expected_woba", "xwoba_rank")}
    FROM contact AS c JOIN raw_players AS p USING (player_id) WHERE total_batted_balls >= 50""",
    "team_batting": f"""
    SELECT *, {rounded("hits", "at_bats", 3)} AS team_batting_average,
      {rounded(_OBP_NUM, _OBP_DEN, 3)} AS team_obp,
      {rounded("total_bases", "at_bats", 3)} AS team_slg
    FROM (SELECT team_id, season, {_sums(
        "games_played", "plate_appearances", "at_bats", "hits", "home_runs", "rbi",
        "stolen_bases", "walks", "strikeouts", "hit_by_pitch", "sacrifice_flies",
        "total_bases")}
      FROM raw_batting_stats WHERE game_type = 'R' GROUP BY team_id, season)""",
    "team_pitching": f"""
    SELECT *, {rounded("90 * earned_runs", "innings_pitched", 2)} AS team_era,
      {rounded("10 * (walks + hits_allowed)", "innings_pitched", 2)} AS team_whip
    FROM (SELECT team_id, season, {_sums(
        "innings_pitched", "earned_runs", "strikeouts", "walks", "hits_allowed",
        "home_runs_allowed", "saves")}
      FROM raw_pitching_stats WHERE game_type = 'R' GROUP BY team_id, season)""",
    "team_summary": f"""
    SELECT s.*, b.team_batting_average, b.team_obp, b.team_slg,
      b.team_obp + b.team_slg AS team_ops, b.home_runs AS team_home_runs, b.rbi AS team_rbi,
      b.stolen_bases AS team_stolen_bases, b.walks AS team_batting_walks,
      b.strikeouts AS team_batting_strikeouts, p.team_era, p.team_whip,
      p.strikeouts AS team_pitching_strikeouts, p.walks AS team_pitching_walks,
      p.saves AS team_saves, p.home_runs_allowed AS team_home_runs_allowed,
      CASE WHEN s.runs_allowed > 0 THEN {rounded(
          "s.runs_scored * s.runs_scored",
          "s.runs_scored * s.runs_scored + s.runs_allowed * s.runs_allowed", 3,
          "s.runs_scored")} END AS pythagorean_win_pct,
      CASE WHEN s.runs_allowed > 0 THEN {rounded(
          "s.runs_scored * s.runs_scored * s.games_played",
          "s.runs_scored * s.runs_scored + s.runs_allowed * s.runs_allowed", 0,
          "s.runs_scored")} END AS pythagorean_wins
    FROM standings AS s
      LEFT JOIN team_batting AS b ON b.team_id = s.team_id AND b.season = s.season
      LEFT JOIN team_pitching AS p ON p.team_id = s.team_id AND p.season = s.season""",
}


def _needed(sql: str, found: list[str]) -> list[str]:
    for name, body in PARTS.items():
        if name not in found and re.search(rf"\b(FROM|JOIN) {name}\b", sql):
            _needed(body, found)
            found.append(name)
    return found


# How a column is shown: letter in a registry spec -> SQL type and divisor.
SHOWN = {
    "i": ("BIGINT", 1),
    "s": ("VARCHAR", 1),
    "b": ("BOOLEAN", 1),
    "t": ("DATE", 1),
    "d0": ("DOUBLE", 1),
    "d1": ("DOUBLE", 10),
    "d2": ("DOUBLE", 100),
    "d3": ("DOUBLE", 1000),
}


def columns(spec: str) -> list[tuple[str, str]]:
    """``"season:i era:d2"`` as pairs."""
    return [tuple(item.rsplit(":", 1)) for item in spec.split()]


def statement(body: str, spec: str) -> str:
    """The query with the parts it needs and its columns cast as the spec says."""
    parts = _needed(body, [])
    head = ",\n".join(f"{name} AS ({PARTS[name]})" for name in parts)
    shown = []
    for name, kind in columns(spec):
        sql_type, divisor = SHOWN[kind]
        value = f'CAST("{name}" AS {sql_type})'
        shown.append(f'{value}{f" / {divisor}" if divisor > 1 else ""} AS "{name}"')
    select = f"SELECT {', '.join(shown)} FROM ({body}) AS result"
    return f"WITH {head}\n{select}" if head else select
