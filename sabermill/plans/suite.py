"""The declared checks over a warehouse, grouped by kind.

Checks over the rows of one table share one pass, across kinds where they run together
(``row_checks``, ``every_check``). Lists of allowed values and thresholds are parameters with the
declared defaults.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sabermill.operators import quality as q
from sabermill.plans.warehouse import Warehouse

# The declared checks.
UNIQUE = {
    "stg_teams": "team_id", "stg_players": "player_id", "stg_games": "game_pk",
    "stg_batting_stats": "batting_stats_id", "stg_pitching_stats": "pitching_stats_id",
    "stg_statcast": "statcast_id", "stg_schedule": "schedule_id", "dim_players": "player_id",
    "dim_teams": "team_id", "fct_game_summary": "game_pk",
}
RAW_KEYS = {
    "teams": "team_id", "players": "player_id", "games": "game_pk", "batting_stats": "id",
    "pitching_stats": "id", "statcast": "id", "schedule": "id",
}
NOT_NULL = {
    "stg_teams": "team_id team_full_name team_abbreviation",
    "stg_players": "player_id full_name",
    "stg_games": "game_pk season game_date home_team_id away_team_id",
    "stg_batting_stats": "batting_stats_id player_id season",
    "stg_pitching_stats": "pitching_stats_id player_id season",
    "stg_statcast": "statcast_id game_date batter_id pitcher_id",
    "stg_schedule": "schedule_id game_pk game_date",
    "int_player_season_batting": "player_id season",
    "int_player_season_pitching": "player_id season",
    "int_game_results": "game_pk team_id opponent_id season game_date is_home is_win is_loss",
    "int_team_standings": "team_id season",
    "int_statcast_metrics": "player_id season player_role",
    "dim_players": "player_id full_name",
    "dim_teams": "team_id team_full_name team_abbreviation",
    "fct_batting_performance": "player_id season",
    "fct_pitching_performance": "player_id season",
    "fct_game_summary": "game_pk season game_date",
    "fct_statcast_leaders": "player_id season player_role",
    "fct_team_season_summary": "team_id season",
}
LEAGUES = ["American League", "National League"]
DIVISIONS = ["AL East", "AL Central", "AL West", "NL East", "NL Central", "NL West"]
HANDS = ["R", "L", "S"]
SIDES = ["R", "L"]
GAME_TYPES = ["R", "P", "S", "F", "D", "L", "W", "A", "E"]
DAY_NIGHT = ["day", "night"]
PITCH_RESULTS = ["B", "S", "X"]
ROLES = ["batter", "pitcher"]
ACCEPTED = {
    "stg_teams": {"league_name": LEAGUES, "division_name": DIVISIONS},
    "stg_players": {"bat_side": HANDS, "pitch_hand": HANDS},
    "stg_games": {"game_type": GAME_TYPES, "day_night": DAY_NIGHT},
    "stg_statcast": {
        "batter_side": SIDES, "pitcher_throws": SIDES, "pitch_result_type": PITCH_RESULTS,
    },
    "stg_schedule": {"game_type": GAME_TYPES, "day_night": DAY_NIGHT},
    "int_statcast_metrics": {"player_role": ROLES},
    "fct_statcast_leaders": {"player_role": ROLES},
}
RELATED = [
    ("stg_players", "current_team_id", "stg_teams", "team_id"),
    ("stg_games", "home_team_id", "stg_teams", "team_id"),
    ("stg_games", "away_team_id", "stg_teams", "team_id"),
    ("stg_batting_stats", "player_id", "stg_players", "player_id"),
    ("stg_batting_stats", "team_id", "stg_teams", "team_id"),
    ("stg_pitching_stats", "player_id", "stg_players", "player_id"),
    ("stg_pitching_stats", "team_id", "stg_teams", "team_id"),
    ("stg_schedule", "home_team_id", "stg_teams", "team_id"),
    ("stg_schedule", "away_team_id", "stg_teams", "team_id"),
]
TRACED = [
    ("fct_game_summary", "game_pk", "stg_games", "game_pk"),
    ("fct_batting_performance", "player_id", "dim_players", "player_id"),
    ("fct_pitching_performance", "player_id", "dim_players", "player_id"),
    ("fct_statcast_leaders", "player_id", "dim_players", "player_id"),
    ("fct_team_season_summary", "team_id", "dim_teams", "team_id"),
]
MIN_ROWS = {
    "teams": 30, "players": 100, "games": 100, "schedule": 100, "batting_stats": 100,
    "pitching_stats": 50, "statcast": 1000,
}
FILLED_MARTS = ["fct_batting_performance", "fct_pitching_performance"]
SAME_SIZE = [
    ["raw_teams", "stg_teams", "dim_teams"],
    ["raw_players", "stg_players", "dim_players"],
    ["raw_games", "stg_games"],
]
NULL_SHARES = {
    "batting_stats": {"batting_average": "0.20"},
    "pitching_stats": {"era": "0.20"},
    "statcast": {"release_speed": "0.15", "launch_speed": "0.85"},
}
DISTINCT_KEYS = {
    "dim_teams": "team_id", "dim_players": "player_id", "fct_game_summary": "game_pk",
}


def uniqueness(w: Warehouse) -> DataFrame:
    raw = [q.unique(w.raw[t], f"raw_{t}", c) for t, c in RAW_KEYS.items()]
    return q.together([*raw, *[q.unique(w.model(t), t, c) for t, c in UNIQUE.items()]])


Measures = dict[str, list[q.Measure]]


def _table(w: Warehouse, name: str) -> DataFrame:
    return w.raw[name[4:]] if name.startswith("raw_") else w.model(name)


def _scan(w: Warehouse, *families: Measures) -> DataFrame:
    """One scan for each table, whatever number of families has checks on its rows."""
    by_table: Measures = {}
    for family in families:
        for name, measures in family.items():
            by_table.setdefault(name, []).extend(measures)
    return q.together([q.one_pass(_table(w, n), n, m) for n, m in by_table.items()])


def completeness_measures() -> Measures:
    columns = {f"raw_{t}": c for t, c in RAW_KEYS.items()} | NOT_NULL
    return {
        t: q.rule_measures({("not_null", c): q.missing(c) for c in names.split()})
        for t, names in columns.items()
    }


def completeness(w: Warehouse) -> DataFrame:
    return _scan(w, completeness_measures())


def accepted_measures(divisions: list[str] | None = None) -> Measures:
    def allowed(column: str, values: list[str]) -> list[str]:
        return divisions if divisions and column == "division_name" else values

    return {
        t: q.rule_measures(
            {("accepted_values", c): q.not_in(c, allowed(c, v)) for c, v in columns.items()}
        )
        for t, columns in ACCEPTED.items()
    }


def accepted_values(w: Warehouse, divisions: list[str] | None = None) -> DataFrame:
    return _scan(w, accepted_measures(divisions))


def relationships(w: Warehouse) -> DataFrame:
    return q.together(
        [q.related(w.model(t), t, c, w.model(parent), pc) for t, c, parent, pc in RELATED]
    )


def either_team_missing(w: Warehouse) -> DataFrame:
    return q.related_all(
        w.raw["games"], "raw_games", ["home_team_id", "away_team_id"], w.raw["teams"], "team_id"
    )


def range_measures() -> Measures:
    """Values out of range; NULLs pass, except the scores of a final game."""
    final = F.col("game_status_code") == "F"
    no_score = F.col("home_score").isNull() | F.col("away_score").isNull()
    negative = q.outside("home_score", 0) | q.outside("away_score", 0)
    rules: dict[str, dict[tuple[str, str], Column]] = {
        "stg_batting_stats": {("in_range", "batting_average"): q.outside("batting_average", 0, 1)},
        "stg_pitching_stats": {("in_range", "era"): q.outside("era", 0)},
        "stg_statcast": {
            ("in_range", "release_speed"): q.outside("release_speed", 40, 110),
            ("in_range", "exit_velocity"): q.outside("exit_velocity", 10, 125),
            ("in_range", "release_speed, exit_velocity"): q.outside("release_speed", 40, 110)
            | q.outside("exit_velocity", 10, 125),
        },
        "stg_games": {
            ("scored", "home_score, away_score"): final & no_score,
            ("scored_in_range", "home_score, away_score"): final & (no_score | negative),
        },
        "int_player_season_pitching": {
            ("in_range", "fip"): (F.col("innings_pitched") > 0) & q.outside("fip", -5, 30)
        },
        "fct_batting_performance": {
            ("in_range", c): q.outside(c, 0, 1) for c in ("walk_pct", "strikeout_pct")
        },
    }
    return {t: q.rule_measures(r) for t, r in rules.items()}


def ranges(w: Warehouse) -> DataFrame:
    return _scan(w, range_measures())


def tolerance_measures() -> Measures:
    """Columns that must agree with each other."""
    ops = F.col("on_base_plus_slugging")
    parts = F.col("on_base_percentage") + F.col("slugging_percentage")
    rules = {
        "int_player_season_batting": {
            ("ops_near_sum", "on_base_plus_slugging"): F.abs(ops - parts)
            > F.lit("0.005").cast("decimal(4,3)")
        },
        "fct_team_season_summary": {
            ("expected_wins_near_wins", "pythagorean_wins"): F.abs(
                F.col("pythagorean_wins") - F.col("wins")
            )
            > 15
        },
        "int_team_standings": {
            ("wins_and_losses_make_games", "games_played"): F.col("wins") + F.col("losses")
            != F.col("games_played")
        },
    }
    return {t: q.rule_measures(r) for t, r in rules.items()}


def tolerances(w: Warehouse) -> DataFrame:
    return _scan(w, tolerance_measures())


def game_consistency(w: Warehouse) -> DataFrame:
    """Every game has two sides, one of which won and the other lost."""
    rows, won, lost = F.col("rows"), F.col("won"), F.col("lost")
    return q.groups_break(
        w.int_game_results,
        "int_game_results",
        "game_pk",
        {
            "rows": F.count(F.lit(1)),
            "won": F.count_if("is_win"),
            "lost": F.count_if("is_loss"),
        },
        {
            "two_rows_one_winner_one_loser": (rows != 2) | (won != 1) | (lost != 1),
            "two_rows": rows != 2,
            "one_winner": won != 1,
        },
    )


def size_measures() -> Measures:
    least = {f"raw_{t}": n for t, n in MIN_ROWS.items()} | dict.fromkeys(FILLED_MARTS, 1)
    return {t: q.size_measures(n) for t, n in least.items()}


def minimum_rows(w: Warehouse) -> DataFrame:
    return _scan(w, size_measures())


def layer_sizes(w: Warehouse) -> DataFrame:
    return q.together([q.same_size({n: _table(w, n) for n in names}) for names in SAME_SIZE])


def share_measures() -> Measures:
    return {f"raw_{t}": q.share_measures(c) for t, c in NULL_SHARES.items()}


def null_shares(w: Warehouse) -> DataFrame:
    return _scan(w, share_measures())


def distinct_keys(w: Warehouse) -> DataFrame:
    return q.together([q.distinct_key(w.model(t), t, c) for t, c in DISTINCT_KEYS.items()])


def traceability(w: Warehouse) -> DataFrame:
    return q.together(
        [
            q.related(w.model(t), t, c, w.model(parent), pc, check="traced")
            for t, c, parent, pc in TRACED
        ]
    )


def row_checks(w: Warehouse) -> DataFrame:
    """All checks over single rows, null shares and sizes: every table is scanned once."""
    return _scan(
        w,
        completeness_measures(),
        accepted_measures(),
        range_measures(),
        tolerance_measures(),
        size_measures(),
        share_measures(),
    )


ALL = [
    row_checks, uniqueness, relationships, either_team_missing, game_consistency, layer_sizes,
    distinct_keys, traceability,
]


def every_check(w: Warehouse) -> DataFrame:
    return q.together([kind(w) for kind in ALL])
