"""Hand-worked rows for every rate."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from sabermill.functions import batting, contact, pitching, rates, team
from sabermill.plans import intermediate, marts


def one(spark, values, column):
    schema = ", ".join(f"{k} {v[0]}" for k, v in values.items())
    df = spark.createDataFrame([tuple(v[1] for v in values.values())], schema)
    return df.select(column.alias("x")).first().x


def line(**counts):
    base = dict.fromkeys(
        """hits walks hit_by_pitch at_bats sacrifice_flies total_bases singles doubles triples
        home_runs strikeouts plate_appearances""".split(), 0
    )
    return {k: ("bigint", v) for k, v in {**base, **counts}.items()}


FULL = line(
    at_bats=500, hits=150, doubles=30, triples=5, home_runs=20, singles=95, walks=60,
    hit_by_pitch=5, sacrifice_flies=4, total_bases=250, strikeouts=100, plate_appearances=575,
)


@pytest.mark.parametrize(
    "make, expected",
    [
        (batting.batting_average, "0.300"),
        (batting.on_base_percentage, "0.378"),  # 215 / 569
        (batting.slugging_percentage, "0.500"),
        (batting.on_base_plus_slugging, "0.878"),
        (batting.woba, "0.382"),  # 217.335 / 569
        (batting.babip, "0.339"),  # 130 / 384
        (lambda: batting.per_plate_appearance("walks"), "0.104"),
    ],
)
def test_batting(spark, make, expected):
    assert one(spark, FULL, make()) == D(expected)
    assert one(spark, line(), make()) is None


def test_ops_rounds_once_but_iso_rounds_twice(spark):
    # OBP 1/3 + SLG 1/3: .333 + .333 would be .666
    assert one(spark, line(at_bats=3, hits=1, total_bases=1), batting.on_base_plus_slugging()) == D(
        "0.667"
    )
    values = {
        "at_bats": ("bigint", 9),
        "slugging_percentage": ("decimal(5,3)", D("0.556")),
        "batting_average": ("decimal(5,3)", D("0.222")),
    }
    assert one(spark, values, batting.isolated_power()) == D("0.334")  # 3/9 is .333


def test_null_counts_make_null_rates(spark):
    values = {**FULL, "triples": ("bigint", None), "singles": ("bigint", None)}
    assert one(spark, values, batting.woba()) is None
    assert one(spark, values, batting.batting_average()) == D("0.300")


def test_halves_round_away_from_zero(spark):
    half = {"n": ("bigint", 1), "d": ("bigint", 16)}  # 0.0625
    assert one(spark, half, rates.rate(F.col("n"), F.col("d"), 3)) == D("0.063")
    assert one(spark, half, rates.rate(-F.col("n"), F.col("d"), 3)) == D("-0.063")
    exact = {"n": ("bigint", 201), "d": ("bigint", 200)}  # 1.005 as a double is below the half
    assert one(spark, exact, rates.rate(F.col("n"), F.col("d"), 2)) == D("1.01")


def test_mean_rounds_once(spark):
    values = {"t": ("decimal(15,1)", D("884499996.0")), "n": ("bigint", 10_000_000)}
    assert one(spark, values, rates.mean(F.col("t"), F.col("n"), 1)) == D("88.4")


def staff(**counts):
    base = dict.fromkeys(
        """earned_runs walks hits_allowed strikeouts home_runs_allowed hit_batsmen wins losses
        games games_started""".split(), 0
    )
    ip = counts.pop("ip", "0.0")
    values = {k: ("bigint", v) for k, v in {**base, **counts}.items()}
    return {**values, "innings_pitched": ("decimal(17,1)", D(ip))}


ACE = staff(
    ip="200.1", earned_runs=70, walks=50, hits_allowed=180, strikeouts=210,
    home_runs_allowed=20, hit_batsmen=5, wins=15, losses=8, games=32, games_started=32,
)


@pytest.mark.parametrize(
    "make, expected",
    [
        (pitching.era, "3.15"),  # 630 / 200.1
        (pitching.whip, "1.15"),
        (pitching.strikeout_walk_ratio, "4.20"),
        (lambda: pitching.per_nine("strikeouts"), "9.45"),
        (pitching.batting_average_against, "0.231"),  # 180 / 780.3
        (pitching.fip, "3.15"),  # (260 + 150 - 420) / 200.1 + 3.20
        (pitching.win_share, "0.652"),
        (lambda: pitching.per_batter_faced("strikeouts"), "0.251"),  # 210 / 835.3
    ],
)
def test_pitching(spark, make, expected):
    assert one(spark, ACE, make()) == D(expected)
    assert one(spark, staff(), make()) is None


def test_fip_can_be_negative(spark):
    assert one(spark, staff(ip="1.0", strikeouts=3), pitching.fip()) == D("-2.80")


def test_role_needs_more_than_half_the_games(spark):
    assert one(spark, staff(games=10, games_started=5), pitching.role()) == "Reliever"
    assert one(spark, staff(games=10, games_started=6), pitching.role()) == "Starter"


def test_barrel_bounds_are_inclusive(spark):
    def flag(speed, angle):
        values = {
            "exit_velocity": ("decimal(5,1)", D(speed)),
            "launch_angle": ("decimal(5,1)", D(angle) if angle else None),
        }
        return one(spark, values, contact.barrel())

    assert flag("98.0", "26.0") and flag("98.0", "30.0")
    assert not flag("97.9", "28.0") and not flag("98.0", "30.1") and not flag("110.0", "25.9")
    assert not flag("98.0", None)


def games(spark, *rows):
    schema = """game_pk int, game_type string, season int, game_date date, game_datetime timestamp,
        game_status_code string, home_team_id int, away_team_id int, home_score int,
        away_score int, venue_id int, venue_name string, winning_pitcher_id int,
        losing_pitcher_id int, save_pitcher_id int, innings int, day_night string,
        series_description string, series_game_number int, double_header string"""
    filled = [
        (pk, "R", 2024, None, None, status, home, away, hs, as_, 1, "v", 1, 2, None, innings,
         "day", "s", 1, "N")
        for pk, status, home, away, hs, as_, innings in rows
    ]
    return spark.createDataFrame(filled, schema)


def test_ties_and_missing_scores(spark, rows):
    played = games(
        spark,
        (1, "F", 10, 20, 5, 3, 9),
        (2, "F", 10, 20, 4, 4, 12),
        (3, "F", 20, 10, None, None, None),
        (4, "FT", 20, 10, 1, 0, 9),
    )
    results = intermediate.int_game_results(played)
    assert rows(results, "game_pk", "team_id", "is_home", "is_win", "is_loss") == [
        (1, 10, True, True, False),
        (1, 20, False, False, True),
        (2, 10, True, False, False),
        (2, 20, False, False, False),
    ]
    teams = spark.createDataFrame(
        [(10, "Tens", "TEN"), (20, "Twenties", "TWE")],
        "team_id int, team_full_name string, team_abbreviation string",
    )
    players = spark.createDataFrame([(1, "One")], "player_id int, full_name string")
    summary = marts.fct_game_summary(played, teams, players)
    assert rows(
        summary, "game_pk", "winner", "winning_team_id", "losing_team_id", "run_margin",
        "is_extra_innings", "winning_pitcher_name", "losing_pitcher_name",
    ) == [
        (1, "home", 10, 20, 2, False, "One", None),
        (2, "away", 20, 10, 0, True, "One", None),
        (3, "away", 10, 20, None, False, "One", None),
    ]


def test_standings_games_behind_and_missing_division(spark, rows):
    results = intermediate.int_game_results(
        games(
            spark,
            (1, "F", 10, 20, 5, 3, 9),
            (2, "F", 10, 20, 4, 1, 9),
            (3, "F", 20, 10, 2, 0, 9),
            (4, "F", 30, 20, 7, 0, 9),
        )
    )
    teams = spark.createDataFrame(
        [(10, "Tens", "TEN", "L", "East"), (20, "Twenties", "TWE", "L", "East"),
         (30, "Thirties", "THI", "L", None)],
        """team_id int, team_full_name string, team_abbreviation string, league_name string,
        division_name string""",
    )
    standings = intermediate.int_team_standings(results, teams)
    assert rows(standings, "team_id", "wins", "losses", "win_pct", "games_behind") == [
        (10, 2, 1, D("0.667"), D("0.0")),  # 0.667 * 3 - 2
        (20, 1, 3, D("0.250"), D("1.7")),  # 0.667 * 4 - 1
        (30, 1, 0, D("1.000"), None),
    ]


def test_expected_wins_use_the_unrounded_share(spark):
    values = {
        "runs_scored": ("bigint", 700),
        "runs_allowed": ("bigint", 650),
        "games_played": ("bigint", 162),
        "wins": ("bigint", 90),
    }
    assert one(spark, values, team.pythagorean_win_pct()) == D("0.537")  # 490000 / 912500
    assert one(spark, values, team.pythagorean_wins()) == D("87")  # 86.99
    values["runs_allowed"] = ("bigint", 0)
    assert one(spark, values, team.pythagorean_win_pct()) is None


def test_team_ops_adds_rounded_parts(spark):
    values = {"team_obp": ("decimal(5,3)", D("0.333")), "team_slg": ("decimal(5,3)", D("0.333"))}
    assert one(spark, values, team.team_ops()) == D("0.666")
