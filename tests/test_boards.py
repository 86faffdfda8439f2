import pytest

from sabermill.plans import boards


@pytest.fixture
def batting(spark):
    rows = [
        (1, 2024, "A", 600, 30, 0.9, None), (2, 2024, "B", 600, 30, None, 0.4),
        (3, 2024, "C", 50, 99, 0.7, 0.3), (4, 2023, "D", 600, 80, 0.8, 0.2),
        (5, 2024, "E", 400, 0, 0.95, 0.1),
    ]
    names = {
        "player_id": "int", "season": "int", "full_name": "string", "plate_appearances": "int",
        "home_runs": "int", "on_base_plus_slugging": "double", "woba": "double",
    }
    rest = """position_name games_played batting_average on_base_percentage slugging_percentage
        iso babip walk_pct strikeout_pct rbi stolen_bases hits runs doubles triples xba xwoba
        barrel_pct hard_hit_pct avg_exit_velocity""".split()
    schema = ", ".join([*(f"{n} {t}" for n, t in names.items()), *(f"{n} int" for n in rest)])
    return spark.createDataFrame([(*r, *[0] * len(rest)) for r in rows], schema)


@pytest.fixture
def players(spark):
    return spark.createDataFrame([(1, "Team 1")], "player_id int, current_team_name string")


def test_leaders_filter_sort_and_keep_players_without_team(batting, players):
    got = boards.batting_leaders(batting, players, 2024, min_pa=100).collect()
    assert [(r.player_id, r.current_team_name) for r in got] == [
        (5, None), (1, "Team 1"), (2, None),
    ]


def test_boards_cut_after_the_filter_with_a_stable_tie_break(batting, players):
    leaders = boards.batting_leaders(batting, players, 2024)
    assert [r.full_name for r in boards.hr_leaders(leaders, 2).collect()] == ["C", "A"]
    assert [r.full_name for r in boards.woba_leaders(leaders).collect()] == ["B", "C", "E"]


def test_pick_lists(batting):
    seasons = boards.pick_list(batting, "season", newest_first=True)
    assert [r.season for r in seasons.collect()] == [2024, 2023]


def test_an_empty_front_page_has_null_sums(spark):
    schema = """game_type string, season int, home_score int, away_score int,
        is_extra_innings boolean"""
    row = boards.total_games(spark.createDataFrame([], schema)).first()
    assert tuple(row) == (0, 0, None, None, None)
    empty = spark.createDataFrame([], "home_runs int")
    assert boards.total_home_runs(empty).first()[0] == 0


def test_recent_games_text_is_null_where_a_part_is(spark):
    schema = """game_pk int, game_type string, game_date date, away_team_name string,
        home_team_name string, away_score int, home_score int, winner string,
        winning_pitcher_name string, losing_pitcher_name string, save_pitcher_name string,
        is_extra_innings boolean"""
    rows = [(1, "R", None, "A", "H", 1, 2, "home", None, None, None, True),
            (2, "R", None, None, "H", None, 2, "away", None, None, None, False)]
    got = boards.recent_games(spark.createDataFrame(rows, schema)).collect()
    assert [(r.matchup, r.score, r.winning_team, r.extras) for r in got] == [
        ("A @ H", "1 - 2", "H", "Yes"), (None, None, None, "No"),
    ]
