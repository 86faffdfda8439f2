import json
from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from sabermill.sources import chunks, landing


def land(tmp_path, name, document):
    folder = tmp_path / name
    folder.mkdir(exist_ok=True)
    (folder / f"{len(list(folder.iterdir()))}.json").write_text(json.dumps(document, indent=1))
    return str(folder)


def test_teams_fill_defaults(spark, tmp_path):
    path = land(tmp_path, "teams", {"teams": [
        {"id": 1, "name": "A", "league": {"id": 103, "name": "L"}, "sport": {"id": 11},
         "active": False, "unknown": 1},
        {"id": 2, "name": "B"},
    ]})
    got = landing.flatten_teams(landing.read_payloads(spark, path, landing.TEAMS_PAYLOAD))
    rows = {r.team_id: r for r in got.collect()}
    assert (rows[1].league_name, rows[1].sport_id, rows[1].active) == ("L", 11, False)
    assert (rows[2].league_name, rows[2].sport_id, rows[2].active) == (None, 1, True)


def game(pk, status, innings=None, scheduled=None, **more):
    doc = {"gamePk": pk, "season": "2024", "status": {"statusCode": status},
           "gameDate": "2024-04-01T17:05:00Z",
           "teams": {"home": {"team": {"id": 1, "name": "A"}, "score": 3,
                              "leagueRecord": {"wins": 4, "losses": 2}},
                     "away": {"team": {"id": 2}}}, **more}
    if innings is not None:
        doc["linescore"] = {"innings": [{"num": i} for i in range(innings)]}
    if scheduled:
        doc["scheduledInnings"] = scheduled
    return doc


def schedule(spark, tmp_path):
    path = land(tmp_path, "schedule", {"dates": [
        {"date": "2024-04-01", "games": [game(1, "F", 10), game(2, "FT", 0, 7), game(3, "S")]},
        {"date": "2024-04-02", "games": []},
        {"date": "2024-04-03"},
        {"date": "2024-04-04", "games": [game(4, "FR", decisions={"winner": {"id": 9}}),
                                         game(5, "DR", scheduled=7)]},
    ]})
    land(tmp_path, "schedule", {"dates": [{"date": "2024-05-01", "games": [game(6, "FO", 9)]}]})
    return landing.read_payloads(spark, path, landing.SCHEDULE_PAYLOAD)


def test_games_keep_final_statuses_and_count_innings(spark, tmp_path, rows):
    games = landing.flatten_games(schedule(spark, tmp_path))
    assert rows(games, "game_pk", "game_date", "innings", "winning_pitcher_id", "home_wins") == [
        (1, date(2024, 4, 1), 10, None, 4),
        (2, date(2024, 4, 1), 7, None, 4),
        (4, date(2024, 4, 4), None, 9, 4),
        (6, date(2024, 5, 1), 9, None, 4),
    ]


def test_schedule_keeps_every_game_and_defaults_innings(spark, tmp_path, rows):
    got = landing.flatten_schedule(schedule(spark, tmp_path))
    assert rows(got, "game_pk", "scheduled_innings", "season", "home_team_name") == [
        (1, 9, 2024, "A"), (2, 7, 2024, "A"), (3, 9, 2024, "A"), (4, 9, 2024, "A"),
        (5, 7, 2024, "A"), (6, 9, 2024, "A"),
    ]
    assert got.first().game_datetime.hour == 17


def test_players_take_the_first_roster_without_a_team_of_their_own(spark, tmp_path, rows):
    land(tmp_path, "rosters", {"team_id": 20, "team_order": 2,
                               "roster": [{"person": {"id": 1}}, {"person": {"id": 3}}]})
    rosters = land(tmp_path, "rosters", {"team_id": 10, "team_order": 1,
                                         "roster": [{"person": {"id": 1}}, {"person": {"id": 2}}]})
    spots = landing.first_roster_spots(
        landing.read_payloads(spark, rosters, landing.ROSTER_PAYLOAD)
    )
    assert rows(spots) == [(1, 10), (2, 10), (3, 20)]
    people = land(tmp_path, "people", {"people": [
        {"id": 1, "currentTeam": {"id": 0}, "birthDate": "1990-05-06"},
        {"id": 2, "currentTeam": {"id": 77}, "fullName": "B", "active": False},
        {"id": 3},
    ]})
    got = landing.flatten_players(
        landing.read_payloads(spark, people, landing.PEOPLE_PAYLOAD), spots
    )
    assert rows(got, "player_id", "full_name", "current_team_id", "active", "birth_date") == [
        (1, "", 10, True, date(1990, 5, 6)), (2, "B", 77, False, None), (3, "", 20, True, None),
    ]


def stats(group, *splits):
    return {"group": {"displayName": group}, "splits": list(splits)}


def split(team, **stat):
    return {"stat": stat, "team": {"id": team} if team else {}, "league": {"id": 103}}


def person_stats(tmp_path, *blocks):
    return land(tmp_path, "stats", {
        "player_id": 5, "season": 2024, "game_type": "R",
        "people": [{"stats": list(blocks)}, {"stats": [stats("hitting", split(9, hits=99))]}],
    })


def test_batting_picks_the_first_filled_block_and_drops_rows_without_team(spark, tmp_path, rows):
    path = person_stats(
        tmp_path,
        stats("pitching", split(1, hits=50)),
        stats("hitting"),
        stats("hitting", split(1, hits="12", atBats=40, avg=".300", ops=".---", runs=""),
              split(2, hits="12.0", atBats="x", avg="1.000"), split(None, hits=3)),
        stats("hitting", split(3, hits=1)),
    )
    got = landing.flatten_batting_stats(
        landing.read_payloads(spark, path, landing.HITTING_PAYLOAD)
    )
    assert rows(got, "team_id", "hits", "at_bats", "batting_average", "ops", "runs") == [
        (1, 12, 40, D("0.300"), None, None), (2, None, None, D("1.000"), None, None),
    ]


def test_pitching_reads_innings_as_written(spark, tmp_path, rows):
    path = person_stats(
        tmp_path,
        stats("pitching", split(1, inningsPitched="6.1", era="-.--"), split(2, era="0.00"),
              split(3, inningsPitched="junk")),
    )
    got = landing.flatten_pitching_stats(
        landing.read_payloads(spark, path, landing.PITCHING_PAYLOAD)
    )
    assert rows(got, "team_id", "innings_pitched", "era") == [
        (1, D("6.1"), None), (2, D("0.0"), D("0.00")), (3, None, None),
    ]


def test_text_payloads_parse_like_files(spark):
    doc = json.dumps({"teams": [{"id": 4, "name": "D"}]})
    texts = spark.createDataFrame([(doc,)], "doc string")
    got = landing.flatten_teams(landing.parse_payloads(texts, "doc", landing.TEAMS_PAYLOAD))
    assert [r.team_id for r in got.collect()] == [4]


BROKEN = ["not json", '{"teams": [{"id": 5', '{"teams": 7}', None]


@pytest.mark.parametrize("text", BROKEN[:3])
def test_an_unreadable_document_stops_a_plain_read(spark, tmp_path, text):
    texts = spark.createDataFrame([(text,)], "doc string")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|cannot be parsed"):
        landing.parse_payloads(texts, "doc", landing.TEAMS_PAYLOAD).collect()
    (tmp_path / "teams.json").write_text(text)
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|FAILED_READ|cannot be parsed"):
        landing.read_payloads(spark, str(tmp_path), landing.TEAMS_PAYLOAD).collect()


def test_unreadable_documents_are_kept_apart(spark):
    docs = [json.dumps({"teams": [{"id": i}]}) for i in (1, 2)] + BROKEN + ["{}"]
    texts = spark.createDataFrame(list(enumerate(docs)), "n int, doc string")
    good, bad = landing.split_payloads(texts, "doc", landing.TEAMS_PAYLOAD)
    assert sorted(r.team_id for r in landing.flatten_teams(good).collect()) == [1, 2]
    assert good.count() == 3 and sorted(r.n for r in bad.collect()) == [2, 3, 4, 5]


def test_values_that_are_no_dates_become_null(spark):
    doc = json.dumps({"people": [{"id": 1, "birthDate": "garbage", "mlbDebutDate": "2020-02-30"},
                                 {"id": 2, "birthDate": "1990-05-06"}]})
    texts = spark.createDataFrame([(doc,)], "doc string")
    rosters = spark.createDataFrame([], landing.ROSTER_PAYLOAD)
    people = landing.flatten_players(
        landing.parse_payloads(texts, "doc", landing.PEOPLE_PAYLOAD),
        landing.first_roster_spots(rosters),
    )
    got = {r.player_id: (r.birth_date, r.mlb_debut_date) for r in people.collect()}
    assert got == {1: (None, None), 2: (date(1990, 5, 6), None)}


def test_chunks_are_inclusive_and_the_last_is_short(spark, rows):
    got = chunks.chunks_between(spark, date(2024, 3, 28), date(2024, 4, 8))
    assert rows(got) == [
        (0, date(2024, 3, 28), date(2024, 4, 1)),
        (1, date(2024, 4, 2), date(2024, 4, 6)),
        (2, date(2024, 4, 7), date(2024, 4, 8)),
    ]
    day = spark.range(12).select(F.date_add(F.lit(date(2024, 3, 28)), F.col("id").cast("int")))
    tagged = day.select(chunks.chunk_of(F.col(day.columns[0]), F.lit(date(2024, 3, 28))))
    assert [r[0] for r in tagged.collect()] == [0] * 5 + [1] * 5 + [2] * 2
