import json
from datetime import datetime

import pytest

from sabermill.plans import loads
from sabermill.schemas import KEYS, raw_schema

OLD = datetime(2020, 1, 1)


def table(spark, name, *rows):
    return spark.createDataFrame([tuple(r.get(c) for c in raw_schema(name).names) for r in rows], raw_schema(name))


def documents(spark, *docs):
    return spark.createDataFrame([(i, d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)], "n int, doc string")


def stats(player, *splits):
    return {"player_id": player, "season": 2024, "game_type": "R", "people": [{"stats": [{"group": {"displayName": "hitting"}, "splits": list(splits)}]}]}


def test_batting_documents_become_merged_rows_with_ids_and_counts(spark):
    old = {"id": 77, "player_id": 1, "season": 2024, "team_id": 5, "game_type": "R", "hits": 3, "loaded_at": OLD}
    other = {**old, "id": 78, "player_id": 9}
    docs = documents(
        spark,
        stats(1, {"stat": {"hits": "10"}, "team": {"id": 5}}),
        stats(2, {"stat": {"hits": "junk", "homeRuns": 4}, "team": {"id": 6}}, {"stat": {"hits": 1}}),
        stats(None, {"stat": {"hits": 1}, "team": {"id": 5}}),
        '{"player_id": 3, "people": [{"stats"',
    )
    done = loads.load(docs, "doc", "batting_stats", table(spark, "batting_stats", old, other))
    got = {r.player_id: r for r in done.merged.collect()}
    assert set(got) == {1, 2, 9}
    assert (got[1].hits, got[1].id) == (10, 77) and got[1].loaded_at > OLD
    assert (got[9].hits, got[9].id, got[9].loaded_at) == (3, 78, OLD)
    assert got[2].hits is None and got[2].home_runs == 4 and got[2].id is not None
    assert [r.n for r in done.unreadable.collect()] == [3]
    assert [r.player_id for r in done.incomplete.collect()] == [None]
    assert tuple(done.counts.first()) == (4, 1, 3, 1, 2)
    again = loads.load(docs, "doc", "batting_stats", done.merged)
    key = KEYS["batting_stats"]
    assert sorted(again.merged.select("id", *key, "hits").collect()) == sorted(done.merged.select("id", *key, "hits").collect())


def game(pk, status, day="2024-05-01"):
    return {"dates": [{"date": day, "games": [{"gamePk": pk, "gameType": "R", "season": "2024", "status": {"statusCode": status}, "teams": {"home": {"team": {"id": 1}}, "away": {"team": {"id": 2}}}}]}]}


def test_schedule_and_games_take_their_rows_of_the_same_documents(spark):
    docs = documents(spark, game(1, "F"), game(2, "S"), game(3, "F", "no day"), "[")
    schedule = loads.load(docs, "doc", "schedule", table(spark, "schedule"))
    games = loads.load(docs, "doc", "games", table(spark, "games"))
    assert sorted(r.game_pk for r in schedule.merged.collect()) == [1, 2]
    assert all(r.id is not None and r.scheduled_innings == 9 for r in schedule.merged.collect())
    assert sorted(r.game_pk for r in games.merged.collect()) == [1]
    assert [r.game_pk for r in schedule.incomplete.collect()] == [3]
    assert schedule.counts.first().unreadable == 1


def test_players_take_the_team_of_the_roster(spark):
    docs = documents(spark, {"people": [{"id": 1, "fullName": "A"}, {"id": 2, "fullName": "B", "currentTeam": {"id": 9}}]})
    rosters = spark.createDataFrame([(4, 0, [((1,),), ((2,),)])], "team_id int, team_order bigint, roster array<struct<person:struct<id:int>>>")
    done = loads.load(docs, "doc", "players", table(spark, "players"), rosters)
    assert sorted((r.player_id, r.current_team_id) for r in done.merged.collect()) == [(1, 4), (2, 9)]


def test_the_last_of_repeated_keys_does_not_depend_on_order(spark):
    named = {"abbreviation": "X", "teamName": "x", "teamCode": "x"}
    docs = [{"teams": [{"id": 1, "name": n, **named}]} for n in ("b", "c", "a")]
    for order in (docs, docs[::-1]):
        done = loads.load(documents(spark, *order), "doc", "teams", table(spark, "teams"))
        assert [r.name for r in done.merged.collect()] == ["c"]


def test_every_keyed_table_can_be_loaded(spark):
    assert set(loads.SOURCES) == set(KEYS)
    with pytest.raises(KeyError):
        loads.load(documents(spark, {}), "doc", "nothing", table(spark, "teams"))
