import json

import pytest
from pyspark.sql import functions as F

from sabermill.plans import loads
from sabermill.schemas import raw_schema
from sabermill.session import fresh_path
from sabermill.sources import landing
from sabermill.streaming import documents as D


def game(pk, status="S", day="2024-05-01"):
    sides = {"home": {"team": {"id": 1}}, "away": {"team": {"id": 2}}}
    found = {"gamePk": pk, "gameType": "R", "season": "2024", "status": {"statusCode": status}, "teams": sides}
    return {"dates": [{"date": day, "games": [found]}]}


@pytest.fixture
def landed(tmp_path):
    folder = tmp_path / "landed"
    folder.mkdir()

    def land(**docs):
        for name, doc in docs.items():
            (folder / f"{name}.json").write_text(doc if isinstance(doc, str) else json.dumps(doc))
        return str(folder)

    return land


def run(spark, landed, store, files=None):
    query = D.load_stream(D.document_stream(spark, landed, files), "schedule", store)
    query.awaitTermination()


def stored(spark, store):
    return sorted((r.game_pk, r.status_code) for r in D.open_table(spark, store, "schedule").read().collect())


def test_each_file_is_loaded_once_and_a_later_batch_overwrites(spark, landed, tmp_path):
    store = str(tmp_path / "store")
    place = landed(a=game(1), b=game(2), c="{", d=game(3, day="no day"), e="")
    run(spark, place, store)
    assert stored(spark, store) == [(1, "S"), (2, "S")]
    rejects = {(r.reason, (r.file or "").rsplit("/", 1)[-1], r.batch) for r in D.read_rejects(spark, store).collect()}
    assert {r for r in rejects if r[0] == "incomplete"} == {("incomplete", "", 0)}
    assert ("unreadable", "c.json", 0) in rejects
    row = D.read_rejects(spark, store).where("reason = 'incomplete'").first()
    assert json.loads(row.content)["game_pk"] == 3
    first = D.read_counts(spark, store).collect()
    assert [(r.rows, r.incomplete, r.kept, r.batch) for r in first] == [(3, 1, 2, 0)]
    version = D.open_table(spark, store, "schedule").state()[0]
    run(spark, place, store)  # nothing new has landed
    assert D.open_table(spark, store, "schedule").state()[0] == version and D.read_counts(spark, store).count() == 1
    landed(f=game(2, "F"), g=game(4), h=game(1))  # h repeats what a said
    run(spark, place, store, files=1)
    assert stored(spark, store) == [(1, "S"), (2, "F"), (4, "S")]
    assert D.read_counts(spark, store).count() == 4


def test_a_batch_that_failed_half_way_counts_once(spark, tmp_path, monkeypatch):
    store = str(tmp_path / "store")
    batch = spark.createDataFrame([("a", json.dumps(game(1))), ("b", "{"), (None, None)], "file string, document string")
    commit = D.VersionedTable.merge
    monkeypatch.setattr(D.VersionedTable, "merge", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        D.store_documents(batch, 0, "schedule", store)
    assert stored(spark, store) == []
    monkeypatch.setattr(D.VersionedTable, "merge", commit)
    assert D.store_documents(batch, 0, "schedule", store)
    assert not D.store_documents(batch, 0, "schedule", store)
    assert stored(spark, store) == [(1, "S")]
    assert sorted((r.reason, r.file or "") for r in D.read_rejects(spark, store).collect()) == [("unreadable", ""), ("unreadable", "b")]
    got = D.read_counts(spark, store).collect()
    assert [tuple(r)[:5] for r in got] == [(3, 2, 1, 0, 1)]


def test_an_empty_batch_and_a_store_without_batches(spark, tmp_path):
    store = str(tmp_path / "store")
    assert D.read_rejects(spark, store).count() == 0 == D.read_counts(spark, store).count()
    D.store_documents(spark.createDataFrame([], "file string, document string"), 0, "teams", store)
    assert D.open_table(spark, store, "teams").read().count() == 0
    assert tuple(D.read_counts(spark, store).first()) == (0, 0, 0, 0, 0, 0)


def test_documents_are_parsed_once_for_all_frames_of_a_load(spark):
    calls = spark.sparkContext.accumulator(0)

    def seen(text):
        calls.add(1)
        return text

    docs = [(i, json.dumps(game(i))) for i in range(20)] + [(20, "{"), (21, None)]
    texts = spark.createDataFrame(docs, "dates int, doc string").select("dates", F.udf(seen)("doc").alias("doc"))
    target = spark.createDataFrame([], raw_schema("schedule"))
    done = loads.load(texts, "doc", "schedule", target)
    assert done.merged.count() == 20 and tuple(done.counts.first()) == (22, 2, 20, 0, 20)
    assert sorted(r.dates for r in done.unreadable.collect()) == [20, 21] and done.incomplete.count() == 0
    assert calls.value == 22
    for frame in (done.merged, done.unreadable, done.incomplete, done.counts):
        assert "from_json" not in frame._jdf.queryExecution().executedPlan().toString()


def test_unreadable_texts_keep_their_own_columns(spark):
    texts = spark.createDataFrame([(1, '{"teams": []}'), (2, "["), (3, None)], "teams int, doc string")
    parsed = landing.parse_documents(texts, "doc", landing.TEAMS_PAYLOAD)
    assert sorted(r.teams for r in landing.unreadable(parsed).collect()) == [2, 3]
    assert [r.teams for r in landing.readable(parsed).collect()] == [[]]


def test_a_store_keeps_the_files_that_a_batch_does_not_touch(spark, tmp_path):
    store = fresh_path(spark, "documents")
    for number, pk in enumerate((1, 2, 1)):
        batch = spark.createDataFrame([(str(pk), json.dumps(game(pk, "SFX"[number])))], "file string, document string")
        before = D.open_table(spark, store, "schedule").state()[1]["files"]
        D.store_documents(batch, number, "schedule", store)
        after = D.open_table(spark, store, "schedule").state()[1]["files"]
        held = D.open_table(spark, store, "schedule").read().select("game_pk", F.col("_metadata.file_path").alias("f"))
        assert len({r.f for r in held.collect()}) == min(number + 1, 2)
        assert number < 2 or set(before) & set(after)
    assert stored(spark, store) == [(1, "X"), (2, "F")]


def test_players_of_a_batch_take_the_team_of_the_rosters(spark, tmp_path):
    store = str(tmp_path / "store")
    schema = "team_id int, team_order bigint, roster array<struct<person:struct<id:int>>>"
    rosters = spark.createDataFrame([(4, 0, [((1,),)])], schema)
    people = {"people": [{"id": 1, "fullName": "A"}, {"id": 2, "fullName": "B", "currentTeam": {"id": 9}}]}
    batch = spark.createDataFrame([("a", json.dumps(people))], "file string, document string")
    D.store_documents(batch, 0, "players", store, rosters)
    got = D.open_table(spark, store, "players").read()
    assert sorted((r.player_id, r.current_team_id) for r in got.collect()) == [(1, 4), (2, 9)]
