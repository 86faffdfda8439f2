import os
import time
from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from sabermill.session import fresh_path, settings
from sabermill.sources import pitches
from sabermill.streaming import ingest

SCHEMA = """game_pk double, game_date string, game_year double, batter double, pitcher double,
    player_name string, at_bat_number double, pitch_number double, launch_speed double,
    zone string, other string"""
NAN = float("nan")


def pitch(pk, at_bat=1.0, number=1.0, batter=7.0, day="2024-04-01 00:00:00", speed=NAN, zone="3"):
    return (pk, day, 2024.0, batter, 8.0, "Name", at_bat, number, speed, zone, "x")


def test_pitch_rows_coerce_and_drop_incomplete(spark):
    frame = spark.createDataFrame(
        [pitch(1.0, speed=95.35, zone="3.0"), pitch(2.0, zone="bad"), pitch(3.0, batter=NAN),
         pitch(NAN), pitch(4.0, day=None)],
        SCHEMA,
    )
    got = pitches.pitch_rows(frame)
    assert got.columns == [f.name for f in pitches.raw_schema("statcast")]
    rows = {r.game_pk: r for r in got.collect()}
    assert set(rows) == {1, 2, None}
    assert rows[1].launch_speed == D("95.4") and rows[1].zone == 3
    assert rows[1].game_date == date(2024, 4, 1) and rows[1].batter_name == "Name"
    assert rows[2].launch_speed is None and rows[2].zone is None and rows[2].pitcher_name is None


@pytest.fixture
def landing_folder(spark, tmp_path):
    folder = str(tmp_path / "landed")

    def land(*rows):
        spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        return ingest.landed_stream(
            spark, folder, spark.createDataFrame([], SCHEMA).schema, files_per_batch=1
        )

    return land


def test_append_reads_each_file_once(spark, landing_folder):
    path, checkpoint = fresh_path(spark, "s"), fresh_path(spark, "c")
    for stream in (landing_folder(pitch(1.0), pitch(1.0)), landing_folder(pitch(2.0))):
        ingest.append_stream(stream, path, checkpoint).awaitTermination()
    ingest.append_stream(stream, path, checkpoint).awaitTermination()
    assert sorted(r.game_pk for r in spark.read.parquet(path).collect()) == [1, 1, 2]


def test_keyed_ingest_drops_repeats_across_runs_and_keeps_late_and_keyless_rows(
    spark, landing_folder
):
    path = fresh_path(spark, "keyed")
    first = landing_folder(pitch(1.0, batter=9.0), pitch(1.0, batter=5.0), pitch(2.0), pitch(NAN))
    ingest.keyed_stream(first, path).awaitTermination()
    late = pitch(3.0, day="1999-04-01 00:00:00")
    again = landing_folder(pitch(1.0, batter=6.0), pitch(2.0), late, pitch(NAN), pitch(NAN))
    for _ in range(2):
        ingest.keyed_stream(again, path).awaitTermination()
    stored = sorted(
        ((r.game_pk, r.batter) for r in ingest.read_store(spark, path).collect()), key=str
    )
    assert stored == [(1, 5), (2, 7), (3, 7), (None, 7), (None, 7), (None, 7)]


def test_unseen_keeps_one_row_of_a_hot_pitch(spark):
    hot = spark.range(5000).select(
        F.lit(1).alias("game_pk"), F.lit(1).alias("at_bat_number"), F.lit(1).alias("pitch_number"),
        F.lit(date(2024, 4, 1)).alias("game_date"), F.col("id").alias("batter"),
        F.lit(1).alias("pitcher"), F.col("id").alias("id"),
    )
    assert [r.batter for r in ingest.unseen(hot, hot.limit(0)).collect()] == [0]
    assert ingest.unseen(hot, hot).count() == 0


def test_the_stored_version_of_a_pitch_does_not_depend_on_order(spark, landing_folder, tmp_path):
    versions = [pitch(1.0, speed=101.0), pitch(1.0, speed=90.0), pitch(1.0, zone="1", speed=90.0)]
    stored = []
    for rows in (versions, versions[::-1]):
        folder = str(tmp_path / f"in{len(stored)}")
        spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(folder)
        stream = ingest.landed_stream(spark, folder, spark.createDataFrame([], SCHEMA).schema)
        path = fresh_path(spark, "order")
        ingest.keyed_stream(stream, path).awaitTermination()
        stored.append([(r.launch_speed, r.zone) for r in ingest.read_store(spark, path).collect()])
    assert stored[0] == stored[1] and len(stored[0]) == 1


def test_a_batch_reads_its_own_seasons_of_the_store(spark, landing_folder):
    path = fresh_path(spark, "seasons")
    ingest.keyed_stream(landing_folder(pitch(1.0), pitch(2.0)), path).awaitTermination()
    old = (9.0, "2023-04-01", 2023.0, *pitch(9.0)[3:])
    ingest.keyed_stream(landing_folder(old, old), path).awaitTermination()
    store = ingest.read_store(spark, path)
    assert sorted((r.game_pk, r.game_year, r.batch) for r in store.collect()) == [
        (1, 2024, 0), (2, 2024, 0), (9, 2023, 1),
    ]
    text = store.where("game_year = 2023")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(game_year" in text


def test_a_repeat_with_another_season_or_none_is_not_stored_again(spark, landing_folder):
    path = fresh_path(spark, "moved")
    nameless = (5.0, "2024-04-01", NAN, *pitch(5.0)[3:])
    moved = (6.0, "2024-04-01", 2023.0, *pitch(6.0)[3:])
    ingest.keyed_stream(landing_folder(nameless, moved), path, buckets=4).awaitTermination()
    ingest.keyed_stream(landing_folder(pitch(5.0), pitch(6.0), pitch(7.0)), path).awaitTermination()
    got = ingest.read_store(spark, path).collect()
    assert sorted((r.game_pk, r.game_year, r.batch) for r in got if r.game_year) == [(6, 2023, 0), (7, 2024, 1)]
    assert [(r.game_pk, r.batch) for r in got if not r.game_year] == [(5, 0)]


def test_the_store_is_joined_without_a_shuffle_and_survives_its_catalog(spark, landing_folder):
    path = fresh_path(spark, "buckets")
    landed = landing_folder(*[pitch(float(i % 40), float(i)) for i in range(300)])
    ingest.keyed_stream(landed, path, buckets=4).awaitTermination()
    rows = pitches.raw_schema("statcast")
    assert ingest.store_table(spark, path, rows).count() == 300
    for t in spark.catalog.listTables():  # the files stay; another application begins like this
        if t.name.startswith("pitch_store_"):
            spark.sql(f"DROP TABLE {t.name}")
    stored = ingest.store_table(spark, path, rows)
    assert stored.count() == 300
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = ingest.read_store(spark, path).drop("batch").where("at_bat_number < 200")
        fresh = ingest.unseen(batch, stored)
        text = fresh._jdf.queryExecution().executedPlan().toString()
        assert fresh.count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    store = text.split("LeftAnti")[1]
    before, after = store.rsplit("FileScan", 1)[0], store.rsplit("FileScan", 1)[1]
    assert "Bucketed: true" in after and "Exchange" not in before.split("FileScan")[-1]
    assert "WindowGroupLimit" in text


def test_a_replay_replaces_what_its_batch_stored(spark):
    path = fresh_path(spark, "replay")
    rows = spark.createDataFrame([pitch(1.0), pitch(2.0), pitch(NAN)], SCHEMA)
    ingest.store_batch(pitches.pitch_rows(rows), 0, path, 4)
    again = spark.createDataFrame([pitch(1.0), pitch(3.0), pitch(NAN)], SCHEMA)
    for _ in range(2):
        ingest.store_batch(pitches.pitch_rows(again), 1, path, 4)
    ingest.store_batch(pitches.pitch_rows(rows), 0, path, 4)
    stored = sorted(((r.game_pk, r.batch) for r in ingest.read_store(spark, path).collect()), key=str)
    assert stored == [(1, 0), (2, 0), (3, 1), (None, 0), (None, 1)]


def test_the_batch_is_read_once(spark):
    at = fresh_path(spark, "batch")
    pitches.pitch_rows(spark.createDataFrame([pitch(1.0)], SCHEMA)).write.parquet(at)
    batch = spark.read.parquet(at)
    stored = spark.createDataFrame([], batch.schema)
    text = ingest.unseen(batch, stored)._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1


@pytest.fixture
def stored_plans(spark, monkeypatch):
    """Plans of what is added to a keyed store, joined without a broadcast."""
    plans, write = [], type(spark.range(1).write).saveAsTable

    def watched(*args, **named):
        with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
            write(*args, **named)
        done = spark._jsparkSession.sharedState().statusStore().executionsList()
        plans.append(done.last().physicalPlanDescription().split("Initial Plan")[0])

    monkeypatch.setattr(type(spark.range(1).write), "saveAsTable", watched)
    return plans


def test_a_large_batch_is_stored_in_passes_that_add_up(spark, monkeypatch, stored_plans):
    early = [pitch(float(i), 2.0) for i in range(0, 60, 3)]
    rows = [pitch(float(i), float(i % 4), batter=float(b)) for i in range(60) for b in (9, 8, 7)]
    rows += [pitch(float(i), 1.0, NAN) for i in range(10)]
    monkeypatch.setattr(ingest, "MOST_PASSES", 3)
    found = []
    for at_once, passes in ((1000, 1), (10, 3)):
        monkeypatch.setattr(ingest, "ROWS_AT_ONCE", at_once)
        path = fresh_path(spark, "passes")
        ingest.store_batch(pitches.pitch_rows(spark.createDataFrame(early, SCHEMA)), 0, path, 4)
        before = len(stored_plans)
        for _ in range(2):  # the second is a replay
            ingest.store_batch(pitches.pitch_rows(spark.createDataFrame(rows, SCHEMA)), 1, path, 4)
        assert len(stored_plans) - before == 2 * passes
        store = ingest.read_store(spark, path).collect()
        found.append(sorted(((r.game_pk, r.at_bat_number, r.pitch_number, r.batter, r.batch) for r in store), key=str))
    known = [(i, 2, 1) for i in range(0, 60, 3)]
    new = [k for k in ((i, i % 4, 1) for i in range(60)) if k not in known]
    keyless = [(i, 1, None, 7, 1) for i in range(10)]
    expected = sorted([(*k, 7, 0) for k in known] + [(*k, 7, 1) for k in new] + keyless, key=str)
    assert found == [expected, expected]
    assert [ingest._passes(n) for n in (0, 1, 10, 11, 30, 31, 10**9)] == [1, 1, 1, 2, 3, 3, 3]


def test_a_batch_is_shuffled_once_and_its_shuffle_goes_with_it(spark, stored_plans):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def shuffles():
        return {f.split("_")[1] for d in folders for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}

    path, before = fresh_path(spark, "once"), shuffles()
    for number in range(2):
        rows = spark.createDataFrame([pitch(float(i + number)) for i in range(50)] + [pitch(NAN)], SCHEMA)
        ingest.store_batch(pitches.pitch_rows(rows), number, path, 6)
    for plan in stored_plans:
        assert plan.count("Exchange (") == 1 and "LeftAnti" in plan, plan
    until = time.time() + 20
    while len(shuffles() - before) > 2 and time.time() < until:
        time.sleep(0.2)
    assert len(shuffles() - before) <= 2  # the count of each batch
    assert ingest.read_store(spark, path).count() == 53
