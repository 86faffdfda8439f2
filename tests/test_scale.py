"""What keeps figures from growing faster than the input."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from harness import adapter, fillers, payloads, registry
from sabermill.operators import sinks
from sabermill.operators.merge import merge
from sabermill.schemas import PITCH_KEY
from sabermill.session import SETTINGS, TUNED, fresh_path
from sabermill.sources.pitches import pitch_rows
from sabermill.streaming import documents, ingest


def test_queries_tune_a_session_made_elsewhere(spark):
    before = {key: spark.conf.get(key) for key in TUNED}
    try:
        for key in TUNED:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
        registry.queries()["S13_coerce_pitches_rest"](spark, "/root/testdata/sf0.001")
        assert {key: spark.conf.get(key) for key in TUNED} == {key: SETTINGS[key] for key in TUNED}
        assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_line_makes_its_statistics_once(spark):
    spark.conf.set("spark.sql.maxPlanStringLength", str(1 << 24))
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    plan = _plan(payloads.hitting_rest(spark, "/root/testdata/sf0.001"))
    decimals = [c for c in payloads.HITTING_REST if payloads.places_of("batting_stats")[c]]
    assert plan.count("lpad(") == len(decimals)


def test_filled_in_pitch_values_are_not_divided(spark):
    lines = adapter.table(spark, "/root/testdata/sf0.001", "lineitem")
    kinds = [c for c, kind in fillers.KINDS.items() if kind[0] == "d"]
    values = lines.select("l_partkey", *[fillers.value(c).alias(c) for c in kinds])
    assert "/" not in _plan(values).split("Relation")[0]
    for row in values.limit(50).collect():
        for c in kinds:
            n, places = (row.l_partkey * 3 + fillers.NUMBERS[c]) % 300, int(fillers.KINDS[c][1:])
            assert row[c] == Decimal(n).scaleb(-places)


def test_a_merge_ordered_by_its_rows_shuffles_them_once(spark):
    target = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "k long, v string, n int")
    rows = spark.createDataFrame([(1, "x", None), (1, "y", 7), (3, "z", 8), (None, "w", 9), (None, "w", 9)], "k int, v string, n int")
    batch = rows.withColumn("seq", F.struct("k", "n", "v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = merge(target, batch, ["k"], "seq", ["v"], order_is_row=True)
        text = got._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange hashpartitioning") == 2 and "max_by" not in text
        plain = merge(target, batch, ["k"], "seq", ["v"])
        expected = [(1, "y", 5), (2, "b", 6), (3, "z", 8), (None, "w", 9), (None, "w", 9)]
        for result in (got, plain):
            assert sorted((tuple(r) for r in result.collect()), key=str) == sorted(expected, key=str)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_landed_texts_of_a_stream_are_compressed(spark):
    folder = registry.streamed(spark, "/root/testdata/sf0.001")
    files = {r.file for r in documents.read_rejects(spark, folder).collect()}
    assert files and all(f.endswith(".gz") for f in files)


def test_a_batch_of_pitches_is_not_cached(spark, monkeypatch):
    monkeypatch.setattr(type(spark.range(1)), "persist", lambda *a: pytest.fail("cached"))
    lines = adapter.table(spark, "/root/testdata/sf0.001", "lineitem").limit(40)
    rows = pitch_rows(payloads.landed_pitches(lines))
    path = fresh_path(spark, "uncached")
    ingest.store_batch(rows, 0, path, 2)
    assert ingest.read_store(spark, path).count() == rows.dropDuplicates(PITCH_KEY).count()


def _plan_of_last_write(spark):
    done = spark._jsparkSession.sharedState().statusStore().executionsList()
    return done.last().physicalPlanDescription()


def test_an_append_neither_shuffles_nor_sorts_its_rows(spark):
    rows = spark.range(4000, numPartitions=4).withColumn("season", F.when(F.col("id") % 5 != 0, F.col("id") % 3))
    path = fresh_path(spark, "appended")
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    for _ in range(2):
        sinks.append(rows, path, "season")
        plan = _plan_of_last_write(spark)
        assert "InsertIntoHadoopFsRelation" in plan and "Exchange" not in plan and "Sort" not in plan
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    stored = spark.read.parquet(path)
    expected = sorted([(r.id, r.season) for r in rows.collect()] * 2, key=str)
    assert sorted([(r.id, r.season) for r in stored.collect()], key=str) == expected


def test_an_append_to_more_partitions_than_a_task_has_files_open(spark):
    rows = spark.range(3000, numPartitions=2).withColumn("day", F.col("id") % (3 * sinks.OPEN_FILES))
    path = fresh_path(spark, "days")
    sinks.append(rows, path, "day")
    assert sorted((r.id, r.day) for r in spark.read.parquet(path).collect()) == [(r.id, r.day) for r in rows.collect()]
