from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sabermill.operators import merge as m
from sabermill.operators import sinks
from sabermill.schemas import DEFAULTS, KEYS, raw_schema
from sabermill.session import fresh_path
from sabermill.sources import tables

OLD = datetime(2020, 1, 1)
SCHEMA = "k int, name string, note string, sport int, loaded_at timestamp"


@pytest.fixture
def target(spark):
    return spark.createDataFrame(
        [(1, "one", "keep", 7, OLD), (2, "two", None, 8, OLD), (None, "none", "x", 9, OLD)], SCHEMA
    )


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), "seq int, k int, name string")


def test_upsert_overwrites_carried_columns_and_takes_the_last_row(spark, target, rows):
    new = batch(spark, (0, 1, "first"), (1, 1, "last"), (2, 3, "new"), (3, None, "n1"),
                (4, None, "n1"))
    merged = m.merge(target, new, ["k"], "seq", defaults={"sport": 1})
    assert rows(merged, "k", "name", "note", "sport") == [
        (1, "last", "keep", 7),
        (2, "two", None, 8),
        (3, "new", None, 1),
        (None, "n1", None, 1),
        (None, "n1", None, 1),
        (None, "none", "x", 9),
    ]
    stamped = {r.k: r.loaded_at > OLD for r in merged.where("k is not null").collect()}
    assert stamped == {1: True, 2: False, 3: True}


def test_a_null_in_the_batch_overwrites(spark, target, rows):
    merged = m.merge(target, batch(spark, (0, 1, None)), ["k"], "seq")
    assert (1, None) in rows(merged, "k", "name")


def test_upsert_twice_is_upsert_once(spark, target, rows):
    new = batch(spark, (0, 1, "x"), (1, 5, "y"))
    once = m.merge(target, new, ["k"], "seq")
    twice = m.merge(once, new, ["k"], "seq")
    shown = ["k", "name", "note", "sport"]
    assert rows(once, *shown) == rows(twice, *shown)


def test_partial_update_inserts_first_row_and_updates_from_last(spark, rows):
    target = spark.createDataFrame([(1, "a", "n")], "k int, name string, note string")
    new = spark.createDataFrame(
        [(0, 1, "b", "x"), (1, 1, "c", "y"), (0, 2, "d", "z"), (1, 2, "e", "w")],
        "seq int, k int, name string, note string",
    )
    merged = m.merge(target, new, ["k"], "seq", update_columns=["note"])
    assert rows(merged) == [(1, "a", "y"), (2, "d", "w")]


def test_nothing_to_update_keeps_existing_rows(spark, target, rows):
    merged = m.add_missing(target, batch(spark, (0, 1, "x"), (1, 4, "p"), (2, 4, "q")), ["k"], "seq")
    assert rows(merged, "k", "name") == [(1, "one"), (2, "two"), (4, "p"), (None, "none")]
    assert {r.k: r.loaded_at > OLD for r in merged.collect()}[1] is False


def test_published_versions_swap_behind_the_view(spark, rows):
    first = spark.createDataFrame([(1, "a")], "k int, name string")
    m.publish(first, "team_names", fresh_path(spark, "v"))
    m.upsert_view(spark, "team_names", fresh_path(spark, "v"),
                  batch(spark, (0, 1, "b"), (1, 2, "c")), ["k"], "seq")
    assert rows(spark.table("team_names")) == [(1, "b"), (2, "c")]
    assert rows(spark.newSession().table("team_names")) == [(1, "b"), (2, "c")]


def test_seed_updates_known_teams_and_adds_the_rest(spark):
    schema = raw_schema("teams")
    known = {f.name: None for f in schema}
    known |= {"team_id": 110, "name": "old", "abbreviation": "OLD", "venue_name": "park",
              "sport_id": 5, "active": False, "loaded_at": OLD}
    teams = tables.seed_teams(spark.createDataFrame([known], schema))
    assert teams.count() == 30
    row = teams.where("team_id = 110").first()
    assert (row.name, row.venue_name, row.sport_id, row.active) == (
        "Baltimore Orioles", "park", 5, True,
    )
    new = teams.where("team_id = 137").first()
    assert (new.division_name, new.sport_id) == ("NL West", 1)
    assert KEYS["teams"] == ["team_id"] and DEFAULTS["teams"]["sport_id"] == 1


def test_append_adds_rows_again_and_replace_does_not(spark):
    df = spark.range(6).select("id", (F.col("id") % 2).alias("season"))
    path = fresh_path(spark, "append")
    sinks.append(df, path, "season")
    sinks.append(df, path, "season")
    assert spark.read.parquet(path).count() == 12
    path = fresh_path(spark, "replace")
    sinks.replace_table(df, path)
    assert sinks.replace_table(df, path).count() == 6


def test_columns_the_table_lacks_are_an_error(spark, target):
    with pytest.raises(ValueError, match="no column vv"):
        m.merge(target, spark.createDataFrame([(0, 1, 2)], "seq int, k int, vv int"), ["k"], "seq")
    with pytest.raises(ValueError, match="batch has no column k"):
        m.merge(target, spark.createDataFrame([(0, "x")], "seq int, name string"), ["k"], "seq")


def test_each_input_is_read_once(spark, target):
    at = fresh_path(spark, "merge-target")
    target.write.parquet(f"{at}/t")
    batch(spark, (0, 1, "x"), (1, None, "y")).write.parquet(f"{at}/b")
    merged = m.merge(spark.read.parquet(f"{at}/t"), spark.read.parquet(f"{at}/b"), ["k"], "seq")
    assert merged._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2
