from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from sabermill.operators.merge import merge
from sabermill.session import fresh_path
from sabermill.sources.versions import VersionedTable, export_version, load_chunks, read_export

SCHEMA = "k int, name string, note string"


@pytest.fixture
def table(spark):
    rows = spark.range(1000).select(F.col("id").cast("int").alias("k"), F.lit("old").alias("name"), F.lit(None).cast("string").alias("note"))
    rows = rows.union(spark.createDataFrame([(None, "none", None)], SCHEMA))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        yield VersionedTable.create(fresh_path(spark, "versioned"), rows, ["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), "seq int, k int, name string")


def test_a_merge_equals_the_plain_one_and_rewrites_only_files_with_its_keys(spark, table, rows):
    before = table.state()[1]["files"]
    assert len(before) == 4
    new = batch(spark, (0, 5, "a"), (1, 7, "b"), (2, 5, "c"), (3, 5000, "new"), (4, None, "nokey"))
    want = rows(merge(table.read(), new, ["k"], "seq"))
    old = table.read()
    assert table.merge(new, ["k"], "seq", load="day 1")
    after = table.state()[1]["files"]
    assert len(set(before) & set(after)) == 3  # only the first quarter of the keys was touched
    assert rows(table.read()) == want
    assert not table.merge(new, ["k"], "seq", load="day 1") and rows(table.read()) == want
    # A reader that began before keeps its version, and it can be read by number.
    assert old.where("name = 'old'").count() == 1000 == table.read(1).where("name = 'old'").count()


def test_insert_only_rewrites_nothing(spark, table):
    before = set(table.state()[1]["files"])
    table.merge(batch(spark, (0, 5, "x"), (1, 2000, "y"), (2, 2000, "z"), (3, None, "n")), ["k"], "seq", update_columns=[])
    assert before < set(table.state()[1]["files"])
    got = {r.k: r.name for r in table.read().where("k in (5, 2000)").collect()}
    assert got == {5: "old", 2000: "y"} and table.read().where("k is null").count() == 2


def test_a_failed_write_leaves_the_version_before(spark, table):
    broken = batch(spark, (0, 1, "x")).withColumn("name", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        table.merge(broken, ["k"], "seq", load="bad")
    assert table.state()[0] == 1 and table.read().count() == 1001 and table.state()[1]["done"] == []


def test_two_writers_cannot_commit_the_same_version(spark, table):
    number, state = table.state()
    table.append(batch(spark).select("k", "name", F.lit("n").alias("note")))
    with pytest.raises(Exception, match="(?i)exist"):
        table.pointer.commit(number + 1, state)


def test_chunks_are_loaded_once_resumed_and_reloaded(spark, rows):
    first = date(2024, 3, 28)
    chunks = [(first + timedelta(5 * i), first + timedelta(5 * i + 4)) for i in range(4)]
    days = spark.range(40).select(F.date_add(F.lit(first), (F.col("id") % 20).cast("int")).alias("day"), F.col("id"))
    table = VersionedTable.create(fresh_path(spark, "chunks"), days.limit(0))
    calls = []

    def fetch(start, end):
        calls.append(start)
        if start == chunks[2][0] and len(calls) < 4:
            raise OSError("no answer")
        return days.where(F.col("day").between(F.lit(start), F.lit(end)))

    first_run = load_chunks(table, chunks, fetch, "day")
    assert [o.split(":")[0] for o in first_run.values()] == ["loaded", "loaded", "OSError", "loaded"]
    assert table.read().count() == 30
    assert list(load_chunks(table, chunks, fetch, "day").values()) == ["kept", "kept", "loaded", "kept"]
    assert rows(table.read()) == rows(days)
    # A corrected chunk replaces its own rows and no others; other files are taken over.
    files = set(table.state()[1]["files"])
    fixed = lambda start, end: days.where(F.col("day").between(F.lit(start), F.lit(end))).withColumn("id", F.col("id") + 100)
    load_chunks(table, chunks[1:2], fixed, "day", again=True)
    inside = F.col("day").between(*map(F.lit, chunks[1]))
    assert rows(table.read()) == rows(days.withColumn("id", F.when(inside, F.col("id") + 100).otherwise(F.col("id"))))
    assert files - set(table.state()[1]["files"]) and files & set(table.state()[1]["files"])


def test_an_export_is_seen_whole_or_not_at_all(spark, rows):
    folder = fresh_path(spark, "export")
    a, b = spark.range(3).toDF("x"), spark.createDataFrame([(1, "q")], "y int, z string")
    export_version({"a": a, "b": b}, folder)
    with pytest.raises(Exception, match="broken"):
        export_version({"a": a.limit(1), "b": b.withColumn("z", F.raise_error(F.lit("broken")).cast("string"))}, folder)
    got = read_export(spark, folder)
    assert rows(got["a"]) == [(0,), (1,), (2,)] and rows(got["b"]) == [(1, "q")]
    assert export_version({"a": a.limit(0)}, folder) == 2
    assert read_export(spark, folder)["a"].count() == 0 and read_export(spark, folder, 1)["a"].count() == 3
