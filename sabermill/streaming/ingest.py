"""Incremental ingest of landed pitch files.

Each landed file is read once, however often the ingest runs; the checkpoint remembers them.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamReader

from sabermill.operators.merge import LOADED_AT
from sabermill.operators.sinks import ROW_GROUP, many_files, write_unsorted
from sabermill.schemas import PITCH_KEY, raw_schema
from sabermill.session import one_use, settings, spread_out
from sabermill.sources.pitches import pitch_rows

SEASON = "game_year"
BATCH = "batch"
# Folders of a keyed store: pitches with a full key, by buckets of it, and those without.
KEYED, KEYLESS, BUCKETS = "keyed", "keyless", "_buckets"
FIRST_BY = ["game_date", "batter", "pitcher"]
# A season of a streamed batch is written by up to so many tasks, into as many files.
SPREAD = 8
# A keyed batch is stored so many rows at a time, or in the most passes. Passes read a batch so often, so they are few.
ROWS_AT_ONCE, MOST_PASSES = 32_000_000, 16


def landed_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    file_format: str = "parquet",
    files_per_batch: int | None = None,
    **options: str,
) -> DataFrame:
    reader: DataStreamReader = spark.readStream.schema(schema).format(file_format)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.options(**options).load(folder)


def append_stream(pitches: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append coerced pitches once per landed file; the file sink commits each batch once."""
    spread = F.pmod("at_bat_number", F.lit(SPREAD))
    return (
        pitch_rows(pitches)
        .repartition(SEASON, spread)
        .writeStream.format("parquet")
        .partitionBy(SEASON)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(path)
    )


def _has_key() -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in PITCH_KEY])


def unseen(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of the batch whose pitch is not stored yet, one per pitch; all have a full key.

    Of repeats the one that comes first by all its columns stays, so a replay stores the same
    rows in whatever order they arrive. Each task keeps one row of a key before the shuffle, so a
    pitch that is repeated very often is no hot key. The batch is read once.
    """
    first = [c for c in FIRST_BY if c in batch.columns]
    rest = [c for c in batch.columns if c not in (*PITCH_KEY, *first, LOADED_AT)]
    nth = F.row_number().over(W.partitionBy(*PITCH_KEY).orderBy(*first, *rest))
    once = batch.withColumn("_nth", nth).where("_nth = 1").drop("_nth")
    return once.join(stored.select(*PITCH_KEY), PITCH_KEY, "left_anti").select(*batch.columns)


def _stored_columns(rows: T.StructType) -> T.StructType:
    return T.StructType([*rows, T.StructField(BATCH, T.LongType())])


def _folder(spark: SparkSession, path: str, rows: T.StructType) -> T.StructType:
    """Make a folder of the store where there is none yet; returns its columns."""
    empty = spark.createDataFrame([], _stored_columns(rows))
    empty.write.mode("ignore").partitionBy(BATCH, SEASON).parquet(path)
    return empty.schema


def _buckets(spark: SparkSession, path: str, buckets: int) -> int:
    """How many buckets the store has, fixed when it is created."""
    spark.range(1).selectExpr(f"'{buckets}'").coalesce(1).write.mode("ignore").text(f"{path}/{BUCKETS}")
    return int(spark.read.text(f"{path}/{BUCKETS}").first()[0])


def store_table(spark: SparkSession, path: str, rows: T.StructType, buckets: int = 64) -> DataFrame:
    """Stored pitches with a full key, in buckets of it: a join by key reads them without a shuffle.

    The catalog's entry only tells how the files lie; they are listed anew for each batch, so an
    application with another catalog goes on with the same store.
    """
    buckets = _buckets(spark, path, buckets)
    name = f"pitch_store_{hashlib.md5(path.encode()).hexdigest()}"
    if not spark.catalog.tableExists(name):
        stored = _folder(spark, f"{path}/{KEYED}", rows)
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stored)
        listed = "spark.sql.hive.manageFilesourcePartitions"
        before = spark.conf.get(listed)
        spark.conf.set(listed, "false")
        try:
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
                f"PARTITIONED BY ({BATCH}, {SEASON}) CLUSTERED BY ({', '.join(PITCH_KEY)}) "
                f"INTO {buckets} BUCKETS LOCATION '{path}/{KEYED}'"
            )
        finally:
            spark.conf.set(listed, before)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def _passes(rows: int) -> int:
    return min(max(1, -(-rows // ROWS_AT_ONCE)), MOST_PASSES)


def store_batch(batch: DataFrame, batch_id: int, path: str, buckets: int = 64) -> None:
    """Add the pitches of a batch that the store at ``path`` lacks; a replay replaces what it added.

    All seasons of the store are searched, as a repeat may come with another season or with none, but
    only games between the smallest and the largest of the batch: Parquet skips the others. A large batch is
    stored in passes, each over a share of its keys, so that only a share of its rows lies shuffled and sorted
    on the executors' disks. Each pass reads the batch again, but parses only its own rows whole.
    """
    spark = batch.sparkSession
    table = store_table(spark, path, batch.schema, buckets)
    buckets = _buckets(spark, path, buckets)
    keyed = batch.where(_has_key())
    # Reads the key and what makes a row complete; a batch that is kept for its rows would fill the executors' disks.
    games = F.col(PITCH_KEY[0])
    n, *span = keyed.agg(F.count(F.lit(1)), F.min(games), F.max(games)).first()
    stored = table.where((F.col(BATCH) < batch_id) & games.between(*[F.lit(g) for g in span]))
    passes = _passes(n)
    own = f"pitch_batch_{uuid.uuid4().hex}"
    for number in range(passes):
        share = F.pmod(F.xxhash64(*PITCH_KEY), F.lit(passes)) == number if passes > 1 else F.lit(True)
        fresh = unseen(keyed.where(share), stored.where(share))
        # As many tasks as buckets: rows are shuffled once, the store isn't, and a bucket and season has one file of a pass.
        with settings(spark, one_use(buckets)), many_files(spark):
            written = fresh.write.mode("append" if number else "overwrite").option("parquet.block.size", ROW_GROUP)
            written = written.partitionBy(SEASON).bucketBy(buckets, *PITCH_KEY)
            written.saveAsTable(own, path=f"{path}/{KEYED}/{BATCH}={batch_id}")
    spark.sql(f"DROP TABLE {own}")  # the files stay, as buckets of the store
    with settings(spark, one_use()):
        write_unsorted(batch.where(~_has_key()), f"{path}/{KEYLESS}/{BATCH}={batch_id}", "overwrite", SEASON)


def keyed_stream(pitches: DataFrame, path: str, buckets: int = 64) -> StreamingQuery:
    """Append only pitches that are not stored yet, however late or often they land.

    The store itself is the memory, so no state grows with the stream and no late row is lost to
    a watermark. Every batch has folders of its own that a replay overwrites, so a batch that
    failed half-way counts once; the checkpoint lives in the store, as batch numbers belong to it.
    Pitches without a full natural key cannot be compared: all stay, apart from the others, dealt
    by their content. Inside a batch rows lie by season.
    """

    def store(landed: DataFrame, number: int) -> None:
        # Parsing is the dearest step: a double becomes a decimal by way of its digits, in 50 columns.
        store_batch(pitch_rows(spread_out(landed)), number, path, buckets)

    return (
        pitches.writeStream.foreachBatch(store)
        .option("checkpointLocation", f"{path}/_checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """A keyed store, its batch beside the pitch columns."""
    columns = raw_schema("statcast")
    parts = []
    for folder in (KEYED, KEYLESS):
        layout = _folder(spark, f"{path}/{folder}", columns)
        stored = spark.read.schema(layout).parquet(f"{path}/{folder}")
        parts.append(stored.select(*columns.names, BATCH))
    return parts[0].union(parts[1])


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """What ``append_stream`` has stored."""
    return spark.read.schema(raw_schema("statcast")).parquet(path)
