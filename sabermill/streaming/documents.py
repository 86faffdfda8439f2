"""Incremental load of landed documents into a versioned raw table.

Each landed file is read once, however often the load runs: the checkpoint in the store remembers
the files, and the version that a batch commits remembers the batch. So a batch that failed
half-way or is run again counts once, and a document that lands again under another name
overwrites its rows with the same values. What can't be stored lies in a table of rejects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from sabermill.plans import loads
from sabermill.schemas import KEYS, raw_schema
from sabermill.sources import landing
from sabermill.sources.versions import VersionedTable

BATCH = "batch"
TABLE, PARSED, REJECTS, COUNTS, CHECKPOINT = "table", "parsed", "rejects", "counts", "_checkpoint"
REJECT_COLUMNS = f"reason string, file string, content string, {BATCH} bigint"
COUNT_COLUMNS = f"documents bigint, unreadable bigint, rows bigint, incomplete bigint, kept bigint, {BATCH} bigint"


def document_stream(
    spark: SparkSession, folder: str, files_per_batch: int | None = None, one_per_file: bool = True
) -> DataFrame:
    """Landed documents as text with their file: one document per file, or one per line."""
    reader = spark.readStream.format("text").option("wholetext", one_per_file)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    files = reader.load(folder)
    return files.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("document"))


def open_table(spark: SparkSession, folder: str, table: str) -> VersionedTable:
    """The raw table of a store, made empty where there is none; its files are ranges of the key."""
    stored = VersionedTable(spark, f"{folder}/{TABLE}")
    if not stored.pointer.number():
        empty = spark.createDataFrame([], raw_schema(table))
        return VersionedTable.create(stored.folder, empty, KEYS[table])
    return stored


def store_documents(
    documents: DataFrame, number: int, table: str, folder: str, rosters: DataFrame | None = None
) -> bool:
    """Merge a batch of documents; False, and nothing done, if a batch of this number is stored.

    The batch is parsed once, into a folder that the next batch overwrites. Rejects and counts lie in
    folders of the batch's own, which a replay overwrites; the commit of the table is the last step.
    """
    spark, name = documents.sparkSession, f"batch {number}"
    stored = open_table(spark, folder, table)
    if name in stored.state()[1]["done"]:
        return False
    payload = landing.parse_documents(documents, "document", loads.SOURCES[table][0])
    payload.write.mode("overwrite").parquet(f"{folder}/{PARSED}")
    parsed = spark.read.schema(payload.schema).parquet(f"{folder}/{PARSED}")
    found = loads.extract(parsed, table, rosters)
    unreadable = found.unreadable.select(F.lit("unreadable").alias("reason"), "file", F.col("document").alias("content"))
    # A row that lacks a required value no longer knows its file; its other values tell where it is from.
    row = F.to_json(F.struct(*found.incomplete.columns))
    incomplete = found.incomplete.select(F.lit("incomplete"), F.lit(None).cast("string"), row)
    unreadable.union(incomplete).write.mode("overwrite").parquet(f"{folder}/{REJECTS}/{BATCH}={number}")
    found.counts.write.mode("overwrite").parquet(f"{folder}/{COUNTS}/{BATCH}={number}")
    return stored.merge(found.rows, load=name, **loads.merge_options(found.rows, table))


def load_stream(
    documents: DataFrame, table: str, folder: str, rosters: DataFrame | None = None
) -> StreamingQuery:
    """Load what has landed since the last run; a later batch overwrites rows of an earlier one."""

    def store(landed: DataFrame, number: int) -> None:
        store_documents(landed, number, table, folder, rosters)

    return (
        documents.writeStream.foreachBatch(store)
        .option("checkpointLocation", f"{folder}/{CHECKPOINT}")
        .trigger(availableNow=True)
        .start()
    )


def _read(spark: SparkSession, folder: str, columns: str) -> DataFrame:
    spark.createDataFrame([], columns).write.mode("ignore").partitionBy(BATCH).parquet(folder)
    return spark.read.schema(columns).parquet(folder)


def read_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that could not be read and rows that lack a required value, with their batch."""
    return _read(spark, f"{folder}/{REJECTS}", REJECT_COLUMNS)


def read_counts(spark: SparkSession, folder: str) -> DataFrame:
    """One row per batch: documents read and unreadable, rows flattened, incomplete and kept."""
    return _read(spark, f"{folder}/{COUNTS}", COUNT_COLUMNS)
