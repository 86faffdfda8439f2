"""Append, replace, view and export."""

from __future__ import annotations

from contextlib import AbstractContextManager

from pyspark.sql import DataFrame, SparkSession

from sabermill.session import settings

# A task keeps up to so many files open at once, each with a row group of this size in memory.
OPEN_FILES, ROW_GROUP = 32, 16 << 20


def many_files(spark: SparkSession) -> AbstractContextManager[None]:
    """Tasks keep a file open for each partition that they meet, instead of sorting their rows by partition.

    Rows beyond ``OPEN_FILES`` partitions of a task are sorted as before.
    """
    return settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES)})


def write_unsorted(df: DataFrame, path: str, mode: str, partition_by: str) -> None:
    """Write partitions without a shuffle or a sort."""
    with many_files(df.sparkSession):
        written = df.write.mode(mode).partitionBy(partition_by)
        written.option("parquet.block.size", ROW_GROUP).parquet(path)


def append(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Add rows; a rerun adds them again, as a plain insert does.

    Each task writes the rows it has into a file for each partition it meets, so rows are neither shuffled
    nor sorted: nothing but the table itself takes disk, and a partition that holds much of the
    data lies with as many tasks as its rows come from.
    """
    if partition_by is None:
        df.write.mode("append").parquet(path)
        return
    write_unsorted(df, path, "append", partition_by)


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Create or replace a stored table and read it back; ``path`` must not feed ``df``."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def replace_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def export_tables(tables: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """Write each table whole into its own folder; returns where each one went."""
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{folder}/{name}"
        df.write.mode("overwrite").parquet(paths[name])
    return paths


def read_tables(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(path) for name, path in paths.items()}
