"""Inclusive date chunks of a range."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed value: days per chunk.
CHUNK_DAYS = 5


def date_chunks(span: DataFrame, chunk_days: int = CHUNK_DAYS) -> DataFrame:
    """Chunks of the range in columns ``start`` and ``end``; the last one may be shorter."""
    first = F.explode(F.sequence("start", "end", F.make_dt_interval(F.lit(chunk_days))))
    return span.select("start", "end", first.alias("chunk_start")).select(
        chunk_of(F.col("chunk_start"), F.col("start"), chunk_days).alias("chunk_id"),
        "chunk_start",
        F.least(F.date_add("chunk_start", chunk_days - 1), F.col("end")).alias("chunk_end"),
    )


def chunks_between(
    spark: SparkSession, start: date, end: date, chunk_days: int = CHUNK_DAYS
) -> DataFrame:
    span = spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end"))
    return date_chunks(span, chunk_days)


def chunk_of(day: Column, start: Column, chunk_days: int = CHUNK_DAYS) -> Column:
    """The chunk a day falls in, by arithmetic, so tagging rows needs no join."""
    return F.floor(F.date_diff(day, start) / chunk_days).cast("int")


def days_of(chunks: DataFrame) -> DataFrame:
    """Each chunk once per day it holds, so rows meet their chunk in an equality join."""
    days = F.explode(F.sequence("chunk_start", "chunk_end", F.make_dt_interval(F.lit(1))))
    return chunks.select("*", days.alias("day"))
