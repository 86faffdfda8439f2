"""Keep one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The row that comes first by ``order``, which should be unique within a key.

    An aggregate rather than a numbered window: rows of a hot key combine before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(first).select(*keys, "_row.*").select(*df.columns)
