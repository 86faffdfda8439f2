"""Keyed merge of a batch into a table, for storage without a MERGE statement.

Rules, in the order the batch rows are numbered: a row whose key exists overwrites the chosen
columns that the batch carries; a new key inserts the row, with defaults for columns the batch
lacks. Rows with a NULL in the key never match anything and are all inserted. A batch column that
the table lacks is an error, as it would be for an INSERT that names its columns.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

LOADED_AT = "loaded_at"
# Tells rows without a full key apart: 0 for rows with one, else a number of the row's own.
ALONE = "_alone"


def collapse(batch: DataFrame, keys: list[str], update: list[str], order: str, order_is_row: bool = False) -> DataFrame:
    """One row per key: inserted columns from the first row, updated ones from the last.

    First and last are aggregates, so the rows of a hot key combine before the shuffle. Where ``order``
    is a struct of the row's own columns it is all that is shuffled, rather than the row beside it.
    """
    keys = [*keys, *([ALONE] if ALONE in batch.columns else [])]
    carried = [c for c in batch.columns if c not in (*keys, order)]
    inserted = [c for c in carried if c not in update]
    picks = []
    if inserted:
        first = F.min(order) if order_is_row else F.min_by(F.struct(*inserted), order)
        picks.append(first.alias("_first"))
    if update:
        last = F.max(order) if order_is_row else F.max_by(F.struct(*update), order)
        picks.append(last.alias("_last"))
    grouped = batch.groupBy(*keys)
    merged = grouped.agg(*picks) if picks else grouped.agg(F.lit(1).alias("_one"))
    source = {**{c: "_first" for c in inserted}, **{c: "_last" for c in update}}
    return merged.select(*keys, *[F.col(f"{source[c]}.{c}").alias(c) for c in carried])


def merge(
    target: DataFrame,
    batch: DataFrame,
    keys: list[str],
    order: str,
    update_columns: list[str] | None = None,
    defaults: dict | None = None,
    order_is_row: bool = False,
) -> DataFrame:
    """The table after the batch; ``order`` numbers the batch rows and is not stored.

    ``update_columns`` defaults to every non-key column of the batch; an empty list keeps
    existing rows as they are. ``order_is_row`` says that ``order`` is a struct of all columns of the
    batch under their names.
    """
    defaults = defaults or {}
    unknown = [c for c in batch.columns if c not in (*target.columns, order)]
    if unknown:
        raise ValueError(f"the table has no column {', '.join(unknown)}")
    carried = [c for c in batch.columns if c not in (*keys, order, LOADED_AT)]
    update = carried if update_columns is None else update_columns
    if missing := [c for c in (*keys, *update) if c not in batch.columns]:
        raise ValueError(f"the batch has no column {', '.join(missing)}")

    # Rows without a full key match nothing, and would all meet in one task on their NULLs: they
    # get a join key of their own, negative in the table and positive in the batch, and so both
    # inputs are read once.
    has_key = reduce(and_, [F.col(k).isNotNull() for k in keys])

    def alone(sign: int) -> Column:
        own = (F.monotonically_increasing_id() + 1) * sign
        return F.when(has_key, F.lit(0).cast("bigint")).otherwise(own).alias(ALONE)

    # Keys as wide as the table's from the start: rows grouped by them lie as the join needs them.
    kinds = {k: target.schema[k].dataType for k in keys}
    whole = (T.ByteType, T.ShortType, T.IntegerType)
    wide = [
        F.col(k).cast(kinds[k]).alias(k)
        if isinstance(kinds[k], T.LongType) and isinstance(batch.schema[k].dataType, whole) else F.col(k)
        for k in keys
    ]
    by_key = collapse(batch.select(*wide, *carried, order, alone(1)), keys, update, order, order_is_row)

    def inserted(name: str, kind, value):
        if name == LOADED_AT:
            return F.current_timestamp().cast(kind)
        if name in by_key.columns:
            return F.col(value).cast(kind)
        return F.lit(defaults.get(name)).cast(kind)

    overwritten = {*update, LOADED_AT} if update else set()
    new_row, matched = F.col("_old").isNull(), F.col("_new").isNotNull()
    columns = [
        F.when(
            new_row | matched if f.name in overwritten else new_row,
            inserted(f.name, f.dataType, f"_new.{f.name}"),
        )
        .otherwise(F.col(f"_old.{f.name}"))
        .alias(f.name)
        for f in target.schema
    ]
    joined = [*keys, ALONE]
    old = target.select(*keys, alone(-1), F.struct(*target.columns).alias("_old"))
    new = by_key.select(*joined, F.struct(*[c for c in by_key.columns if c != ALONE]).alias("_new"))
    return old.join(new, joined, "full_outer").select(*columns)


def add_missing(target: DataFrame, batch: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Insert rows with new keys and leave existing ones alone."""
    return merge(target, batch, keys, order, update_columns=[])


def publish(df: DataFrame, view: str, path: str) -> DataFrame:
    """Write a new version of a table to its own ``path``, then point the catalog view at it.

    The version being read is never overwritten, a failed write leaves the view as it was, and
    every session of the catalog sees the new version at once.
    """
    df.write.mode("errorifexists").parquet(path)
    spark = df.sparkSession
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM parquet.`{path}`")
    return spark.table(view)


def upsert_view(
    spark: SparkSession,
    view: str,
    path: str,
    batch: DataFrame,
    keys: list[str],
    order: str,
    **options,
) -> DataFrame:
    """Merge a batch into the table behind ``view`` and publish the result at ``path``."""
    merged = merge(spark.table(view), batch, keys, order, **options)
    return publish(merged, view, path)
