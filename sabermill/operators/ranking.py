"""Ranks with gaps, in the metric's own type, without a task that holds a whole group.

A rank is one more than the number of rows with a better value. So the rows of each value are counted
first (repeats combine before the shuffle), and the counts are dealt by ranges of values. Sums run over
the values of a range in one task, and over the totals of a group's ranges in another; both together
are the rank of a value, which is joined to its rows.

A range is a function of the value alone: it needs no sample and no statistics, so a plan stays
lazy, a task that runs again gives the same ranges, and a filter on the group's columns reaches
the sources on every path.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window as W, functions as F

# Ranges for each factor of e, so that values of a range lie within a thousandth of each other.
FINENESS = 1024
# The logarithms of all positive doubles lie within 800 of zero.
_FURTHEST = 800 * FINENESS
_LARGEST = 1.7976931348623157e308


def value_range(value: Column) -> Column:
    """A number that never falls while the value rises; null for a null, and NaN is the largest."""
    near = value.cast("double")
    steps = F.floor(F.ln(F.least(F.abs(near), F.lit(_LARGEST))) * FINENESS) + _FURTHEST
    signed = F.when(near > 0, steps).when(near < 0, -steps).otherwise(F.lit(0).cast("bigint"))
    return F.when(F.isnan(near), F.lit(3 * _FURTHEST).cast("bigint")).when(near.isNotNull(), signed)


def _join(left: DataFrame, right: DataFrame, equal: list[str], null_safe: list[str]) -> DataFrame:
    """``left`` with the other columns of ``right``, which has one row for each key."""
    keys = [*equal, *null_safe]
    own = {k: f"_right_{k}" for k in keys}
    condition = [F.col(k) == F.col(own[k]) for k in equal]
    condition += [F.col(k).eqNullSafe(F.col(own[k])) for k in null_safe]
    return left.join(right.withColumnsRenamed(own), reduce(and_, condition)).drop(*own.values())


def _views(rows: DataFrame, metrics: list[str]) -> Column:
    """One struct for each metric: its number, the range of its value, and the value in a column of its own type."""
    kinds = [rows.schema[m].dataType for m in metrics]
    return F.array(
        *[
            F.struct(
                F.lit(i).alias("_metric"),
                value_range(F.col(metric)).alias("_range"),
                *[
                    (F.col(metric) if i == j else F.lit(None).cast(kinds[j])).alias(f"_value{j}")
                    for j in range(len(metrics))
                ],
            )
            for i, metric in enumerate(metrics)
        ]
    )


def _value_ranks(views: DataFrame, group: list[str], values: list[str]) -> DataFrame:
    """``group``, ``values`` and _rank of every value of every metric.

    The totals of the ranges meet the counts in one window over a range instead of a join: a filter
    on the group passes through it on both sides.
    """
    counts = views.groupBy(*group, "_up", "_range", *values).agg(F.count(F.lit(1)).alias("_n"))
    before = (W.unboundedPreceding, -1)
    towards = F.when(F.col("_up"), F.col("_range")).otherwise(-F.col("_range"))
    counts = counts.withColumn("_range", F.coalesce(towards, F.lit(4 * _FURTHEST)))  # NULLs last
    ahead = F.sum("_total").over(W.partitionBy(*group).orderBy("_range").rowsBetween(*before))
    ranges = counts.groupBy(*group, "_range").agg(F.sum("_n").alias("_total"))
    ranges = ranges.select(*group, "_range", F.coalesce(ahead, F.lit(0)).alias("_ahead"))
    order = [
        best
        for v in values
        for best in (F.when(F.col("_up"), F.col(v)).asc(), F.when(~F.col("_up"), F.col(v)).desc())
    ]
    own = W.partitionBy(*group, "_range")
    inside = F.sum("_n").over(own.orderBy(*order).rowsBetween(*before))
    rank = 1 + F.max("_ahead").over(own) + F.coalesce(inside, F.lit(0))
    both = counts.unionByName(ranges, allowMissingColumns=True)
    both = both.withColumn("_rank", rank.cast("bigint")).where(F.col("_n").isNotNull())
    return both.select(*group, *values, "_rank")


def competition_ranks(
    rows: DataFrame, within: list[str], metrics: dict[str, str], ascending: Column
) -> DataFrame:
    """Add ``rank()`` columns over ``within``, NULL metrics last.

    ``metrics`` maps each new rank column to its metric; ``ascending`` says whether low values
    lead and is the same for all rows of a group. A task holds the distinct values of a range, or
    one number for each range of a group; a value that many rows share is one count, and Spark splits
    the join that brings its rank to its rows. All metrics share one join: a row is taken apart by metric and put
    together again by its content, equal rows counted. Rows with a NULL in ``within`` form groups
    as others do; they are joined null-safely apart from the others, as a filter on a column
    passes through a plain equality only.
    """
    names = list(dict.fromkeys(metrics.values()))
    values = [f"_value{i}" for i in range(len(names))]
    group = [*within, "_metric"]
    have_group = reduce(and_, [F.col(c).isNotNull() for c in within])

    def ranked(part: DataFrame, null_safe: list[str]) -> DataFrame:
        whole = F.struct(*part.columns).alias("_row")
        views = part.select(*within, whole, ascending.alias("_up"), F.inline(_views(part, names)))
        ranks = _value_ranks(views, group, values)
        equal = [c for c in group if c not in null_safe]
        found = _join(views.drop("_up", "_range"), ranks, equal, [*null_safe, *values])
        places = [
            F.max(F.when(F.col("_metric") == names.index(metric), F.col("_rank"))).alias(name)
            for name, metric in metrics.items()
        ]
        again = (F.count(F.lit(1)) / len(names)).cast("int").alias("_times")
        found = found.groupBy(*within, "_row").agg(*places, again)
        once = F.explode(F.sequence(F.lit(1), F.col("_times")))
        return found.withColumn("_once", once).select("_row.*", *metrics)

    return ranked(rows.where(have_group), []).unionByName(ranked(rows.where(~have_group), within))
