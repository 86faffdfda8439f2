"""Data-quality checks: each gives rows of (check, table_name, column_name, violations)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def _verdict(check: str, table: str, column: str, violations: Column) -> list[Column]:
    return [
        F.lit(check).alias("check"),
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.coalesce(violations, F.lit(0)).cast("long").alias("violations"),
    ]


def together(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


@dataclass(frozen=True)
class Measure:
    """A check over the rows of a table: aggregates, and the violations that follow from them."""

    check: str
    column: str
    aggregates: tuple[Column, ...]
    violations: Callable[..., Column]


def one_pass(df: DataFrame, table: str, measures: list[Measure]) -> DataFrame:
    """Any number of checks over one table in one scan."""
    parts, rows = [], []
    for m in measures:
        names = [f"m{len(parts) + i}" for i in range(len(m.aggregates))]
        parts += [a.alias(n) for a, n in zip(m.aggregates, names, strict=True)]
        bad = m.violations(*[F.col(n) for n in names])
        rows.append(F.struct(*_verdict(m.check, table, m.column, bad)))
    return df.agg(*parts).select(F.inline(F.array(*rows)))


def rule_measures(rules: dict[tuple[str, str], Column]) -> list[Measure]:
    """Per-row rules; ``rules`` maps (check, column) to what must not hold."""
    return [
        Measure(check, column, (F.count_if(bad),), lambda n: n)
        for (check, column), bad in rules.items()
    ]


def row_rules(df: DataFrame, table: str, rules: dict[tuple[str, str], Column]) -> DataFrame:
    return one_pass(df, table, rule_measures(rules))


def missing(column: str) -> Column:
    return F.col(column).isNull()


def not_in(column: str, values: list[str]) -> Column:
    """NULL is not a violation."""
    return ~F.col(column).isin(values)


def outside(column: str, low=None, high=None) -> Column:
    value, bad = F.col(column), F.lit(False)
    if low is not None:
        bad = bad | (value < low)
    if high is not None:
        bad = bad | (value > high)
    return bad


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """How many values occur more than once; repeats combine before the shuffle."""
    repeated = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )
    return repeated.agg(F.count(F.lit(1)).alias("n")).select(
        *_verdict("unique", table, column, F.col("n"))
    )


def related(
    child: DataFrame,
    table: str,
    column: str,
    parent: DataFrame,
    parent_column: str,
    check: str = "relationships",
) -> DataFrame:
    """Child rows whose key is in no parent row; NULL keys do not count.

    Children are counted per key first, so a hot key costs one row in the join.
    """
    keys = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("_key"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = parent.select(F.col(parent_column).alias("_key"))
    return (
        keys.join(known, "_key", "left_anti")
        .agg(F.sum("n").alias("n"))
        .select(*_verdict(check, table, column, F.col("n")))
    )


def related_all(
    child: DataFrame, table: str, columns: list[str], parent: DataFrame, parent_column: str
) -> DataFrame:
    """Child rows where any of several keys is missing from the parent, each row once."""
    combos = child.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    for i, column in enumerate(columns):
        known = parent.select(
            F.col(parent_column).alias(column), F.lit(True).alias(f"_known{i}")
        ).distinct()
        combos = combos.join(known, column, "left")
    orphan = reduce(Column.__or__, [F.col(f"_known{i}").isNull() for i in range(len(columns))])
    return (
        combos.where(orphan)
        .agg(F.sum("n").alias("n"))
        .select(*_verdict("relationships", table, ", ".join(columns), F.col("n")))
    )


def groups_break(
    df: DataFrame, table: str, key: str, measures: dict[str, Column], rules: dict[str, Column]
) -> DataFrame:
    """How many groups break each rule over their aggregates."""
    grouped = df.groupBy(key).agg(*[value.alias(name) for name, value in measures.items()])
    return row_rules(grouped, table, {(check, key): bad for check, bad in rules.items()})


def size_measures(minimum: int) -> list[Measure]:
    """By how many rows the table falls short."""
    return [
        Measure(
            f"at_least_{minimum}_rows",
            "",
            (F.count(F.lit(1)),),
            lambda n: F.greatest(F.lit(minimum) - n, F.lit(0)),
        )
    ]


def few_rows(df: DataFrame, table: str, minimum: int) -> DataFrame:
    return one_pass(df, table, size_measures(minimum))


def same_size(tables: dict[str, DataFrame]) -> DataFrame:
    """By how many rows the largest and the smallest of the tables differ."""
    counts = together([df.agg(F.count(F.lit(1)).alias("n")) for df in tables.values()])
    gap = (F.max("n") - F.min("n")).alias("gap")
    return counts.agg(gap).select(
        *_verdict("same_row_count", " = ".join(tables), "", F.col("gap"))
    )


def share_measures(ceilings: dict[str, str]) -> list[Measure]:
    """One violation per column whose share of NULLs reaches its ceiling."""

    def reached(limit: str) -> Callable[..., Column]:
        share = F.lit(limit).cast("decimal(3,2)")
        return lambda total, filled: F.when(
            (total > 0) & (total - filled >= share * total), 1
        ).otherwise(0)

    return [
        Measure(f"null_share_below_{limit}", c, (F.count(F.lit(1)), F.count(c)), reached(limit))
        for c, limit in ceilings.items()
    ]


def null_share(df: DataFrame, table: str, ceilings: dict[str, str]) -> DataFrame:
    return one_pass(df, table, share_measures(ceilings))


def distinct_key(df: DataFrame, table: str, column: str) -> DataFrame:
    """Rows minus distinct keys."""
    per_key = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    totals = per_key.agg(F.sum("n").alias("total"), F.count(column).alias("keys"))
    return totals.select(
        *_verdict("rows_equal_keys", table, column, F.col("total") - F.col("keys"))
    )
