"""Several rows out of one input row in a single scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def views_of_each_row(df: DataFrame, keep: list[str], views: list[dict[str, Column]]) -> DataFrame:
    """One output row per view: the kept columns and the view's own named columns.

    Reads the input once, where a union of projections would read it once per view.
    """
    names = list(views[0])
    variants = F.array(*[F.struct(*[v[n].alias(n) for n in names]) for v in views])
    return df.select(*keep, F.inline(variants))
