"""Connected components of links between numbered nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sabermill.llm.tables import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node with a link to another; a component is named by its smallest node.

    In a round every node points to the smallest of its neighbours and itself, pointers are
    followed to their ends by doubling, and the links are drawn between those ends; links inside a
    component are gone. Every node that still has a link is joined with another, so the number of
    nodes at least halves. Pointers and links are written after each step, so a lost executor costs
    one step. A node with very many links is no special case: minima combine before the shuffle,
    and adaptive execution splits the joins.
    """
    total = F.sum(F.col("root").cast("decimal(38,0)"))
    apart = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    links = written(links.where("a <> b").select(*apart).distinct(), "links")
    labels = links.selectExpr("a as node", "a as component").limit(0)
    first = True
    while not links.isEmpty():
        both = links.union(links.select("b", "a")).toDF("node", "other")
        roots = written(both.groupBy("node").agg(F.least("node", F.min("other")).alias("root")), "roots")
        before = roots.agg(total).first()[0]
        while True:
            ends = roots.join(roots.toDF("root", "end"), "root").select("node", F.col("end").alias("root"))
            ends = written(ends, "roots")
            now = ends.agg(total).first()[0]
            if now == before:
                break
            roots, before = ends, now
        if first:
            labels, first = roots.toDF("node", "component"), False
        else:
            further = labels.join(roots.toDF("component", "root"), "component", "left")
            labels = further.select("node", F.coalesce("root", "component").alias("component"))
        labels = written(labels, "labels")
        drawn = links.join(roots.toDF("a", "from"), "a").join(roots.toDF("b", "to"), "b")
        drawn = drawn.where("from <> to").select(F.col("from").alias("a"), F.col("to").alias("b"))
        links = written(drawn.select(*apart).distinct(), "links")
    return labels
