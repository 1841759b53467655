"""Connected components of a link table, without bringing links or components to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltcomb.llm._runtime import persisted


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(r)


def connected_components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b): root is the least node that links reach.

    Alternates large-star and small-star rounds until the links no longer change; then each node
    links straight to its root. A round needs about two joins; their number grows with the
    logarithm of the components' size. Rounds are written to the shared folder, so a lost executor costs one round.
    Null ends and links of a node to itself are left out.
    """
    links = links.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    edges = persisted(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = _mark(edges)
    for _ in range(rounds if mark[0] else 0):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = persisted(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "large")
        large = both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = persisted(large, "star")
        least = persisted(large.groupBy("a").agg(F.min("b").alias("m")), "small")
        small = large.join(least, "a").select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("x"))
        edges = persisted(small.select(F.col("x.b").alias("a"), F.col("x.m").alias("b")).where(F.col("a") != F.col("b")).distinct(), "edges")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    else:
        if mark[0]:
            raise RuntimeError(f"components not settled after {rounds} rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
