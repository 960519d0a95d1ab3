"""Connected components of a link table, as a small loop of Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Links each larger neighbour to the smallest of a node and its neighbours."""
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    rest = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.unionAll(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of the links ``(a, b)``; the label is
    the smallest node of its component. Alternates large and small stars until
    the links are stars themselves; each round is written out, so a lost
    executor costs one round. Hot nodes are pre-aggregated and their join may
    be split by the adaptive planner."""
    links = links.select("a", "b").where("a <> b")
    before = None
    while True:
        links = stored(_small_star(_large_star(links)).distinct(), "links")
        now = links.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
        if now == before:
            break
        before = now
    labels = links.select(F.col("a").alias("node"), F.col("b").alias("label"))
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return stored(labels.unionAll(roots), "labels")
