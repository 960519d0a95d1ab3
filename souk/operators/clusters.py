"""Category/customer edge lists, frequency thresholds, cluster sizes and
outcomes, top-N differences and the node table of the bipartite graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.derive import exact_mean
from ..functions.predicates import non_empty, numeric_text
from ..session import scratch_path
from ..sources.io import stored
from .joins import MAX_BROADCAST_BYTES, small_side
from .quantiles import exact_median
from .topn import top_n


def category_customer_edges(df: DataFrame, left: str = "category", right: str = "customer_id") -> DataFrame:
    """Edges (left entity, customer) as a bag: repeats kept."""
    return df.select(left, right)


def entity_counts(edges: DataFrame, min_count: int = 10, left: str = "category") -> DataFrame:
    """Edges per left entity, keeping entities with at least ``min_count``."""
    return (
        edges.groupBy(left)
        .agg(F.count(F.lit(1)).alias("count"))
        .filter(F.col("count") >= min_count)
        .orderBy(F.col(left).asc_nulls_first())
    )


def threshold_edges(
    edges: DataFrame, counts: DataFrame, left: str = "category", max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """Edges whose left entity passed the threshold (left semi join).

    The passing entities are written once into the checkpoint folder and
    measured; within ``max_bytes`` they are broadcast, so the edge rows are
    filtered where they are read and never shuffled by entity (a hot entity
    would otherwise fill one task)."""
    side = small_side(counts.select(left), max_bytes)
    return edges.join(side, edges[left].eqNullSafe(side[left]), "left_semi")


def cluster_sizes(edges_kept: DataFrame, left: str = "category") -> DataFrame:
    """Edges per kept entity (the histogram table)."""
    return (
        edges_kept.groupBy(left).agg(F.count(F.lit(1)).alias("count")).orderBy(F.col(left).asc_nulls_first())
    )


def top_entities(edges: DataFrame, n: int = 30, left: str = "category") -> DataFrame:
    """The ``n`` left entities with the most edges (ties by name)."""
    counts = edges.groupBy(left).agg(F.count(F.lit(1)).alias("count"))
    return top_n(counts, [F.desc("count"), F.col(left).asc_nulls_first()], n)


def top_diff(a: DataFrame, b: DataFrame, left: str = "category") -> DataFrame:
    """Rows only in ``a`` (side ``<``) and only in ``b`` (side ``>``) of two
    top lists, which name an entity once each: one full outer join."""
    x, y = (df.select(F.col(left), F.col("count"), F.lit(True).alias("own")).alias(k) for df, k in ((a, "x"), (b, "y")))
    met = x.join(y, F.col(f"x.{left}").eqNullSafe(F.col(f"y.{left}")) & (F.col("x.count") == F.col("y.count")), "full")
    side = F.when(F.col("y.own").isNull(), F.lit("<")).when(F.col("x.own").isNull(), F.lit(">"))
    one = lambda c: F.when(F.col("x.own").isNotNull(), F.col(f"x.{c}")).otherwise(F.col(f"y.{c}")).alias(c)
    return met.select(one(left), one("count"), side.alias("side")).where(F.col("side").isNotNull())


def category_prices(raw: DataFrame, left: str = "category", value: str = "price") -> DataFrame:
    """(entity, value) for rows whose trimmed value text is a plain unsigned
    decimal; the value as double."""
    v = F.trim(F.col(value).cast("string"))
    return raw.where(numeric_text(v)).select(F.col(left).alias("entity"), v.cast("double").alias(value))


def cluster_outcomes(prices: DataFrame, value: str = "price", **median_kw) -> DataFrame:
    """Per entity: count, mean and exact median of ``value``. The values are
    written once into the checkpoint folder and read for each."""
    prices = stored(prices, scratch_path(prices.sparkSession, "cluster-values"))
    stats = prices.groupBy("entity").agg(F.count(F.col(value)).alias("count"), exact_mean(value).alias("mean"))
    med = exact_median(prices, ["entity"], value, **median_kw).select("entity", "median")
    return stats.join(med, stats["entity"].eqNullSafe(med["entity"])).select(
        stats["entity"], "count", "mean", "median"
    )


def edge_nodes(edges: DataFrame, left: str = "category", right: str = "customer_id") -> DataFrame:
    """Node table of the bipartite graph: node, role (``entity`` when it
    appears on the left, else ``customer``) and degree (distinct
    neighbours). Empty ends are skipped. Distinct counting goes through
    Spark's two-phase (node, neighbour) aggregation, so a hub node's
    neighbours are spread over tasks."""
    l, r = F.col(left), F.col(right)
    end = lambda node, nbr, is_left: F.struct(node.alias("node"), nbr.alias("nbr"), F.lit(is_left).alias("is_left"))
    ends = edges.where(non_empty(left) & non_empty(right)).select(F.inline(F.array(end(l, r, 1), end(r, l, 0))))
    return ends.groupBy("node").agg(
        F.when(F.max("is_left") == 1, F.lit("entity")).otherwise(F.lit("customer")).alias("role"),
        F.count_distinct("nbr").alias("degree"),
    )
