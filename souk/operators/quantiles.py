"""Exact per-group median without gathering a whole group in one task.

Rows are collapsed to ``(key, value, count)`` first (a partial aggregate, so
equal values never pile up), then dealt into ranges of ``(key, value)`` and
written to the shared checkpoint folder. Counts per range give the rank at
which each range starts; only the one or two ranges that hold a group's middle
ranks are read again, and a running count inside them finds the values. There
is no row limit and no number of rounds: a group of any size is cut by ranges,
and a range by its values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .joins import small_side

_V = "__v"


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Null-safe equi join on ``keys`` keeping the left key columns once."""
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
    return left.join(r, cond, how).drop(*[f"__r_{k}" for k in keys])


def middle_values(counts: DataFrame, keys: Sequence[str], value: str, count: str, ranges: int | None = None) -> DataFrame:
    """``keys..., n, low, high``: how many values a group has and its two
    middle ones (one and the same if ``n`` is odd). ``counts`` has one row per
    group and distinct ``value``, with how often it occurs. ``ranges``: into
    how many ranges the distinct values are dealt, the session's shuffle
    partitions by default."""
    keys = list(keys)
    spark = counts.sparkSession
    ensure_checkpoint_dir(spark)
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = counts.select(*keys, F.col(value).alias(_V), F.col(count).alias("__c"))
    # written out: the ranges must be the same for the sums and for the values
    dealt = counts.repartitionByRange(ranges, *keys, _V).withColumn("__p", F.spark_partition_id()).checkpoint()

    group = Window.partitionBy(*keys)
    before = group.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy(*keys, "__p").agg(F.sum("__c").alias("__m"))
    placed = sums.select(
        *keys,
        "__p",
        "__m",
        F.sum("__m").over(group).alias("n"),
        F.coalesce(F.sum("__m").over(before), F.lit(0)).alias("__below"),
    )
    low, high = F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)
    holds = lambda start, count, rank: (start <= rank) & (rank < start + count)
    wanted = placed.where(holds(F.col("__below"), F.col("__m"), low) | holds(F.col("__below"), F.col("__m"), high))
    # at most two ranges of each group
    wanted = small_side(wanted.select(*keys, "__p", "n", "__below"))

    inside = Window.partitionBy(*keys, "__p").orderBy(_V).rowsBetween(Window.unboundedPreceding, -1)
    ranked = join_null_safe(dealt, wanted, [*keys, "__p"]).withColumn(
        "__start", F.col("__below") + F.coalesce(F.sum("__c").over(inside), F.lit(0))
    )
    middle = lambda rank: F.max(F.when(holds(F.col("__start"), F.col("__c"), rank), F.col(_V)))
    return ranked.groupBy(*keys).agg(F.first("n").alias("n"), middle(low).alias("low"), middle(high).alias("high"))


def exact_median(df: DataFrame, keys: Sequence[str], value: str, ranges: int | None = None) -> DataFrame:
    """``keys..., n, median`` of the non-null ``value`` per group (exact;
    the mean of the two middle values when ``n`` is even)."""
    values = df.select(*keys, F.col(value).cast("double").alias(_V)).where(F.col(_V).isNotNull())
    counts = values.groupBy(*keys, _V).agg(F.count(F.lit(1)).alias("__c"))
    return middle_values(counts, keys, _V, "__c", ranges).select(*keys, "n", ((F.col("low") + F.col("high")) / 2).alias("median"))
