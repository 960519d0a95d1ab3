"""The mall dimension and its joins (shuffle or broadcast by checked size)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import MALL_SEGMENT
from ..session import ensure_checkpoint_dir

#: A side is broadcast if it is known to take no more bytes than this.
MAX_BROADCAST_BYTES = 64 << 20


def mall_dimension(tx: DataFrame, segment: str = MALL_SEGMENT) -> DataFrame:
    """(shopping_mall, mall_segment) from the distinct malls: built by Spark,
    never collected to the driver."""
    return tx.select("shopping_mall").distinct().withColumn("mall_segment", F.lit(segment))


def planned_bytes(df: DataFrame) -> int:
    """The planner's size estimate, an upper bound for scans of files and what
    only narrows them. Runs no job."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def small_side(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """A side that is small by construction but not by the planner's estimate:
    written once to the checkpoint folder, measured there, and marked for a
    broadcast if its bytes allow; otherwise the join is a shuffle whose skewed
    partitions the adaptive planner splits."""
    ensure_checkpoint_dir(df.sparkSession)
    written = df.checkpoint()
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in written.columns), F.lit(0))
    size = written.agg(F.sum(width)).first()[0] or 0
    return F.broadcast(written) if size <= max_bytes else written


def join_mall_dim(
    tx: DataFrame,
    dim: DataFrame,
    strategy: str = "auto",
    how: str = "left",
    key: str = "shopping_mall",
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Left equi join to the dimension. No strategy runs a job.

    ``auto``: Catalyst decides from statistics, and AQE turns the join into
    a broadcast at run time when the shuffled dimension turns out small.
    ``broadcast``: the dimension is broadcast if the planner bounds its size by
    ``max_bytes``, as it does for a stored table; else as ``auto``.
    ``merge``: sort-merge join (shuffle both sides; AQE splits a skewed key).
    """
    if strategy == "broadcast":
        side = F.broadcast(dim) if planned_bytes(dim) <= max_bytes else dim
    elif strategy == "merge":
        side = dim.hint("merge")
    elif strategy == "auto":
        side = dim
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return tx.join(side, key, how)
