"""Revenue per mall and per mall and month, with the layout variants: a
fixed number of final partitions, and a one-year filter that prunes
``year_month`` partitions of a partitioned silver table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.derive import spend_sum


def mall_revenue(tx: DataFrame, repartition: int | None = None) -> DataFrame:
    """Total revenue per mall: partial aggregate -> exchange on the mall ->
    final. ``repartition=n``: the final step and what follows run in at most
    ``n`` tasks, fed by the same partial sums through the same one exchange.
    """
    revenue = tx.groupBy("shopping_mall").agg(spend_sum().alias("total_revenue"))
    return revenue.coalesce(repartition) if repartition else revenue


def year_filter(year: int):
    """Predicate on the partition column ``year_month`` (string ``yyyy-MM``)
    that selects one calendar year, so a partitioned read prunes folders."""
    ym = F.col("year_month")
    return (ym >= F.lit(f"{year:04d}-01")) & (ym < F.lit(f"{year + 1:04d}-01"))


def mall_month_revenue(tx: DataFrame, year: int | None = None) -> DataFrame:
    """Revenue per mall and month, optionally for one year only."""
    src = tx.filter(year_filter(year)) if year is not None else tx
    return src.groupBy("shopping_mall", "year_month").agg(spend_sum().alias("total_revenue"))
