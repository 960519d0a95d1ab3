"""Top-N with an explicit tie-break: ``orderBy(...).limit(n)`` plans as
``TakeOrderedAndProject`` (each task keeps its n best rows; only n x tasks
rows meet in the last step), never a full sort of the input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def top_n(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    if n <= 0:
        raise ValueError("n must be positive")
    return df.orderBy(*order).limit(n)
