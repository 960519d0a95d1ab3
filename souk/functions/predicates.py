"""Quality rules as boolean column expressions; ``quality_filter`` ANDs them
into one predicate so Catalyst evaluates a single filter."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import (
    DUMMY_CATEGORY_PATTERN,
    MAX_PRICE,
    MAX_QUANTITY,
    MISSING_MARKER,
    NUMERIC_TEXT_PATTERN,
    TEST_INVOICE_PATTERN,
)


def present(c: str, markers: Sequence[str] = ("",)) -> Column:
    """Not null and not one of ``markers``."""
    col = F.col(c)
    cond = col.isNotNull()
    for m in markers:
        cond = cond & (col != m)
    return cond


def ids_present() -> Column:
    """Customer id not null / empty / ``NA``; invoice number not null / empty."""
    return present("customer_id", ("", MISSING_MARKER)) & present("invoice_no")


def not_test_invoice() -> Column:
    return ~F.col("invoice_no").rlike(TEST_INVOICE_PATTERN)


def not_dummy_category() -> Column:
    """A null category fails too (written out rather than left to 3-valued logic)."""
    return F.col("category").isNotNull() & ~F.col("category").rlike(DUMMY_CATEGORY_PATTERN)


def quantity_in_bounds(max_quantity: float = MAX_QUANTITY) -> Column:
    """A missing quantity fails, as null compares to nothing."""
    q = F.col("quantity")
    return (q > 0) & (q <= max_quantity)


def price_in_bounds(max_price: float = MAX_PRICE) -> Column:
    p = F.col("price")
    return (p > 0) & (p <= max_price)


DEFAULT_RULES: tuple[Callable[[], Column], ...] = (
    ids_present,
    not_test_invoice,
    not_dummy_category,
    quantity_in_bounds,
    price_in_bounds,
)


def quality_predicate(rules: Sequence[Callable[[], Column]] = DEFAULT_RULES) -> Column:
    pred = F.lit(True)
    for rule in rules:
        pred = pred & rule()
    return pred


def quality_filter(df: DataFrame, rules: Sequence[Callable[[], Column]] = DEFAULT_RULES) -> DataFrame:
    """Keep rows that pass every rule (one Filter node)."""
    return df.filter(quality_predicate(rules))


def numeric_text(c: str | Column) -> Column:
    """True for plain unsigned decimals written as text (``12``, ``3.50``)."""
    col = F.col(c) if isinstance(c, str) else c
    return col.rlike(NUMERIC_TEXT_PATTERN)


def non_empty(c: str, dtype: T.DataType | None = None) -> Column:
    """Skip empty group keys and values: not null, and for text not ''."""
    if dtype is not None and not isinstance(dtype, T.StringType):
        return F.col(c).isNotNull()
    return present(c)


def customer_present() -> Column:
    """Customer id not null / empty / ``NA``."""
    return present("customer_id", ("", MISSING_MARKER))
