"""Derived columns: spend, bands, buckets, guarded ratios, labels, money sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import (
    AGE_BAND_EDGES,
    AGE_BAND_TOP,
    AGE_BAND_UNKNOWN,
    BUCKET_HI,
    BUCKET_LO,
    HIGH_SPEND,
    PRICE_DECIMAL,
    QTY_DECIMAL,
)


#: Line spends below this are summed as DECIMAL(38, 10): 10**13 of them fit.
MAX_EXACT_SPEND = 1e15


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def spend(quantity: str | Column = "quantity", price: str | Column = "price") -> Column:
    """Line spend as double: quantity x price."""
    return _col(quantity) * _col(price)


def exact_parts(x: Column, dec: T.DecimalType) -> tuple[Column, Column]:
    """A number as a DECIMAL if it is one of that width exactly, else as a
    double: one of the two is null. Nothing is rounded or lost."""
    d = x.try_cast(dec)
    fits = d.cast("double") == x
    return F.when(fits, d), F.when(fits, F.lit(None)).otherwise(x.cast("double"))


def spend_parts(quantity: str | Column = "quantity", price: str | Column = "price") -> tuple[Column, Column]:
    """Line spend as an exact DECIMAL, or as a double product where a factor
    isn't a DECIMAL of its width or the product is so large that a sum of many
    would leave DECIMAL's range."""
    q, p = _col(quantity), _col(price)
    product = spend(q, p)
    exact = exact_parts(q, QTY_DECIMAL)[0] * exact_parts(p, PRICE_DECIMAL)[0]
    exact = F.when(F.abs(product) < MAX_EXACT_SPEND, exact)
    return exact, F.when(exact.isNull(), product)


def total(exact: Column, rest: Column) -> Column:
    """Sum of both parts as double. What DECIMAL holds is summed exactly, so
    its total doesn't depend on the order in which partial sums meet; values
    beyond it are summed as doubles, never dropped."""
    a, b = F.sum(exact).cast("double"), F.sum(rest)
    return F.coalesce(a + b, a, b)


def spend_sum(quantity: str | Column = "quantity", price: str | Column = "price") -> Column:
    return total(*spend_parts(quantity, price))


def qty_sum(c: str | Column = "quantity") -> Column:
    return total(*exact_parts(_col(c), QTY_DECIMAL))


def exact_mean(c: str | Column, dec: T.DecimalType = PRICE_DECIMAL) -> Column:
    """Mean over the non-null values, all of which are in the sum."""
    x = _col(c)
    return F.try_divide(total(*exact_parts(x, dec)), F.count(x))


def age_band(c: str | Column = "age") -> Column:
    """Six age bands; a null age is ``unknown`` rather than the top band."""
    age = _col(c)
    expr = F.when(age.isNull(), F.lit(AGE_BAND_UNKNOWN))
    for upper, label in AGE_BAND_EDGES:
        expr = expr.when(age < upper, F.lit(label))
    return expr.otherwise(F.lit(AGE_BAND_TOP))


def safe_div(a: str | Column, b: str | Column) -> Column:
    """``a / b``, or 0.0 when ``b`` is not positive."""
    return F.when(_col(b) > 0, _col(a) / _col(b)).otherwise(F.lit(0.0))


def price_bucket(
    avg: str | Column, items: str | Column, lo: float = BUCKET_LO, hi: float = BUCKET_HI
) -> Column:
    """ZERO when there are no items, else LO < lo <= MID <= hi < HI."""
    a = _col(avg)
    return (
        F.when(_col(items) == 0, F.lit("ZERO"))
        .when(a < lo, F.lit("LO"))
        .when(a <= hi, F.lit("MID"))
        .otherwise(F.lit("HI"))
    )


def high_spend_label(df: DataFrame, spend_col: str = "basket_spend", threshold: float = HIGH_SPEND) -> DataFrame:
    """Binary label ``high_spend``: 1 when spend is above ``threshold``."""
    return df.withColumn("high_spend", (F.col(spend_col) > threshold).cast("int"))


def money(c: str | Column) -> Column:
    """Two-decimal output value."""
    return F.round(_col(c), 2)


def hundredths(over: str, under: str) -> Column:
    """``over / under`` at two decimals, half up, of columns that hold DECIMALs
    (or whole numbers) and ``under`` above zero: in whole numbers throughout,
    so that a tie is a tie in any engine."""
    whole = F.expr(f"(CAST(200 AS DECIMAL(3,0)) * {over} + {under}) div (CAST(2 AS DECIMAL(1,0)) * {under})")
    return (whole / 100).cast("double")
