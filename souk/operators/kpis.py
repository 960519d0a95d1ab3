"""Gold KPIs: customers, months, categories, baskets, bands, distributions.

Every aggregate here is decomposable (count, exact DECIMAL sums, min, max,
percentile sketch, distinct via Spark's two-phase rewrite), so Catalyst
plans a partial aggregate before each exchange: a key that holds a third of
the rows sends one partial row per task, never its raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import order_free as O
from ..functions.derive import exact_mean, exact_parts, money, price_bucket, qty_sum, safe_div, spend_parts, spend_sum, total
from ..functions.predicates import customer_present, non_empty
from ..schema import BUCKET_HI, BUCKET_LO, HIGH_PRICE, PRICE_DECIMAL, QTY_DECIMAL
from .state import CATEGORY_SPEND, CUSTOMER_ITEMS, CUSTOMER_MONEY, MEANS, MONTH, PRICES, category_table, customer_money, month_table
from .topn import top_n


def _ratio(cond: Column) -> Column:
    """Share of rows for which ``cond`` holds, as double."""
    return (F.sum(F.when(cond, 1).otherwise(0)) / F.count(F.lit(1))).cast("double")


def customer_summary(
    tx: DataFrame,
    high_price: float = HIGH_PRICE,
    lo: float = BUCKET_LO,
    hi: float = BUCKET_HI,
    median_accuracy: int = 10000,
) -> DataFrame:
    """Per customer: transactions, items, spend, mean and median price,
    share of high-price lines, average price per item and its bucket."""
    agg = tx.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("transactions"),
        qty_sum("quantity").alias("total_items"),
        spend_sum().alias("total_spend"),
        exact_mean("price").alias("price_mean"),
        F.percentile_approx("price", 0.5, median_accuracy).alias("price_median"),
        _ratio(F.col("price") > high_price).alias("high_price_tx_ratio"),
    )
    avg_item = safe_div("total_spend", "total_items")
    return agg.select(
        "*",
        avg_item.alias("avg_price_per_item"),
        price_bucket(avg_item, "total_items", lo, hi).alias("bucket"),
    )


def customer_summary_money(tx: DataFrame) -> DataFrame:
    """Per customer, for printing: see :func:`state.customer_money`."""
    return customer_money(CUSTOMER_MONEY.collected(CUSTOMER_MONEY.of(tx), "customer_id"))


def bucket_counts(summary: DataFrame) -> DataFrame:
    """Customers per price bucket."""
    return summary.groupBy("bucket").agg(F.count(F.lit(1)).alias("count")).orderBy("bucket")


def monthly_summary(tx: DataFrame) -> DataFrame:
    """Per ``year_month``: rows and mean price (nulls ignored), in month order."""
    return month_table(PRICES.collected(PRICES.of(tx), MONTH))


def category_avg_spend(tx: DataFrame) -> DataFrame:
    """Per category: rows, total spend and spend per row, highest first.
    Empty categories are skipped; a missing number adds no spend."""
    return category_table(CATEGORY_SPEND.collected(CATEGORY_SPEND.of(tx.filter(non_empty("category"))), "category"))


def category_top(tx: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` categories by spend per row (ties by name)."""
    return top_n(category_avg_spend(tx), [F.desc("avg_spend_per_tx"), F.asc("category")], n)


def _baskets(tx: DataFrame) -> DataFrame:
    """Baskets with spend and items in both parts of their sums, so that they
    can be summed on."""
    spend, spend_rest = spend_parts()
    items, items_rest = exact_parts(F.col("quantity"), QTY_DECIMAL)
    return tx.groupBy("invoice_no", "customer_id", "shopping_mall", "year_month").agg(
        F.sum(spend).alias("spend"),
        F.sum(spend_rest).alias("spend_rest"),
        F.sum(items).alias("items"),
        F.sum(items_rest).alias("items_rest"),
        F.count_distinct("category").alias("basket_category_count"),
    )


def _both(exact: str, rest: str) -> Column:
    a, b = F.col(exact).cast("double"), F.col(rest)
    return F.coalesce(a + b, a, b)


def invoice_baskets(tx: DataFrame) -> DataFrame:
    """Per (invoice, customer, mall, month): spend, items, distinct categories."""
    return _baskets(tx).select(
        "invoice_no",
        "customer_id",
        "shopping_mall",
        "year_month",
        _both("spend", "spend_rest").alias("basket_spend"),
        _both("items", "items_rest").alias("basket_items"),
        "basket_category_count",
    )


def mall_month_extended(tx: DataFrame) -> DataFrame:
    """Per mall and month, over baskets: revenue, invoices, mean basket value
    and mean basket items."""
    return (
        _baskets(tx)
        .groupBy("shopping_mall", "year_month")
        .agg(
            total(F.col("spend"), F.col("spend_rest")).alias("total_revenue"),
            F.count(F.lit(1)).alias("num_invoices"),
            total(F.col("items"), F.col("items_rest")).alias("_items"),
        )
        .select(
            "shopping_mall",
            "year_month",
            "total_revenue",
            "num_invoices",
            (F.col("total_revenue") / F.col("num_invoices")).alias("avg_basket_value"),
            (F.col("_items") / F.col("num_invoices")).alias("avg_basket_items"),
        )
        .orderBy("shopping_mall", F.col("year_month").asc_nulls_first())
    )


def age_band_category(tx: DataFrame) -> DataFrame:
    """Revenue and items per age band and category."""
    return (
        tx.groupBy("age_band", "category")
        .agg(
            spend_sum().alias("total_revenue"),
            qty_sum("quantity").alias("items_sold"),
        )
        .orderBy("age_band", F.desc("total_revenue"), "category")
    )


def payment_behavior(tx: DataFrame) -> DataFrame:
    """Revenue per mall, age band and payment method."""
    return tx.groupBy("shopping_mall", "age_band", "payment_method").agg(
        spend_sum().alias("total_revenue")
    )


def top_customers_by_quantity(tx: DataFrame, n: int = 10) -> DataFrame:
    """Customers with the most items (ties by id); missing ids skipped."""
    per = CUSTOMER_ITEMS.collected(CUSTOMER_ITEMS.of(tx.filter(customer_present())), "customer_id")
    per = per.select("customer_id", F.coalesce("items", F.lit(0.0)).alias("total_quantity"))
    return top_n(per, [F.desc("total_quantity"), F.asc("customer_id")], n)


#: Squares of numbers below this are summed as DECIMAL(38, 12).
MAX_EXACT_SQUARE = 1e6


def _squares(x: Column) -> tuple[Column, Column, Column]:
    """A number's square: as an exact DECIMAL, or as a double and its rounding
    error, which together are the square (split multiplication)."""
    exact = F.when(F.abs(x) < MAX_EXACT_SQUARE, exact_parts(x, PRICE_DECIMAL)[0])
    v = F.when(exact.isNull(), x.cast("double"))
    square, turn = v * v, v * float((1 << 27) + 1)
    high = turn - (turn - v)
    low = v - high
    error = ((high * high - square) + 2 * high * low) + low * low
    return exact * exact, square, F.when(O.finite(square) & O.finite(error), error)


def _deviation(c: str) -> Column:
    """Population standard deviation from the count, the sum and the sum of
    squares: their difference is taken exactly where DECIMAL holds it."""
    n, s, q = F.col(f"{c}__count"), F.col(f"{c}__sum_exact"), F.col(f"{c}__squares_exact")
    alone = F.col(f"{c}__mixed") == 0
    small = (n < 10**10) & (F.abs(s) < 10**13) & (q < 10**15)
    exact = n.cast("decimal(10,0)") * q.cast("decimal(27,12)") - s.cast("decimal(19,6)") * s.cast("decimal(19,6)")
    total, squares = F.col(f"{c}__sum"), F.col(f"{c}__squares")
    rough = F.greatest(squares / n - (total / n) * (total / n), F.lit(0.0))
    return F.when(n > 0, F.when(alone & small, F.sqrt(exact.cast("double")) / n).otherwise(F.sqrt(rough)))


def numeric_distributions(tx: DataFrame, cols: Sequence[str] = ("quantity", "price"), sd_digits: int = 6) -> DataFrame:
    """count, mean, population stddev, min, max of numeric columns, one row
    per column (long form). One pass: a global aggregate, whose sums don't
    depend on the order of rows."""
    own, rests = [], []
    for c in cols:
        x = F.col(c)
        exact, rest = exact_parts(x, PRICE_DECIMAL)
        square, high, low = _squares(x)
        named = {"x": exact, "r": rest, "qx": square, "qh": high, "ql": low}
        own += [x.alias(c), *[e.alias(f"{c}__{k}") for k, e in named.items()]]
        rests += [f"{c}__{k}" for k in ("r", "qh", "ql")]
    base, of = F.col(O.LIMB).isNull(), F.col("of")
    aggs = []
    for k, c in enumerate(cols):
        at = 3 * k
        aggs += [
            F.count(F.when(base, F.col(c))).alias(f"{c}__count"),
            F.count(F.when(base, F.coalesce(F.col(f"{c}__r"), F.col(f"{c}__qh")))).alias(f"{c}__mixed"),
            F.sum(F.when(base, F.col(f"{c}__x"))).cast("decimal(38,6)").alias(f"{c}__sum_exact"),
            F.sum(F.when(base, F.col(f"{c}__qx"))).cast("decimal(38,12)").alias(f"{c}__squares_exact"),
            O.special_sum(F.col(f"{c}__r")).alias(f"{c}__sum_special"),
            O.special_sum(F.col(f"{c}__qh")).alias(f"{c}__squares_special"),
            F.sum(F.when(of == at, F.col("amount"))).cast(O.AMOUNT).alias(f"{c}__sum_limb"),
            F.sum(F.when(of.isin(at + 1, at + 2), F.col("amount"))).cast(O.AMOUNT).alias(f"{c}__squares_limb"),
            F.min(c).alias(f"{c}__min"),
            F.max(c).alias(f"{c}__max"),
        ]
    per = O.with_limbs(tx.select(*own), rests).groupBy(O.LIMB).agg(*aggs)
    again = []
    for c in cols:
        again += [F.coalesce(F.sum(f"{c}__{k}"), F.lit(0)).alias(f"{c}__{k}") for k in ("count", "mixed")]
        again += [F.sum(f"{c}__{k}").cast(t).alias(f"{c}__{k}") for k, t in (("sum_exact", "decimal(38,6)"), ("squares_exact", "decimal(38,12)"))]
        again += [F.sum(f"{c}__{k}_special").alias(f"{c}__{k}_special") for k in ("sum", "squares")]
        again += [O.limbs(f"{c}__{k}_limb").alias(f"{c}__{k}_limbs") for k in ("sum", "squares")]
        again += [F.min(f"{c}__min").alias(f"{c}__min"), F.max(f"{c}__max").alias(f"{c}__max")]
    total = lambda c, k: O.combined(F.col(f"{c}__{k}_exact").cast("double"), O.value_of(f"{c}__{k}_limbs"), F.col(f"{c}__{k}_special"))
    wide = per.agg(*again).select("*", *[total(c, k).alias(f"{c}__{k}") for c in cols for k in ("sum", "squares")])
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(f"{c}__count").alias("count"),
            F.try_divide(f"{c}__sum", f"{c}__count").alias("mean"),
            F.round(_deviation(c), sd_digits).alias("stddev"),
            F.col(f"{c}__min").cast("double").alias("min"),
            F.col(f"{c}__max").cast("double").alias("max"),
        )
        for c in cols
    ]
    return wide.select(F.inline(F.array(*rows)))


def signals_ranked(tx: DataFrame, n: int = 10) -> DataFrame:
    """Long signals table: the quantity and price means, then the top ``n``
    categories by spend per row, values at two decimals."""
    per = MEANS.collected(MEANS.of(tx))
    means = per.select(F.try_divide("quantity", "quantities").alias("q"), F.try_divide("price", "prices").alias("p"))
    simple = means.select(
        F.inline(
            F.array(
                F.struct(F.lit("quantity_mean").alias("signal"), F.lit("simple").alias("kind"), money("q").alias("value")),
                F.struct(F.lit("price_mean").alias("signal"), F.lit("simple").alias("kind"), money("p").alias("value")),
            )
        )
    )
    cats = category_top(tx, n).select(
        F.col("category").alias("signal"),
        F.lit("category_avg_spend").alias("kind"),
        money("avg_spend_per_tx").alias("value"),
    )
    return simple.unionByName(cats)
