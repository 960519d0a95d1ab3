"""Mergeable states: what the gold tables keep so that new rows can be added
without reading old ones again.

A state holds counts and sum parts per key and month. Two of them merge by one
keyed aggregate, in any order and any grouping, to exactly the state of all
rows together: counts and DECIMAL sums are exact, and numbers that no DECIMAL
of their column holds are kept as limbs (``functions.order_free``), rows of
their own with a ``limb``. Distinct counts are exact as well, as what is
counted is part of a key. The month is always a key, so a merge touches only
months that have new rows.

The tables at the end are made from states; they equal those of ``kpis`` and
``layout`` over the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.derive import exact_parts, hundredths, money, price_bucket, safe_div, spend_parts
from ..functions.order_free import AMOUNT, LIMB, combined, finite, limb_sum, limbs, special_sum, value_of, with_limbs
from ..functions.predicates import non_empty
from ..schema import HIGH_PRICE, PRICE_DECIMAL, QTY_DECIMAL
from .quantiles import join_null_safe, middle_values

MONTH = "year_month"

Parts = Callable[[], tuple[Column, Column]]

SPEND: Parts = spend_parts
ITEMS: Parts = lambda: exact_parts(F.col("quantity"), QTY_DECIMAL)
PRICE: Parts = lambda: exact_parts(F.col("price"), PRICE_DECIMAL)

#: Scale of each sum's DECIMAL(38).
SCALES = {
    "spend": QTY_DECIMAL.scale + PRICE_DECIMAL.scale,
    "items": QTY_DECIMAL.scale,
    "price": PRICE_DECIMAL.scale,
    "quantity": PRICE_DECIMAL.scale,
}


@dataclass(frozen=True)
class State:
    """``keys`` (of a stored one the month first), ``rows``, further ``counts`` of rows for
    which a column isn't null, and ``sums`` given as their two parts."""

    keys: tuple[str, ...]
    sums: dict[str, Parts] = field(default_factory=dict)
    counts: dict[str, Callable[[], Column]] = field(default_factory=dict)

    def _number(self, name: str, c: Column) -> Column:
        return c.cast(T.DecimalType(38, SCALES[name]))

    def of(self, rows: DataFrame) -> DataFrame:
        """The state of some rows. Partial aggregates are exchanged."""
        counted = [f().alias(f"{n}_c") for n, f in self.counts.items()]
        parts = [p.alias(f"{n}_{k}") for n, f in self.sums.items() for k, p in zip(("x", "r"), f())]
        full = with_limbs(rows.select(*self.keys, *counted, *parts), [f"{n}_r" for n in self.sums])
        base = F.col(LIMB).isNull()
        aggs = [F.count(F.when(base, 1)).alias("rows")]
        aggs += [F.count(F.when(base, F.col(f"{n}_c"))).alias(n) for n in self.counts]
        for k, n in enumerate(self.sums):
            aggs += [
                self._number(n, F.sum(F.when(base, F.col(f"{n}_x")))).alias(f"{n}_exact"),
                special_sum(F.col(f"{n}_r")).alias(f"{n}_special"),
                limb_sum(k).alias(f"{n}_limb"),
            ]
        return full.groupBy(*self.keys, LIMB).agg(*aggs)

    def each(self, rows: DataFrame) -> DataFrame:
        """Every row as a state of its own, in the form of :meth:`of`: what
        :meth:`merged` takes together anyway needn't be exchanged before."""
        counted = [f().alias(f"{n}_c") for n, f in self.counts.items()]
        parts = [p.alias(f"{n}_{k}") for n, f in self.sums.items() for k, p in zip(("x", "r"), f())]
        full = with_limbs(rows.select(*self.keys, *counted, *parts), [f"{n}_r" for n in self.sums])
        base = F.col(LIMB).isNull()
        one = lambda c: F.when(c, 1).otherwise(0).cast("long")
        cols = [one(base).alias("rows")] + [one(base & F.col(f"{n}_c").isNotNull()).alias(n) for n in self.counts]
        for k, n in enumerate(self.sums):
            rest = F.col(f"{n}_r")
            cols += [
                self._number(n, F.when(base, F.col(f"{n}_x"))).alias(f"{n}_exact"),
                F.when(base & ~finite(rest), rest).alias(f"{n}_special"),
                F.when(F.col("of") == k, F.col("amount")).cast(AMOUNT).alias(f"{n}_limb"),
            ]
        return full.select(*self.keys, LIMB, *cols)

    def merged(self, *states: DataFrame) -> DataFrame:
        """One state of several: a keyed aggregate of sums."""
        every = states[0]
        for s in states[1:]:
            every = every.unionByName(s)
        aggs = [F.sum(c).alias(c) for c in ("rows", *self.counts)]
        for n in self.sums:
            aggs += [self._number(n, F.sum(f"{n}_exact")).alias(f"{n}_exact"), F.sum(f"{n}_special").alias(f"{n}_special")]
            aggs.append(F.sum(f"{n}_limb").cast(AMOUNT).alias(f"{n}_limb"))
        return every.groupBy(*self.keys, LIMB).agg(*aggs)

    def totals(self, state: DataFrame, *by: str, count: dict[str, str] | None = None) -> DataFrame:
        """``by``, ``rows``, the counts and the sums as doubles, over coarser
        keys, and as ``<sum>_dec`` the sums that are one DECIMAL. ``count``:
        how many keys below each, by a column that isn't null.

        Rows with a limb are few or none, so they're summed aside: what has no
        limb takes one aggregate of plain sums."""
        base = state.where(F.col(LIMB).isNull())
        aggs = [F.sum(c).alias(c) for c in ("rows", *self.counts)]
        aggs += [F.count(column).alias(name) for name, column in (count or {}).items()]
        for n in self.sums:
            aggs += [F.sum(f"{n}_exact").alias(f"{n}_exact"), F.sum(f"{n}_special").alias(f"{n}_special")]
        plain = base.groupBy(*by).agg(*aggs)
        if not self.sums:
            return plain.select(*by, "rows", *self.counts, *(count or {}))
        rest = state.where(F.col(LIMB).isNotNull()).groupBy(*by).agg(*[limbs(f"{n}_limb").alias(f"{n}_limbs") for n in self.sums])
        return self._summed(join_null_safe(plain, rest, by, "left"), by, *(count or {}))

    def collected(self, state: DataFrame, *by: str) -> DataFrame:
        """As :meth:`totals`, of a state that isn't stored: in one pass over
        it, at the price of lists in the aggregate. For few keys."""
        aggs = [F.sum(c).alias(c) for c in ("rows", *self.counts)]
        for n in self.sums:
            aggs += [F.sum(f"{n}_exact").alias(f"{n}_exact"), F.sum(f"{n}_special").alias(f"{n}_special")]
            aggs.append(limbs(f"{n}_limb").alias(f"{n}_limbs"))
        return self._summed(state.groupBy(*by).agg(*aggs), by)

    def _summed(self, parts: DataFrame, by: tuple[str, ...], *counted: str) -> DataFrame:
        sums = [F.col(f"{n}_exact").cast("double").alias(f"{n}_x") for n in self.sums] + [value_of(f"{n}_limbs").alias(f"{n}_rest") for n in self.sums]
        valued = parts.select("*", *sums)
        out = [combined(F.col(f"{n}_x"), F.col(f"{n}_rest"), F.col(f"{n}_special")).alias(n) for n in self.sums]
        alone = {n: F.col(f"{n}_rest").isNull() & F.col(f"{n}_special").isNull() for n in self.sums}
        out += [F.when(alone[n], F.col(f"{n}_exact")).alias(f"{n}_dec") for n in self.sums]
        return valued.select(*by, "rows", *self.counts, *counted, *out)


#: Not stored: sums over rows that may hold any double.
PRICES = State((MONTH,), {"price": PRICE}, {"prices": lambda: F.col("price")})
CATEGORY_SPEND = State(("category",), {"spend": SPEND})
CUSTOMER_MONEY = State(("customer_id",), {"spend": SPEND, "items": ITEMS}, {"high": lambda: F.when(F.col("price") > HIGH_PRICE, 1)})
CUSTOMER_ITEMS = State(("customer_id",), {"items": ITEMS})
MEANS = State(
    (),
    {"quantity": lambda: exact_parts(F.col("quantity"), PRICE_DECIMAL), "price": PRICE},
    {"quantities": lambda: F.col("quantity"), "prices": lambda: F.col("price")},
)

BASKETS = State((MONTH, "invoice_no", "customer_id", "shopping_mall", "category"), {"spend": SPEND, "items": ITEMS})
CUSTOMERS = State(
    (MONTH, "customer_id"),
    {"spend": SPEND, "items": ITEMS, "price": PRICE},
    {"prices": lambda: F.col("price"), "high": lambda: F.when(F.col("price") > HIGH_PRICE, 1)},
)
CUSTOMER_PRICES = State((MONTH, "customer_id", "price"))
CATEGORIES = State((MONTH, "category"), {"spend": SPEND})
MALLS = State((MONTH, "shopping_mall"), {"spend": SPEND, "price": PRICE}, {"prices": lambda: F.col("price")})
BANDS = State((MONTH, "age_band", "category"), {"spend": SPEND, "items": ITEMS})
PAYMENTS = State((MONTH, "shopping_mall", "age_band", "payment_method"), {"spend": SPEND})

#: The states behind the gold tables, by the name they are stored under.
STATES: dict[str, State] = {
    "baskets": BASKETS,
    "customers": CUSTOMERS,
    "customer_prices": CUSTOMER_PRICES,
    "categories": CATEGORIES,
    "malls": MALLS,
    "bands": BANDS,
    "payments": PAYMENTS,
}


def customer_summary(customers: DataFrame, prices: DataFrame) -> DataFrame:
    """As :func:`kpis.customer_summary`; the median is the exact lower one."""
    per = CUSTOMERS.totals(customers, "customer_id")
    counts = prices.where(F.col("price").isNotNull()).groupBy("customer_id", "price").agg(F.sum("rows").alias("rows"))
    median = middle_values(counts, ["customer_id"], "price", "rows").select("customer_id", F.col("low").alias("price_median"))
    met = join_null_safe(per, median, ["customer_id"], "left")
    avg_item = safe_div("spend", "items")
    return met.select(
        "customer_id",
        F.col("rows").alias("transactions"),
        F.col("items").alias("total_items"),
        F.col("spend").alias("total_spend"),
        F.try_divide("price", "prices").alias("price_mean"),
        "price_median",
        (F.col("high") / F.col("rows")).cast("double").alias("high_price_tx_ratio"),
        avg_item.alias("avg_price_per_item"),
        price_bucket(avg_item, "items").alias("bucket"),
    )


def customer_money(per: DataFrame) -> DataFrame:
    """The customer summary for printing, of totals per customer: without mean
    and median, money and the ratio at two decimals. Rounded are the exact
    sums and quotients, half up; only a sum that no DECIMAL holds is rounded as
    the double it is."""
    avg_item = safe_div("spend", "items")
    exact = per.select(
        "*",
        F.col("spend_dec").try_cast("decimal(27,10)").alias("_s"),
        F.col("items_dec").try_cast("decimal(22,4)").alias("_i"),
        F.col("rows").cast("decimal(18,0)").alias("_n"),
        F.col("high").cast("decimal(18,0)").alias("_h"),
    )
    average = F.when(F.col("_i") > 0, hundredths("_s", "_i")).when(F.col("_i").isNotNull(), F.lit(0.0))
    return exact.select(
        "customer_id",
        F.col("rows").alias("transactions"),
        F.col("items").alias("total_items"),
        F.coalesce(F.round("_s", 2).cast("double"), money("spend")).alias("total_spend"),
        F.coalesce(average, money(avg_item)).alias("avg_price_per_item"),
        hundredths("_h", "_n").alias("high_price_tx_ratio"),
        price_bucket(avg_item, "items").alias("bucket"),
    )


def customer_summary_money(customers: DataFrame) -> DataFrame:
    return customer_money(CUSTOMERS.totals(customers, "customer_id"))


def month_table(per: DataFrame) -> DataFrame:
    return per.select(MONTH, F.col("rows").alias("tx_count"), F.try_divide("price", "prices").alias("avg_price")).orderBy(F.col(MONTH).asc_nulls_first())


def monthly_summary(malls: DataFrame) -> DataFrame:
    return month_table(MALLS.totals(malls, MONTH))


def category_table(per: DataFrame) -> DataFrame:
    spend = F.coalesce(F.col("spend"), F.lit(0.0))
    return per.select("category", F.col("rows").alias("tx"), spend.alias("total_spend"), (spend / F.col("rows")).alias("avg_spend_per_tx")).orderBy(
        F.desc("avg_spend_per_tx"), F.asc("category")
    )


def category_avg_spend(categories: DataFrame) -> DataFrame:
    return category_table(CATEGORIES.totals(categories.where(non_empty("category")), "category"))


def invoice_baskets(baskets: DataFrame) -> DataFrame:
    per = BASKETS.totals(baskets, "invoice_no", "customer_id", "shopping_mall", MONTH, count={"basket_category_count": "category"})
    return per.select(
        "invoice_no",
        "customer_id",
        "shopping_mall",
        MONTH,
        F.col("spend").alias("basket_spend"),
        F.col("items").alias("basket_items"),
        "basket_category_count",
    )


def mall_month_extended(baskets: DataFrame) -> DataFrame:
    """Mean basket value and items per mall and month."""
    own = ("invoice_no", "customer_id", "shopping_mall", MONTH)
    # categories are merged away first, so that a row is a basket (or a limb of one)
    sums = [F.sum(c).alias(c) for c in ("rows", "spend_exact", "items_exact", "spend_special", "items_special")]
    sums += [F.sum(c).cast(AMOUNT).alias(c) for c in ("spend_limb", "items_limb")]
    per = BASKETS.totals(baskets.groupBy(*own, LIMB).agg(*sums), "shopping_mall", MONTH, count={"num_invoices": "rows"})
    return per.select(
        "shopping_mall",
        MONTH,
        F.col("spend").alias("total_revenue"),
        "num_invoices",
        (F.col("spend") / F.col("num_invoices")).alias("avg_basket_value"),
        (F.col("items") / F.col("num_invoices")).alias("avg_basket_items"),
    ).orderBy("shopping_mall", F.col(MONTH).asc_nulls_first())


def age_band_category(bands: DataFrame) -> DataFrame:
    per = BANDS.totals(bands, "age_band", "category")
    return per.select("age_band", "category", F.col("spend").alias("total_revenue"), F.col("items").alias("items_sold")).orderBy(
        "age_band", F.desc("total_revenue"), "category"
    )


def payment_behavior(payments: DataFrame) -> DataFrame:
    per = PAYMENTS.totals(payments, "shopping_mall", "age_band", "payment_method")
    return per.select("shopping_mall", "age_band", "payment_method", F.col("spend").alias("total_revenue"))


def mall_revenue(malls: DataFrame, *by: str) -> DataFrame:
    """Revenue per mall, or per mall and month."""
    keys = by or ("shopping_mall",)
    return MALLS.totals(malls, *keys).select(*keys, F.col("spend").alias("total_revenue"))


def mall_counts(malls: DataFrame) -> DataFrame:
    per = MALLS.totals(malls, "shopping_mall")
    return per.select("shopping_mall", F.col("rows").alias("count")).orderBy(F.desc("count"), F.col("shopping_mall").asc_nulls_first())
