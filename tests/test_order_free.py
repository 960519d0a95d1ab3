"""Sums of doubles: exact to the last place, alike over any partitioning."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from souk.functions import order_free as O
from souk.operators import kpis as K


def drawn(d):
    k = d.random()
    if k < 0.3:
        return d.uniform(-1e6, 1e6)
    if k < 0.5:
        return d.uniform(-1, 1) * 10.0 ** d.randint(-320, 307)
    if k < 0.6:
        return d.choice([1e300, -1e300, 1e-9, 5e-324, -5e-324, 2.0**52, 2.0**-52, 2.0**-1040, 2.0**-1074 * 3, 2.0**1020])
    if k < 0.7:
        return 2.0 ** d.randint(-1074, 1000) * d.choice([1, -1])
    return d.uniform(0, 1000)


def groups_of(d):
    for g in range(90):
        values = [drawn(d) for _ in range(d.randint(1, 40))]
        if g % 3 == 0:  # all that's large cancels
            values += [-v for v in values]
            values += [1e-9] if g % 2 else []
        if g % 7 == 1:
            values = [-abs(v) for v in values]
        if g % 5 == 2:
            values = [v for v in values if abs(v) < 1e-300] or [5e-324]
        yield values


def sums(spark, rows, parts):
    df = spark.createDataFrame(rows, "g int, v double").repartition(parts)
    state = O.with_limbs(df, ["v"]).groupBy("g", O.LIMB).agg(O.limb_sum(0).alias("a"), O.special_sum(F.col("v")).alias("s"))
    total = state.groupBy("g").agg(O.limbs("a").alias("l"), F.sum("s").alias("s")).select("g", O.value_of("l").alias("t"), "s")
    return {r.g: r.t if r.s is None else r.s for r in total.collect()}


def test_exact_and_order_free(spark):
    d = random.Random(5)
    groups = list(groups_of(d))
    rows = [(g, v) for g, values in enumerate(groups) for v in values]
    first = sums(spark, rows, 1)
    d.shuffle(rows)
    assert sums(spark, rows, 7) == first
    for g, values in enumerate(groups):
        exact = sum(map(Fraction, values))
        assert abs(Fraction(first[g] or 0) - exact) <= Fraction(math.ulp(float(exact))), values


@pytest.mark.parametrize(
    "values,want",
    [([1e300, 1e-9, -1e300], 1e-9), ([1e16, 1.0, -1e16], 1.0), ([0.1] * 10, 1.0), ([5e-324] * 3, 1.5e-323), ([1.7e308, 1.7e308, -1.7e308], 1.7e308), ([2.0**60, -1.0], 2.0**60), ([-(2.0**53), -1.0, -1.0], -(2.0**53) - 2)],
)
def test_single_sums(spark, values, want):
    assert sums(spark, [(1, v) for v in values], 3)[1] == want


def test_special_values(spark):
    inf, nan = float("inf"), float("nan")
    got = sums(spark, [(1, inf), (1, 1e300), (2, inf), (2, -inf), (3, nan), (4, -inf), (5, None), (6, 0.0), (6, None)], 2)
    assert got[1] == inf and math.isnan(got[2]) and math.isnan(got[3]) and got[4] == -inf
    assert got[5] is None and got[6] is None


def test_rows_without_rest_stay_single(spark):
    df = spark.range(10).withColumn("v", F.lit(None).cast("double"))
    assert O.with_limbs(df, ["v"]).count() == 10


def lines(spark, seed=8):
    """Invoice lines whose numbers no DECIMAL holds, and that cancel."""
    d = random.Random(seed)
    rows = []
    for k in range(600):
        price = d.choice([9.99, 1e-9, 1 / 3, 0.1 + 0.2, 12345.678901234, 1e300, -1e300, 2.5, None, 1e16, -1e16])
        quantity = d.choice([1.0, 2.0, 1e-7, 3.0, None, 1e15, -1e15, 0.1])
        rows.append((f"C{k % 7}", d.choice(["Toys", "Shoes", "", None]), quantity, price, d.choice(["2021-01", "2021-02", None])))
    return rows, spark.createDataFrame(rows, "customer_id string, category string, quantity double, price double, year_month string")


@pytest.mark.parametrize("table", [K.monthly_summary, K.category_avg_spend, K.top_customers_by_quantity, K.numeric_distributions, K.signals_ranked])
def test_tables_are_bit_equal_over_any_partitioning(spark, table):
    _, df = lines(spark)
    found = {repr(sorted(map(tuple, table(df.repartition(n)).collect()), key=repr)) for n in (1, 2, 7, 16)}
    assert len(found) == 1


def test_tables_against_exact_sums(spark):
    rows, df = lines(spark)
    near = lambda got, want: abs(Fraction(got) - want) <= 2 * Fraction(math.ulp(float(want)))
    for r in K.monthly_summary(df).collect():
        prices = [Fraction(p) for *_, p, m in rows if m == r.year_month and p is not None]
        assert near(r.avg_price, sum(prices) / len(prices))
    for r in K.top_customers_by_quantity(df).collect():
        assert near(r.total_quantity, sum(Fraction(q) for c, _, q, *_ in rows if c == r.customer_id and q is not None))
    for r in K.numeric_distributions(df).collect():
        values = [Fraction(x) for _, _, q, p, _ in rows for x in [q if r.feature == "quantity" else p] if x is not None]
        assert r["count"] == len(values) and near(r["mean"], sum(values) / len(values))


@pytest.mark.parametrize("shift", [0.0, 1e7, 0.1])
def test_deviation(spark, shift):
    d = random.Random(3)
    values = [shift + round(d.uniform(-5, 5), 3) for _ in range(500)]
    df = spark.createDataFrame([(v, v) for v in values], "quantity double, price double")
    exact = [Fraction(v) for v in values]
    mean = sum(exact) / len(exact)
    want = math.sqrt(sum((v - mean) ** 2 for v in exact) / len(exact))
    (a, b) = K.numeric_distributions(df.repartition(5)).collect()
    assert a.stddev == b.stddev == pytest.approx(want, abs=2e-6 if shift < 1e6 else 0.05)
    empty = K.numeric_distributions(df.limit(0)).collect()
    assert [(r["count"], r["mean"], r.stddev, r["min"]) for r in empty] == [(0, None, None, None)] * 2
