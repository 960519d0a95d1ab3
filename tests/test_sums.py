"""Sums and means keep every value, whatever its size or fineness."""

import pytest

from souk.operators import kpis as K
from souk.operators import layout as L

COLUMNS = "category string, customer_id string, shopping_mall string, year_month string, invoice_no string, quantity double, price double"


def rows(spark, pairs):
    return spark.createDataFrame([("c", "C1", "m", "2023-01", "I1", q, p) for q, p in pairs], COLUMNS)


@pytest.mark.parametrize(
    "pairs,spend",
    [
        ([(1.0, 10.0), (1.0, 2e12)], 2e12 + 10),
        ([(1.0, 1e15), (2.0, 0.5)], 1e15 + 1),
        ([(0.00004, 50000.0)] * 3, 6.0),
        ([(3.0, 0.00004)], 0.00012),
        ([(1e14, 1e14)], 1e28),
        ([(0.1, 0.1)] * 10, 0.1),
        ([(1.0, None), (None, 2.0), (1.0, 5.0)], 5.0),
    ],
)
def test_spend(spark, pairs, spend):
    tx = rows(spark, pairs)
    assert K.category_avg_spend(tx).first().total_spend == pytest.approx(spend, rel=1e-15)
    assert L.mall_revenue(tx).first().total_revenue == pytest.approx(spend, rel=1e-15)
    assert K.invoice_baskets(tx).first().basket_spend == pytest.approx(spend, rel=1e-15)
    assert K.mall_month_extended(tx).first().total_revenue == pytest.approx(spend, rel=1e-15)


def test_means_count_what_they_sum(spark):
    tx = rows(spark, [(1.0, 10.0), (1.0, 2e12), (5e14, None)])
    got = {r.feature: r for r in K.numeric_distributions(tx).collect()}
    assert got["price"].mean == (2e12 + 10) / 2 and got["price"].max == 2e12 and got["price"]["count"] == 2
    assert got["quantity"].mean == (5e14 + 2) / 3
    assert K.monthly_summary(tx).first().avg_price == (2e12 + 10) / 2
    assert K.top_customers_by_quantity(tx).first().total_quantity == 5e14 + 2


def test_nothing_to_sum(spark):
    tx = rows(spark, [(None, None)])
    assert L.mall_revenue(tx).first().total_revenue is None
    assert K.category_avg_spend(tx).first().total_spend == 0.0
