"""Every hash exchange feeding an aggregate carries partial aggregates, not
raw rows (map-side combine before each shuffle), for the aggregate queries."""

import contextlib
import io as _io

import pytest

import __spark_entry__ as E

Q = E.queries()

AGGREGATE_QUERIES = [
    "customer_summary",
    "bucket_counts",
    "monthly_summary",
    "category_avg_spend",
    "invoice_baskets",
    "mall_month_extended",
    "age_band_category",
    "payment_behavior",
    "mall_counts",
    "mall_revenue",
    "mall_revenue_repartitioned",
    "mall_month_revenue",
    "freq_category",
    "customer_counts",
    "top_customers_with_gender",
    "top_customers_by_quantity",
    "duplicate_invoices",
    "entity_counts",
    "cluster_sizes",
    "edge_nodes",
    "numeric_distributions",
    "missing_fields",
]


def plan_lines(df):
    buf = _io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("simple")
    return buf.getvalue().splitlines()


@pytest.mark.parametrize("name", AGGREGATE_QUERIES)
def test_exchanges_carry_partial_aggregates(spark, sf_dir, name):
    lines = plan_lines(Q[name](spark, sf_dir))
    exchanges = [i for i, ln in enumerate(lines) if "Exchange hashpartitioning" in ln or "Exchange SinglePartition" in ln]
    assert exchanges, name
    for i in exchanges:
        child = lines[i + 1]
        # HashAggregate, or SortAggregate when a buffer holds strings (min_by)
        assert "Aggregate(" in child, f"{name}: raw rows under {lines[i].strip()[:80]}"
