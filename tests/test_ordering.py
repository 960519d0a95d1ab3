"""Row order of ordered tables (O1); the oracle compares without order."""

import pytest

import __spark_entry__ as E

Q = E.queries()


def is_sorted(rows, spec):
    for a, b in zip(rows, rows[1:]):
        for c, desc in spec:
            va, vb = a[c], b[c]
            if va == vb:
                continue
            if va is None:
                ok = not desc
            elif vb is None:
                ok = desc
            else:
                ok = va > vb if desc else va < vb
            if not ok:
                return False
            break
    return True


CASES = {
    "monthly_summary": [("year_month", False)],
    "category_avg_spend": [("avg_spend_per_tx", True), ("category", False)],
    "category_top10": [("avg_spend_per_tx", True), ("category", False)],
    "mall_counts": [("count", True), ("shopping_mall", False)],
    "freq_category": [("count", True), ("category", False)],
    "top5_ages": [("count", True), ("age", False)],
    "top5_malls": [("count", True), ("shopping_mall", False)],
    "top_customers_by_quantity": [("total_quantity", True), ("customer_id", False)],
    "top_customers_with_gender": [("count", True), ("customer_id", False)],
    "customer_counts": [("customer_id", False)],
    "mall_month_extended": [("shopping_mall", False), ("year_month", False)],
    "age_band_category": [("age_band", False), ("total_revenue", True), ("category", False)],
    "entity_counts": [("category", False)],
    "cluster_sizes": [("category", False)],
    "top30_overall": [("count", True), ("category", False)],
    "bucket_counts": [("bucket", False)],
    "mod_bucket_counts": [("bucket", False)],
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_order(spark, sf_dir, name):
    rows = Q[name](spark, sf_dir).collect()
    assert len(rows) > 0
    assert is_sorted(rows, CASES[name]), name
