"""Invariants taken from the committed outputs of the reference."""

from pyspark.sql import functions as F

from souk.operators import clusters as CL
from souk.operators import freq as FQ
from souk.operators import layout as L
from souk.operators.clean import silver
from souk.functions import trim_strings
from souk.sources.fixture import transactions_raw


def total(df, col="count"):
    return df.agg(F.sum(col)).first()[0]


def test_frequency_tables_sum_to_rows(spark, sf_dir):
    t = trim_strings(transactions_raw(spark, sf_dir))
    n = t.count()
    for c in ("category", "payment_method", "gender", "shopping_mall"):
        assert total(FQ.frequency(t, c)) == n, c


def test_cluster_sizes_sum_to_kept_edges(spark, sf_dir):
    e = CL.category_customer_edges(trim_strings(transactions_raw(spark, sf_dir)))
    kept = CL.threshold_edges(e, CL.entity_counts(e, 100))
    assert total(CL.cluster_sizes(kept)) == kept.count() < e.count()


def test_month_totals_equal_mall_totals(spark, sf_dir):
    s = silver(transactions_raw(spark, sf_dir))
    by_mall = {r.shopping_mall: r.total_revenue for r in L.mall_revenue(s).collect()}
    by_month = L.mall_month_revenue(s).groupBy("shopping_mall").agg(F.sum("total_revenue").alias("t")).collect()
    for r in by_month:
        assert abs(r.t - by_mall[r.shopping_mall]) <= 1e-6 * max(1.0, abs(r.t))
    assert {r.shopping_mall: r.total_revenue for r in L.mall_revenue(s, repartition=8).collect()} == by_mall
