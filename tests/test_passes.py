"""What is needed more than once is made once; lines move as seldom as they can."""

import pytest

from souk.operators import clusters as CL
from souk.operators import model as M
from souk.operators import state as ST
from souk.operators.clean import silver
from souk.plans import catalog as Q
from souk.sources import io
from souk.sources.fixture import transactions_raw
from souk.sources.versions import Versions

WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def text_rows(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def from_lines(df):
    return any("lineitem" in f for f in df.inputFiles())


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, old)


def test_lines_are_not_moved_by_supplier_or_customer(spark, sf_dir, no_broadcast):
    many = transactions_raw(spark, sf_dir, few_orders=-1)
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(l_suppkey" not in plan and "hashpartitioning(s_nationkey" not in plan
    for part in plan.split("hashpartitioning(o_custkey")[1:]:
        # what is exchanged by customer is orders
        assert "lineitem.parquet" not in part.split("orders.parquet")[0]
    assert text_rows(many) == text_rows(transactions_raw(spark, sf_dir))


def test_rules_stay_above_the_parsed_columns(spark, sf_dir):
    plan = silver(transactions_raw(spark, sf_dir))._jdf.queryExecution().optimizedPlan().toString()
    assert not [ln for ln in plan.splitlines() if ln.lstrip("+-:| ").startswith("Filter") and "l_orderkey" in ln and "trim" in ln]


def test_rows_as_states_merge_to_the_state_of_all(spark):
    odd = [float("nan"), float("inf"), 1e300, -1e300, 1e-9, 0.1 + 0.2, 2.5, None, 0.0]
    rows = [(f"C{k % 3}", None if k % 7 == 0 else f"2021-0{k % 2 + 1}", odd[k % 9], odd[k % 5 + 4]) for k in range(120)]
    df = spark.createDataFrame(rows, "customer_id string, year_month string, quantity double, price double").coalesce(2)
    for st in (ST.CUSTOMERS, ST.CUSTOMER_PRICES):
        one, each = st.of(df), st.merged(st.each(df))
        assert one.dtypes == each.dtypes and text_rows(one) == text_rows(each)


def test_batches_read_stored_silver(spark, sf_dir, monkeypatch):
    seen, add = [], Versions.add
    monkeypatch.setattr(Versions, "add", lambda self, name, st, rows, *a, **k: (seen.append(from_lines(rows)), add(self, name, st, rows, *a, **k)))
    Q.q_append_merge_months(spark, sf_dir)
    assert seen == [False] * 3


@pytest.mark.parametrize("query, want", [("append_roundtrip", [False, False]), ("dynamic_overwrite", [True, False])])
def test_silver_is_made_once(spark, sf_dir, monkeypatch, query, want):
    seen, write = [], io.write_silver
    monkeypatch.setattr(io, "write_silver", lambda df, *a, **k: (seen.append(from_lines(df)), write(df, *a, **k)))
    Q.QUERIES[query](spark, sf_dir)
    assert seen == want


def test_fits_and_evaluations_read_stored_rows(spark, sf_dir, monkeypatch):
    seen, fit, judge = [], M.BinaryClassifier.fit_split, M.auc
    monkeypatch.setattr(M.BinaryClassifier, "fit_split", lambda self, rows, *a: (seen.append(from_lines(rows)), fit(self, rows, *a))[1])
    monkeypatch.setattr(M, "auc", lambda scored, *a: (seen.append(from_lines(scored)), judge(scored, *a))[1])
    for query in ("high_spend_predictions", "high_spend_auc", "basket_items_auc"):
        Q.QUERIES[query](spark, sf_dir)
    assert seen == [False] * 4


def test_cluster_values_are_made_once(spark, sf_dir):
    assert not from_lines(CL.cluster_outcomes(CL.category_prices(transactions_raw(spark, sf_dir))))


def test_lines_are_set_aside_without_a_sort(spark, sf_dir, monkeypatch):
    seen, write = [], io.write_table
    before = spark.conf.get(WRITERS)

    def told(df, path, *a, **k):
        if k.get("partition_by"):
            seen.append(df.sparkSession.conf.get(WRITERS))
        write(df, path, *a, **k)

    monkeypatch.setattr(io, "write_table", told)
    Q.q_quarantined_lines(spark, sf_dir)
    Q.q_rejected_by_rule(spark, sf_dir)
    assert seen == ["2", "2"] and spark.conf.get(WRITERS) == before
