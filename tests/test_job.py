"""The batch job end to end on the smallest tables, in every sink format."""

import pytest

from souk.jobs import build_tables as B
from souk.operators.clean import RAW_COLUMNS
from souk.schema import SILVER_SCHEMA
from souk.session import scratch_path
from souk.sources import io
from souk.sources.fixture import transactions_raw

TABLES = {
    "silver/transactions_clean",
    "quality/rejects",
    *(f"gold/{t}" for t in ("customer_summary", "customer_summary_money", "bucket_counts", "monthly_summary", "category_avg_spend", "category_top10")),
    *(f"gold_b/{t}" for t in ("invoice_baskets", "mall_month_extended", "age_band_category", "payment_behavior", "mall_counts", "mall_dimension")),
    *(f"gold_b/{t}" for t in ("mall_agg_skewed", "mall_agg_balanced", "mall_month_baseline", "mall_month_optimized", "join_regular", "join_broadcast")),
    *(f"gold_b/{t}" for t in ("ml_predictions", "ml_auc")),
    *(f"frequencies/freq_{c}" for c in ("category", "payment_method", "gender", "shopping_mall")),
    *(f"frequencies/{t}" for t in ("top5_age", "top5_shopping_mall", "missing_fields", "text_profile")),
    *(f"customers/{t}" for t in ("demographics", "customer_counts", "first_gender", "top_customers_with_gender", "top_customers_by_quantity")),
    *(f"lines/{t}" for t in ("skinny", "sample", "malformed")),
    *(f"signals/{t}" for t in ("numeric_distributions", "signals_ranked", "monthly_summary_raw", "monthly_summary_by_split")),
    *(f"clusters/{t}" for t in ("entity_counts", "edges_thresholded", "cluster_sizes", "cluster_outcomes", "top30_overall", "top30_clusters", "top30_diff", "edge_sample", "edge_nodes")),
}


def rows(spark, written, name, fmt):
    return io.read_table(spark, written[name], fmt).count() if fmt == "parquet" else spark.read.option("header", "true").csv(written[name]).count()


@pytest.mark.parametrize("fmt", ["parquet", "tsv"])
def test_build_tables(spark, sf_dir, fmt):
    out = scratch_path(spark, f"job-{fmt}")
    args = B.parse_args(["--sf-dir", sf_dir, "--out-base", out, "--format", fmt, "--year", "1996", "--run-ml"])
    written = B.run(spark, args)
    assert set(written) == TABLES
    s = io.read_table(spark, written["silver/transactions_clean"], fmt, schema=SILVER_SCHEMA)
    n = s.count()
    assert rows(spark, written, "gold/customer_summary", fmt) == s.select("customer_id").distinct().count()
    assert rows(spark, written, "gold_b/join_regular", fmt) == rows(spark, written, "gold_b/join_broadcast", fmt) == n
    top = spark.read.option("header", "true").csv(written["gold/category_top10"])
    assert 0 < top.count() <= 10 and len(top.inputFiles()) == 1


def test_raw_input_is_read_once(spark, sf_dir, monkeypatch, tmp_path):
    """CSV input, read by one job only; then silver alone, without any."""
    raw = str(tmp_path / "raw")
    transactions_raw(spark, sf_dir).select(*RAW_COLUMNS).limit(500).write.option("header", "true").option("escape", '"').csv(raw)
    staged = []
    write = io.write_table

    def watch(df, path, *a, **kw):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        if "csv" in plan.lower():
            staged.append(path)
        return write(df, path, *a, **kw)

    monkeypatch.setattr(B.io, "write_table", watch)
    written = B.run(spark, B.parse_args(["--input", raw, "--out-base", str(tmp_path / "out")]))
    assert len(staged) == 1 and "staged" in staged[0]
    assert set(written) == TABLES - {"gold_b/mall_month_optimized", "gold_b/ml_predictions", "gold_b/ml_auc"}

    staged.clear()
    again = B.run(spark, B.parse_args(["--silver", written["silver/transactions_clean"], "--out-base", str(tmp_path / "again")]))
    assert staged == [] and all(t.startswith("gold") for t in again)
    for name in ("gold/customer_summary", "gold_b/invoice_baskets"):
        a, b = io.read_table(spark, written[name]), io.read_table(spark, again[name])
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_malformed_lines_are_set_aside_in_the_one_pass(spark, tmp_path):
    """Lines with too few or too many fields: kept as they stood, in a folder
    that a scan of the others doesn't open; what they hold is judged as before."""
    raw = tmp_path / "raw.csv"
    head = "invoice_no,customer_id,gender,age,category,quantity,price,payment_method,invoice_date,shopping_mall"
    good = ["I1,C1,F,30,Toys,2,10.0,Cash,1/2/2021,M1", 'I2,C2,F,30,"Toys, big",2,10.0,Cash,1/2/2021,M1', "I3,NA,F,30,Toys,2,10.0,Cash,1/2/2021,M1"]
    bad = ["I4,C4", "I5,C5,F,30,Toys,2,10.0,Cash,1/2/2021,M1,more"]
    raw.write_text("\n".join([head, *good, *bad]) + "\n")
    written = B.run(spark, B.parse_args(["--input", str(raw), "--out-base", str(tmp_path / "out")]))
    lines = io.read_table(spark, written["lines/malformed"]).collect()
    assert {(r.malformed_line, r.passes) for r in lines} == {(bad[0], False), (bad[1], True)}
    assert io.malformed_rows(spark, str(raw)) == 2
    silver = io.read_table(spark, written["silver/transactions_clean"])
    assert {r.invoice_no for r in silver.collect()} == {"I1", "I2", "I5"}
    rejects = {r.rule: (r.rejected, r.rows) for r in io.read_table(spark, written["quality/rejects"]).collect()}
    assert rejects["any"] == (2, 5) and rejects["ids_present"] == (1, 5) and rejects["price_in_bounds"] == (1, 5)
    (run,) = (tmp_path / "out/state/staged").glob("run=*")
    assert {p.name for p in run.iterdir() if p.is_dir()} == {"is_malformed=false", "is_malformed=true"}
