"""Plan-shape tests: the physical strategy each operator is meant to get."""

import contextlib
import io as _io

from pyspark.sql import functions as F

from souk.operators import clean as C
from souk.operators import clusters as CL
from souk.operators import freq as FQ
from souk.operators import joins as J
from souk.operators import kpis as K
from souk.operators import layout as L
from souk.operators.clean import silver
from souk.schema import SILVER_SCHEMA
from souk.session import scratch_path
from souk.sources import io
from souk.sources.fixture import malls, transactions_raw


def plan(df, mode="formatted"):
    buf = _io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def written_silver(spark, sf_dir):
    path = scratch_path(spark, "plan-silver")
    io.write_silver(silver(transactions_raw(spark, sf_dir)), path)
    return path, io.read_table(spark, path, "parquet", schema=SILVER_SCHEMA)


def test_dimension_joins(spark, sf_dir):
    s = silver(transactions_raw(spark, sf_dir))
    dim = J.mall_dimension(malls(spark, sf_dir))
    regular = plan(J.join_mall_dim(s, dim, "merge"), "simple")
    assert "SortMergeJoin" in regular and "BroadcastHashJoin LeftOuter" not in regular
    bc = plan(J.join_mall_dim(s, dim, "broadcast"), "simple")
    assert "BroadcastHashJoin" in bc and "LeftOuter" in bc
    # the fact rows are read once and not moved
    assert bc.count("lineitem.parquet") == 1 and bc.count("Exchange hashpartitioning(shopping_mall") <= 1


def test_broadcast_falls_back_when_too_big(spark, sf_dir):
    s = silver(transactions_raw(spark, sf_dir))
    dim = J.mall_dimension(malls(spark, sf_dir))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin [shopping_mall" in plan(J.join_mall_dim(s, dim, "broadcast", max_bytes=3), "simple")
        assert "BroadcastHashJoin [shopping_mall" in plan(J.join_mall_dim(s, dim, "broadcast"), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_quality_filter_casts_each_number_twice_at_most(spark, sf_dir):
    path = scratch_path(spark, "plan-raw")
    io.write_table(transactions_raw(spark, sf_dir).limit(10), path, fmt="csv")
    p = silver(io.read_transactions(spark, path))._jdf.queryExecution().optimizedPlan().toString()
    (line,) = [ln for ln in p.splitlines() if ln.lstrip("+- ").startswith("Filter")]
    assert line.count("try_cast") <= 4  # two numbers
    staged = scratch_path(spark, "plan-staged")
    io.write_table(C.staged(io.read_transactions(spark, path)), staged)
    p = C.silver_of(io.read_table(spark, staged))._jdf.queryExecution().optimizedPlan().toString()
    assert "try_cast" not in p


def test_one_scan_per_table(spark, sf_dir):
    s = transactions_raw(spark, sf_dir).select("category", "customer_id")
    assert plan(CL.edge_nodes(s), "simple").count("lineitem.parquet") == 1
    top = CL.top_entities(s, 30)
    assert plan(CL.top_diff(top, CL.top_entities(s, 20)), "simple").count("lineitem.parquet") == 2
    assert "rangepartitioning" not in plan(FQ.duplicate_keys(transactions_raw(spark, sf_dir)), "simple")


def test_year_filter_prunes_partitions(spark, sf_dir):
    _, s = written_silver(spark, sf_dir)
    p = plan(L.mall_month_revenue(s, year=1996))
    assert "PartitionFilters: [isnotnull(year_month" in p and "1996-01" in p
    # a filter on a non-partition column only reaches the reader as a pushed filter
    q = plan(s.filter(F.col("invoice_year") == 1996).groupBy("shopping_mall").count())
    assert "PushedFilters: [IsNotNull(invoice_year), EqualTo(invoice_year,1996)]" in q
    assert "PartitionFilters" not in q


def test_column_pruning_reaches_scan(spark, sf_dir):
    _, s = written_silver(spark, sf_dir)
    p = plan(L.mall_revenue(s))
    read = [ln for ln in p.splitlines() if "ReadSchema" in ln][0]
    assert "quantity" in read and "price" in read and "customer_id" not in read


def test_repartitioned_revenue_has_one_exchange(spark, sf_dir):
    _, s = written_silver(spark, sf_dir)
    p = plan(L.mall_revenue(s, repartition=8), "simple")
    assert p.count("Exchange hashpartitioning(shopping_mall") == 1 and "Coalesce 8" in p
    assert L.mall_revenue(s, repartition=3).rdd.getNumPartitions() <= 3


def test_top_n_is_take_ordered(spark, sf_dir):
    s = silver(transactions_raw(spark, sf_dir))
    assert "TakeOrderedAndProject" in plan(K.category_top(s, 10), "simple")
    assert "TakeOrderedAndProject" in plan(K.top_customers_by_quantity(s, 10), "simple")


def test_partitioned_write_rebalances(spark, sf_dir):
    s = silver(transactions_raw(spark, sf_dir))
    p = plan(io.clustered_for_write(s, ["year_month", "shopping_mall"]), "simple")
    assert "REBALANCE_PARTITIONS_BY_COL" in p


def test_aggregates_are_partial_before_exchange(spark, sf_dir):
    s = silver(transactions_raw(spark, sf_dir))
    p = plan(K.customer_summary(s), "simple")
    assert "partial_percentile_approx" in p and "partial_sum" in p


def test_bucketed_silver_needs_no_exchange(spark, sf_dir):
    from souk.operators import kpis as K
    from souk.plans.catalog import bucketed

    table = bucketed(spark, sf_dir)
    for build in (K.customer_summary, K.invoice_baskets):
        plan = build(table)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan, build.__name__
        assert "Bucketed: true" in plan


def test_a_lookup_skips_row_groups(spark, sf_dir):
    """Scanned rows of one customer's lines: those of the files that hold any."""
    from pyspark.sql import functions as F

    from souk.plans.catalog import silver
    from souk.schema import SILVER_SCHEMA
    from souk.session import scratch_path
    from souk.sources import io

    path = scratch_path(spark, "lookup")
    io.write_silver(silver(spark, sf_dir), path)
    s = io.read_table(spark, path, schema=SILVER_SCHEMA)
    total = s.count()
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("length")
    assert listed.agg(F.max("length")).first()[0] < 32_768  # filters fit their few values
    for column in ("customer_id", "invoice_no"):
        key = s.agg(F.min(column)).first()[0]
        found = s.where(F.col(column) == key)
        rows = found.collect()
        holding = s.withColumn("file", F.input_file_name())
        files = holding.where(F.col(column) == key).select("file").distinct()
        most = holding.join(files, "file").count()
        scan = found._jdf.queryExecution().executedPlan().collectLeaves().head()
        read = scan.metrics().get("numOutputRows").get().value()
        assert rows and len(rows) <= read <= most < total
