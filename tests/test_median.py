"""Exact median against brute force: groups of one value, of a few values, and
a third of all rows, with every number of ranges."""

import duckdb
import pytest
from pyspark.sql import functions as F

from souk.operators.clusters import cluster_outcomes
from souk.operators.quantiles import exact_median


def test_small_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", 2.0), ("b", 5.0), ("b", 1.0), ("c", None), (None, 4.0)], "k string, v double")
    got = {r.k: (r.n, r.median) for r in exact_median(df, ["k"], "v").collect()}
    assert got == {"a": (3, 2.0), "b": (2, 3.0), None: (1, 4.0)}
    assert exact_median(df.limit(0), ["k"], "v").collect() == []


@pytest.mark.parametrize("ranges", [1, 2, 3, 50])
def test_hot_and_flat_groups(spark, sf_dir, ranges):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    price = F.round(F.col("l_extendedprice") / 100)
    df = li.select(
        # a third of all rows; one value; five values; the rest
        F.when(F.col("l_orderkey") % 3 == 0, F.lit("hot"))
        .when(F.col("l_orderkey") % 3 == 1, F.concat(F.lit("flat"), F.col("l_linenumber") % 2))
        .otherwise(F.col("l_linenumber").cast("string"))
        .alias("k"),
        price.alias("p"),
        F.col("l_linenumber").alias("l"),
    )
    df = df.select("k", F.when(F.col("k") == "flat0", F.lit(7.5)).when(F.col("k") == "flat1", F.col("p") % 5).otherwise(F.col("p")).alias("v"))
    got = {r.k: (r.n, r.median) for r in exact_median(df, ["k"], "v", ranges=ranges).collect()}
    pdf = df.toPandas()
    con = duckdb.connect()
    want = {k: (n, m) for k, n, m in con.execute("SELECT k, count(v), median(v) FROM pdf GROUP BY k").fetchall()}
    assert got == want


def test_many_rows_of_few_prices(spark):
    rows = spark.range(1_500_000).select(F.lit("shoes").alias("entity"), (F.col("id") % 5 * 10.0 + 1).alias("price"))
    r = cluster_outcomes(rows).first()
    assert (r["count"], r.median) == (1_500_000, 21.0)


def test_no_raw_rows_are_exchanged(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_linenumber").alias("k"), F.col("l_quantity").alias("v"))
    counts = df.where("v is not null").groupBy("k", "v").count()
    assert counts.count() < df.count()
    plan = exact_median(df, ["k"], "v")._jdf.queryExecution().executedPlan().toString()
    # the plan starts from the written, collapsed rows
    assert "Scan ExistingRDD" in plan and "FileScan" not in plan
