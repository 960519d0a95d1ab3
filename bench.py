"""Benchmark: headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

(default 5) runs per query, each forced with a ``noop`` write. Queries run
twice over: from the raw star-schema tables (``<name>``: clean on the fly)
and from a silver table written once (``<name>@silver``), so the cost of
cleaning per table shows. Prints ONE JSON line on stdout.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "4"))
RUNS = int(os.environ.get("BENCH_RUNS", "5"))
MEM = os.environ.get("BENCH_MEM", "6g")

# from the raw tables (joins + cleaning + operator)
RAW_QUERIES = [
    "customer_summary",
    "monthly_summary",
    "category_top10",
    "numeric_distributions",
    "invoice_baskets",
    "mall_month_extended",
    "mall_revenue",
    "mall_revenue_repartitioned",
    "mall_month_revenue_year",
    "mall_join_regular",
    "mall_join_broadcast",
    "freq_category",
    "top_customers_with_gender",
    "cluster_outcomes",
    "edge_nodes",
    "sample_rows",
]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("souk-bench")
        .config("spark.driver.memory", MEM)
        .config("spark.sql.shuffle.partitions", str(max(8, 2 * CPUS)))
        .config("spark.sql.adaptive.enabled", "true")
        # HotSpot does not JIT methods above 8000 bytes of bytecode; past that
        # a fused stage is better run by Spark's own expression evaluators
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    t = time.perf_counter()
    fn()
    return time.perf_counter() - t


def measure(fn) -> float:
    fn()  # warm-up
    return statistics.median(timed(fn) for _ in range(RUNS))


def main() -> None:
    from souk.operators import clusters as CL
    from souk.operators import joins as J
    from souk.operators import kpis as K
    from souk.operators import layout as L
    from souk.plans.catalog import QUERIES, silver
    from souk.schema import SILVER_SCHEMA
    from souk.session import ensure_checkpoint_dir, scratch_path
    from souk.sources import io

    spark = session()
    ensure_checkpoint_dir(spark)
    results: dict[str, float] = {}

    for name in RAW_QUERIES:
        q = QUERIES[name]
        results[name] = measure(lambda q=q: force(q(spark, SF_DIR)))

    # silver written once (partitioned parquet), then gold from it
    paths = []

    def write_silver_once():
        p = scratch_path(spark, "bench-silver")
        paths.append(p)
        io.write_silver(silver(spark, SF_DIR), p)

    results["silver_write"] = measure(write_silver_once)
    s = io.read_table(spark, paths[-1], "parquet", schema=SILVER_SCHEMA)
    dim_path = scratch_path(spark, "bench-dimension")
    io.write_table(J.mall_dimension(s), dim_path)
    dim = io.read_table(spark, dim_path)
    from_silver = {
        "customer_summary": lambda: K.customer_summary(s),
        "monthly_summary": lambda: K.monthly_summary(s),
        "mall_month_extended": lambda: K.mall_month_extended(s),
        "mall_revenue": lambda: L.mall_revenue(s),
        "mall_revenue_repartitioned": lambda: L.mall_revenue(s, repartition=8),
        "mall_month_revenue": lambda: L.mall_month_revenue(s),
        "mall_month_revenue_year": lambda: L.mall_month_revenue(s, year=1996),
        "mall_join_regular": lambda: J.join_mall_dim(s, dim, "merge"),
        "mall_join_broadcast": lambda: J.join_mall_dim(s, dim, "broadcast"),
        "top30_overall": lambda: CL.top_entities(CL.category_customer_edges(s), 30),
    }
    for name, build in from_silver.items():
        results[f"{name}@silver"] = measure(lambda b=build: force(b()))

    total = sum(results.values())
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_seconds",
                "value": round(total, 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in results.items()},
                "sf": Path(SF_DIR).name.removeprefix("sf"),
                "cpus": CPUS,
                "runs": RUNS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
