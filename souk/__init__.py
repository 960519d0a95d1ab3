"""souk: retail transaction analytics on Spark.

functions/  column expressions (cleaning, derived values, quality rules)
sources/    the raw invoice view of the test tables, readers and writers
operators/  DataFrame -> DataFrame operators (cleaning, KPIs, frequencies,
            clusters, joins, layout, sampling, model, exact median)
plans/      the registered queries and their DuckDB oracle SQL
jobs/       the spark-submit job that builds silver and the gold tables
"""
