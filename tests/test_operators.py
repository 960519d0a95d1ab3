"""Operator semantics on small hand-made inputs."""

import hashlib

from pyspark.sql import functions as F

from souk.operators import clusters as CL
from souk.operators import freq as FQ
from souk.operators import kpis as K
from souk.operators import layout as L
from souk.operators import sampling as S
from souk.operators.clean import preview


def tx(spark, rows):
    cols = "invoice_no string, customer_id string, category string, quantity double, price double, shopping_mall string, year_month string, gender string"
    return spark.createDataFrame(rows, cols)


def test_multi_word_values_stay_whole(spark):
    df = tx(
        spark,
        [
            ("I1", "C1", "Food & Beverage", 1.0, 5.0, "Mall of Istanbul", "2022-01", "Male"),
            ("I2", "C2", "Food & Beverage", 1.0, 7.0, "Mall of Istanbul", "2022-01", "Male"),
            ("I3", "C2", "Books", 2.0, 3.0, "Kanyon", "2022-02", "Male"),
        ],
    )
    assert FQ.frequency(df, "category").collect()[0].asDict() == {"category": "Food & Beverage", "count": 2}
    assert FQ.frequency(df, "shopping_mall").collect()[0].shopping_mall == "Mall of Istanbul"
    cp = CL.category_prices(df.withColumn("price", F.col("price").cast("string")))
    out = {r.entity: (r["count"], r.mean, r.median) for r in CL.cluster_outcomes(cp).collect()}
    assert out == {"Food & Beverage": (2, 6.0, 6.0), "Books": (1, 3.0, 3.0)}


def test_frequency_order_and_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), ("",), (None,)], "v string")
    assert [(r.v, r["count"]) for r in FQ.frequency(df, "v").collect()] == [("c", 2), ("a", 1), ("b", 1)]
    assert [r.v for r in FQ.top_values(df, "v", 2).collect()] == ["c", "a"]


def test_category_prices_numeric_text_only(spark):
    df = spark.createDataFrame([("A", "12"), ("A", "1,500.25"), ("A", "-1"), ("A", " 3.50 "), ("A", "x")], "category string, price string")
    assert sorted(r.price for r in CL.category_prices(df).collect()) == [3.5, 12.0]


def test_threshold_semi_join_and_sizes(spark):
    e = spark.createDataFrame([("a", "c1")] * 3 + [("b", "c2")] + [("a", "c2")], "category string, customer_id string")
    counts = CL.entity_counts(e, 2)
    kept = CL.threshold_edges(e, counts)
    assert kept.count() == 4
    assert [(r.category, r["count"]) for r in CL.cluster_sizes(kept).collect()] == [("a", 4)]
    diff = CL.top_diff(CL.top_entities(kept, 30), CL.top_entities(e, 30)).collect()
    assert [(r.category, r["count"], r.side) for r in diff] == [("b", 1, ">")]


def test_edge_nodes(spark):
    e = spark.createDataFrame([("a", "c1"), ("a", "c1"), ("a", "c2"), ("b", "c1"), ("b", "")], "category string, customer_id string")
    got = {r.node: (r.role, r.degree) for r in CL.edge_nodes(e).collect()}
    assert got == {"a": ("entity", 2), "b": ("entity", 1), "c1": ("customer", 2), "c2": ("customer", 1)}


def test_first_per_key_uses_explicit_order(spark):
    df = spark.createDataFrame([("C1", "Male", "I9"), ("C1", "Female", "I1"), ("C2", "Male", "I5")], "customer_id string, gender string, invoice_no string")
    got = {r.customer_id: r.gender for r in FQ.first_per_key(df, "customer_id", "gender", ["invoice_no"]).collect()}
    assert got == {"C1": "Female", "C2": "Male"}


def test_top_customers_with_gender_order(spark):
    rows = [("C2", "Male", "I1")] * 3 + [("C1", "Female", "I2")] * 3 + [("C3", "Male", "I3")] + [("NA", "Male", "I4")] * 5
    df = spark.createDataFrame(rows, "customer_id string, gender string, invoice_no string")
    got = [(r.customer_id, r["count"], r.gender) for r in FQ.top_customers_with_gender(df, 2).collect()]
    assert got == [("C1", 3, "Female"), ("C2", 3, "Male")]


def test_mall_revenue_variants_agree(spark):
    rows = [("I%d" % i, "C1", "Books", 1.0 + i % 3, 10.25, "M%d" % (i % 4), "2022-01", "Male") for i in range(200)]
    df = tx(spark, rows)
    a = {r.shopping_mall: r.total_revenue for r in L.mall_revenue(df).collect()}
    b = {r.shopping_mall: r.total_revenue for r in L.mall_revenue(df, repartition=3).collect()}
    assert a == b


def test_mod_buckets(spark):
    got = [tuple(r) for r in FQ.mod_bucket_counts(spark.createDataFrame([(1,), (11,), (20,), (3,)], "k long"), "k", 10).collect()]
    assert got == [(0, 1), (1, 2), (3, 1)]


def test_missing_fields_and_duplicates(spark):
    df = spark.createDataFrame([("I1", None, 3), ("I1", "", None), ("", "x", 1)], "invoice_no string, customer_id string, age int")
    got = {r.field: (r.rows, r.missing) for r in FQ.missing_fields(df).collect()}
    assert got == {"invoice_no": (3, 1), "customer_id": (3, 2), "age": (3, 1)}
    assert [(r.invoice_no, r["count"]) for r in FQ.duplicate_keys(df).collect()] == [("I1", 2)]


def test_sample_rows_is_exact_and_repeatable(spark):
    df = spark.range(0, 5000).withColumn("k", F.col("id") % 7)
    a = S.sample_rows(df, 100, 42).collect()
    b = S.sample_rows(df.repartition(13), 100, 42).collect()
    assert len(a) == 100 and sorted(a) == sorted(b)
    assert S.sample_rows(df, 100, 7).collect() != a
    assert S.sample_rows(df.limit(10), 100).count() == 10


def test_sample_is_uniform_over_repeated_rows(spark):
    df = spark.createDataFrame([("a",)] * 500 + [("b",)] * 500, "k string")
    drawn = [sum(r.k == "a" for r in S.sample_rows(df, 100, seed).collect()) for seed in range(6)]
    assert all(25 < n < 75 for n in drawn) and len(set(drawn)) > 1


def test_sample_of_repeated_rows_against_all_hashes(spark):
    """The n smallest of all hashes, with a hot row, nulls and fields that join alike."""
    md5 = lambda *x: hashlib.md5("\x1f".join(x).encode()).hexdigest()
    rows = [("a", "b")] * 300 + [("a\x1fb", "c"), ("a", "b\x1fc"), (None, "c"), ("\x00", "c")] * 9 + [(str(i), None) for i in range(50)]
    hashes, seen = [], {}
    for k, v in rows:
        i = seen[k, v] = seen.get((k, v), 0) + 1
        first = md5(*("\x00" if x is None else x for x in (k, v)), "1", "9")
        hashes.append((first if i == 1 else md5(first, str(i), "9"), (k, v)))
    got = sorted((tuple(r) for r in S.sample_rows(spark.createDataFrame(rows, "k string, v string").repartition(5), 120, 9).collect()), key=repr)
    ambiguous = {r for r in seen if r[1] != "b" and r[0] in ("a", "a\x1fb", None, "\x00")}
    plain = lambda x: [r for r in x if r not in ambiguous]
    want = sorted((r for _, r in sorted(hashes, key=lambda x: x[0])[:120]), key=repr)
    assert len(got) == 120 and plain(got) == plain(want)
    assert S.sample_rows(spark.createDataFrame(rows, "k string, v string"), 1000, 9).exceptAll(spark.createDataFrame(rows, "k string, v string")).isEmpty()


def test_sample_exchanges_hashes_not_rows(spark, sf_dir):
    """Before the drawn hashes are known, no exchange carries a column of the rows."""
    df = spark.read.parquet(f"{sf_dir}/customer.parquet")
    lines = S.sample_rows(df, 10)._jdf.queryExecution().executedPlan().toString().splitlines()
    join = next(i for i, ln in enumerate(lines) if "BroadcastHashJoin" in ln)
    moved = [lines[i + 1] for i, ln in enumerate(lines) if "Exchange hashpartitioning" in ln]
    assert len(moved) >= 2
    # above the join, one row per drawn hash and task; below it, hashes and counts
    assert "partial_first" in moved[0] and lines.index(moved[0]) < join
    assert all("partial_first" not in ln and "c_name" not in ln for ln in moved[1:])


def test_split_is_tied_to_key(spark):
    df = spark.range(0, 2000).select(F.concat(F.lit("I"), F.col("id").cast("string")).alias("invoice_no"))
    tr1, te1 = S.train_test_split(df)
    tr2, _ = S.train_test_split(df.repartition(7))
    assert sorted(tr1.collect()) == sorted(tr2.collect())
    assert tr1.count() + te1.count() == 2000
    assert 0.75 < tr1.count() / 2000 < 0.85


def test_preview_total_order(spark):
    df = spark.createDataFrame([("b", 2), ("a", None), ("a", 1)], "k string, v int")
    assert [tuple(r) for r in preview(df, 2, ["k"]).collect()] == [("a", None), ("a", 1)]


def test_signals_and_distributions(spark):
    rows = [("I1", "C1", "A", 1.0, 10.0, "M", "2022-01", "Male"), ("I2", "C1", "B", 3.0, 20.0, "M", "2022-01", "Male")]
    df = tx(spark, rows)
    d = {r.feature: r for r in K.numeric_distributions(df).collect()}
    assert d["quantity"]["count"] == 2 and d["quantity"].mean == 2.0 and d["quantity"].stddev == 1.0
    assert (d["price"]["min"], d["price"]["max"]) == (10.0, 20.0)
    sig = [(r.signal, r.kind, r.value) for r in K.signals_ranked(df).collect()]
    assert sig == [("quantity_mean", "simple", 2.0), ("price_mean", "simple", 15.0), ("B", "category_avg_spend", 60.0), ("A", "category_avg_spend", 10.0)]
