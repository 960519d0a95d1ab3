"""Mergeable states and the job's append: A, then B, equals one build of both."""

import random

import pytest
from pyspark.sql import functions as F

from souk.jobs import build_tables as B
from souk.functions.cleaning import parse_invoice_date
from souk.operators import kpis as K
from souk.operators import layout as L
from souk.operators import state as ST
from souk.operators.clean import silver
from souk.schema import DATE_FORMATS, RAW_COLUMNS, SILVER_SCHEMA
from souk.session import scratch_path
from souk.sources import io
from souk.sources.fixture import transactions_raw
from souk.sources.versions import Versions


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    # by their text, as NaN isn't equal to itself
    x, y = (sorted(repr(tuple(r)) for r in df.select(*sorted(a.columns)).collect()) for df in (a, b))
    assert x == y


def odd_rows(spark):
    """Numbers that no DECIMAL of their column holds, null months, ties."""
    draw = random.Random(6)
    rows = []
    for k in range(400):
        price = draw.choice([9.99, 1e-9, 1 / 3, 0.1 + 0.2, 12345.678901234, 1e300, -1e300, 2.5, None])
        quantity = draw.choice([1.0, 2.0, 1e-7, 1e200, None, 3.0])
        month = draw.choice(["2021-01", "2021-02", None])
        rows.append((f"I{k % 60}", f"C{k % 7}" if k % 11 else None, draw.choice(["Toys", "Shoes", None]), quantity, price, draw.choice(["Cash", None]), draw.choice(["M1", "M2", None]), month, draw.choice(["0-19", "60+"])))
    return spark.createDataFrame(rows, "invoice_no string, customer_id string, category string, quantity double, price double, payment_method string, shopping_mall string, year_month string, age_band string")


def merged(spark, rows, parts, names):
    states_of = lambda n: [ST.STATES[n].of(rows.where(F.pmod(F.xxhash64(*rows.columns), F.lit(parts)) == k)) for k in range(parts)]
    return [ST.STATES[n].merged(*states_of(n)) for n in names]


@pytest.mark.parametrize("parts", [1, 4])
def test_merge_equals_one_state(spark, parts):
    path = scratch_path(spark, "odd")
    odd_rows(spark).write.parquet(path)
    rows = spark.read.parquet(path)
    for n in ("baskets", "customers", "malls"):
        (m,) = merged(spark, rows, parts, [n])
        same(m, ST.STATES[n].of(rows.repartition(3)))


def test_tables_equal_those_over_rows(spark, sf_dir):
    path = scratch_path(spark, "silver")
    silver(transactions_raw(spark, sf_dir)).write.parquet(path)
    s = spark.read.parquet(path)
    got = lambda f, *names: f(*merged(spark, s, 3, names))
    same(got(ST.customer_summary, "customers", "customer_prices"), K.customer_summary(s))
    same(got(ST.monthly_summary, "malls"), K.monthly_summary(s))
    same(got(ST.category_avg_spend, "categories"), K.category_avg_spend(s))
    same(got(ST.invoice_baskets, "baskets"), K.invoice_baskets(s))
    same(got(ST.mall_month_extended, "baskets"), K.mall_month_extended(s))
    same(got(ST.age_band_category, "bands"), K.age_band_category(s))
    same(got(ST.payment_behavior, "payments"), K.payment_behavior(s))
    same(got(ST.mall_revenue, "malls"), L.mall_revenue(s))


def test_a_broken_run_is_not_seen(spark):
    rows = odd_rows(spark)
    path = scratch_path(spark, "versions")
    jan, feb = rows.where("year_month = '2021-01'"), rows.where("year_month = '2021-02'")
    one = Versions(spark, path)
    one.add("malls", ST.MALLS, jan, ["2021-01"], "a")
    one.commit("a", 1)
    broken = Versions(spark, path)
    broken.add("malls", ST.MALLS, rows, ["2021-01", "2021-02", None], "b")  # and no commit
    same(Versions(spark, path).state("malls", ST.MALLS, rows), ST.MALLS.of(jan))
    again = Versions(spark, path)
    again.add("malls", ST.MALLS, feb, ["2021-02"], "b")
    again.commit("b", 2)
    last = Versions(spark, path)
    same(last.state("malls", ST.MALLS, rows), ST.MALLS.of(jan.unionAll(feb)))
    assert last.batches == {"a": 1, "b": 2}
    last.add("malls", ST.MALLS, jan, ["2021-01"], "c")
    last.commit("c", 1)
    last.vacuum()
    same(Versions(spark, path).state("malls", ST.MALLS, rows), ST.MALLS.of(jan.unionAll(jan).unionAll(feb)))
    left = {p.toString().rsplit(path, 1)[-1] for r in io.children(spark, f"{path}/malls") for p in io.children(spark, r.toString()) if "year_month" in p.getName()}
    assert left == {"/malls/run=b/year_month=2021-02", "/malls/run=c/year_month=2021-01"}


def build(spark, raw, out, *more):
    return B.run(spark, B.parse_args(["--input", raw, "--input-format", "parquet", "--out-base", out, "--year", "1996", *more]))


def read(spark, written, name, fmt):
    if name == "gold/category_top10":
        return spark.read.option("header", "true").csv(written[name])
    return io.read_table(spark, written[name], fmt) if fmt == "parquet" else spark.read.option("header", "true").option("sep", "\t").csv(written[name])


@pytest.fixture(scope="module")
def halves(spark, sf_dir):
    """Raw lines of two months, and without one, in two inputs that share
    months, customers and invoices."""
    raw = transactions_raw(spark, sf_dir).select(*RAW_COLUMNS)
    day = parse_invoice_date(F.trim("invoice_date"), DATE_FORMATS)
    raw = raw.where(F.coalesce(day.between("1996-01-15", "1996-02-20"), F.lit(True)))
    part = F.pmod(F.xxhash64("invoice_no", "category"), F.lit(3))
    paths = {n: scratch_path(spark, f"raw-{n}") for n in ("a", "b", "both")}
    raw.where(part == 0).write.parquet(paths["a"])
    raw.where(part != 0).write.parquet(paths["b"])
    spark.read.parquet(paths["a"], paths["b"]).write.parquet(paths["both"])
    return paths


@pytest.fixture
def without_raw_tables(monkeypatch):
    """Leaves out the tables over raw lines, which read all of them anyway."""
    monkeypatch.setattr(B, "over_raw_lines", lambda *a: None)


@pytest.mark.parametrize("fmt", ["parquet", "tsv"])
def test_append_equals_one_build(spark, halves, fmt, monkeypatch):
    if fmt == "tsv":
        monkeypatch.setattr(B, "over_raw_lines", lambda *a: None)
    base = scratch_path(spark, "append-job")
    build(spark, halves["a"], f"{base}/two", "--format", fmt, "--mode", "append", "--batch", "a")
    two = build(spark, halves["b"], f"{base}/two", "--format", fmt, "--mode", "append", "--batch", "b")
    one = build(spark, halves["both"], f"{base}/one", "--format", fmt)
    assert set(one) == set(two)
    for name in one:
        same(read(spark, two, name, fmt), read(spark, one, name, fmt))


def test_batches_are_applied_once(spark, halves, without_raw_tables, monkeypatch):
    base = scratch_path(spark, "append-again")
    build(spark, halves["a"], base, "--mode", "append", "--batch", "a")
    # the second batch breaks off after silver was appended and before the commit
    with monkeypatch.context() as m:
        m.setattr(Versions, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            build(spark, halves["b"], base, "--mode", "append", "--batch", "b")
    with pytest.raises(RuntimeError, match="broke off"):
        build(spark, halves["b"], base, "--mode", "append", "--batch", "other")
    # a run whose gold breaks off: the next one makes all of it
    with monkeypatch.context() as m:
        m.setattr(B, "gold", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            build(spark, halves["b"], base, "--mode", "append", "--batch", "b")
    written = build(spark, halves["b"], base, "--mode", "append", "--batch", "b")
    one = build(spark, halves["both"], scratch_path(spark, "append-one"))
    for name in ("silver/transactions_clean", "gold/customer_summary", "gold_b/invoice_baskets", "gold_b/join_regular", "gold_b/mall_counts"):
        same(io.read_table(spark, written[name]), io.read_table(spark, one[name]))


def test_an_append_writes_touched_months_alone(spark, halves, without_raw_tables):
    base = scratch_path(spark, "append-months")
    written = build(spark, halves["both"], base, "--mode", "append", "--batch", "all")
    files = lambda: set(io.read_table(spark, written["gold_b/invoice_baskets"]).inputFiles())
    before = files()
    some = scratch_path(spark, "raw-month")
    raw = spark.read.parquet(halves["a"])
    raw.where(parse_invoice_date(F.trim("invoice_date"), DATE_FORMATS).between("1996-02-01", "1996-02-28")).limit(5).write.parquet(some)
    build(spark, some, base, "--mode", "append", "--batch", "few")
    assert {f for f in before - files()} == {f for f in before if "year_month=1996-02" in f}
    states = Versions(spark, f"{base}/state")
    assert {(m, run) for (n, m), run in states.runs.items() if n == "baskets"} == {("1996-01", "all"), ("1996-02", "few"), (None, "all")}
    s = io.read_table(spark, written["silver/transactions_clean"], schema=SILVER_SCHEMA)
    plan = states.state("baskets", ST.BASKETS, s).where("year_month = '1996-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "run" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_dynamic_overwrite_recomputes_its_months(spark, halves, without_raw_tables):
    """Partitions in the input are replaced, the others stay, in silver and gold."""
    base = scratch_path(spark, "append-dynamic")
    build(spark, halves["both"], base)
    written = build(spark, halves["a"], base, "--overwrite", "dynamic")
    s = io.read_table(spark, written["silver/transactions_clean"], schema=SILVER_SCHEMA)
    same(io.read_table(spark, written["gold/customer_summary"]), K.customer_summary(s))
    same(io.read_table(spark, written["gold_b/mall_month_baseline"]), L.mall_month_revenue(s))


def test_silver_cannot_be_appended(capsys):
    with pytest.raises(SystemExit):
        B.parse_args(["--silver", "x", "--out-base", "y", "--mode", "append"])
    with pytest.raises(SystemExit):
        B.parse_args(["--input", "x", "--out-base", "y", "--mode", "append", "--batch", "a/b"])
