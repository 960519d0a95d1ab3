"""Hand-made rows for every cleaning rule and bucket edge (FIXTURES.md §4)."""

import datetime as dt

from pyspark.sql import functions as F

from souk.functions import age_band, parse_invoice_date, price_bucket, strip_thousands, to_number, year_month_from_text
from souk.operators.clean import clean_fields, parsed, silver
from souk.schema import RAW_SCHEMA


def raw_rows(spark, rows):
    base = dict(
        invoice_no="I1",
        customer_id="C1",
        gender="Female",
        age=30,
        category="Books",
        quantity="2",
        price="10.5",
        payment_method="Cash",
        invoice_date="5/8/2022",
        shopping_mall="Kanyon",
    )
    full = [{**base, **r} for r in rows]
    return spark.createDataFrame([tuple(r[c] for c in RAW_SCHEMA.names) for r in full], RAW_SCHEMA)


def test_date_formats(spark):
    df = spark.createDataFrame(
        [("5/8/2022",), ("5/13/2022",), ("2022-1-3",), ("2022/01/04",), ("31/02/2022",), ("bad",), ("NA",), (None,)],
        "d string",
    )
    got = [r[0] for r in df.select(parse_invoice_date("d")).collect()]
    assert got == [
        dt.date(2022, 8, 5),
        dt.date(2022, 5, 13),
        dt.date(2022, 1, 3),
        dt.date(2022, 1, 4),
        None,
        None,
        None,
        None,
    ]


def test_bad_date_row_is_kept(spark):
    df = silver(raw_rows(spark, [{"invoice_date": "31/02/2022"}, {"invoice_date": "bad"}, {"invoice_date": None}]))
    rows = df.select("invoice_dt", "year_month").collect()
    assert len(rows) == 3 and all(r.invoice_dt is None and r.year_month is None for r in rows)


def test_thousands_separator_inside_value(spark):
    df = silver(raw_rows(spark, [{"price": "1,500.25"}, {"quantity": "5", "price": "1500.4"}]))
    got = sorted((r.quantity, r.price, r.shopping_mall) for r in df.collect())
    assert got == [(2.0, 1500.25, "Kanyon"), (5.0, 1500.4, "Kanyon")]
    one = spark.createDataFrame([("1,234,567.5",), ("12,5",)], "p string").select(strip_thousands("p")).collect()
    assert [r[0] for r in one] == ["1234567.5", "12,5"]


def test_numeric_coercion_never_raises(spark):
    df = spark.createDataFrame([("12",), ("x",), ("",), (None,), (" 3.5 ",)], "v string")
    assert [r[0] for r in df.select(to_number("v")).collect()] == [12.0, None, None, None, 3.5]


def test_empty_run_is_filled_field_by_field(spark):
    df = clean_fields(raw_rows(spark, [{"gender": "", "category": "", "quantity": ""}]))
    r = df.first()
    assert (r.customer_id, r.gender, r.category, r.quantity, r.price) == ("C1", "NA", "NA", "NA", "10.5")


def test_quotes_and_blanks_stripped(spark):
    r = clean_fields(raw_rows(spark, [{"invoice_no": '  "I7" ', "price": '"1,500.25"'}])).first()
    assert (r.invoice_no, r.price) == ("I7", "1500.25")


def test_test_invoices_dropped(spark):
    df = silver(raw_rows(spark, [{"invoice_no": "I9TEST"}, {"invoice_no": "i9test"}, {"invoice_no": "I101123"}]))
    assert [r.invoice_no for r in df.collect()] == ["I101123"]


def test_ids_required(spark):
    rows = [{"customer_id": None}, {"customer_id": ""}, {"customer_id": "NA"}, {"invoice_no": ""}, {"invoice_no": None}]
    assert silver(raw_rows(spark, rows + [{"invoice_no": "I2"}])).count() == 1


def test_bounds(spark):
    rows = [{"quantity": q} for q in ("0", "1", "1000", "1001")] + [{"price": p} for p in ("0", "100000", "100000.01")]
    kept = silver(raw_rows(spark, rows)).select("quantity", "price").collect()
    assert sorted((r.quantity, r.price) for r in kept) == [(1.0, 10.5), (2.0, 100000.0), (1000.0, 10.5)]


def test_dummy_and_null_category_dropped(spark):
    rows = [{"category": "Dummy item"}, {"category": "TEST cat"}, {"category": None}, {"category": "Food & Beverage"}]
    assert [r.category for r in silver(raw_rows(spark, rows)).collect()] == ["Food & Beverage"]


def test_bucket_edges(spark):
    df = spark.createDataFrame([(9.99, 1.0), (10.0, 1.0), (100.0, 1.0), (100.01, 1.0), (0.0, 0.0)], "a double, i double")
    assert [r[0] for r in df.select(price_bucket("a", "i")).collect()] == ["LO", "MID", "MID", "HI", "ZERO"]


def test_age_edges(spark):
    df = spark.createDataFrame([(19,), (20,), (59,), (60,), (None,)], "age int")
    assert [r[0] for r in df.select(age_band("age")).collect()] == ["0-19", "20-29", "50-59", "60+", "unknown"]


def test_year_month_from_text(spark):
    df = spark.createDataFrame([("5/8/2022",), ("15/11/2021",)], "d string")
    assert [r[0] for r in df.select(year_month_from_text("d")).collect()] == ["2022-08", "2021-11"]


def test_parsed_keeps_every_row(spark):
    rows = [{"quantity": "x"}, {"customer_id": None}, {"invoice_date": "bad"}]
    df = parsed(raw_rows(spark, rows))
    assert df.count() == 3
    assert df.filter(F.col("quantity").isNull()).count() == 1
