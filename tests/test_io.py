"""Write -> read round trips and overwrite modes."""

from pyspark.sql import functions as F

from souk.operators.clean import clean_fields, parsed, silver
from souk.operators.freq import text_profile
from souk.operators.layout import year_filter
from souk.schema import SILVER_COLUMNS, SILVER_SCHEMA
from souk.session import scratch_path
from souk.sources import io
from souk.sources.fixture import transactions_raw


def same(a, b):
    return a.count() == b.count() and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_csv_roundtrip_keeps_null_and_empty(spark):
    df = spark.createDataFrame([("a", None), ("", "x"), (" b ", '1,5"00')], "s string, t string")
    p = scratch_path(spark, "t-csv")
    io.write_table(df, p, fmt="csv")
    back = io.read_table(spark, p, "csv", schema=df.schema)
    assert same(df, back)


def test_tsv_and_parquet_roundtrip(spark, sf_dir):
    s = silver(transactions_raw(spark, sf_dir))
    for fmt in ("tsv", "csv", "parquet"):
        p = scratch_path(spark, f"t-{fmt}")
        io.write_table(s, p, fmt=fmt)
        assert same(s, io.read_table(spark, p, fmt, schema=SILVER_SCHEMA).select(*SILVER_COLUMNS)), fmt


def test_partitioned_silver_with_null_month(spark, sf_dir):
    s = silver(transactions_raw(spark, sf_dir)).filter(year_filter(1996) | F.col("year_month").isNull())
    p = scratch_path(spark, "t-silver")
    io.write_silver(s, p)
    back = io.read_table(spark, p, "parquet", schema=SILVER_SCHEMA).select(*SILVER_COLUMNS)
    assert same(s, back)
    assert back.filter(F.col("year_month").isNull()).count() == s.filter(F.col("year_month").isNull()).count() > 0


def test_static_vs_dynamic_overwrite(spark, sf_dir):
    s = silver(transactions_raw(spark, sf_dir)).filter(year_filter(1996))
    jan = s.filter(F.col("invoice_month") == 1)
    p = scratch_path(spark, "t-over")
    io.write_silver(s, p)
    io.write_silver(jan.limit(5), p, overwrite="dynamic")
    back = io.read_table(spark, p, "parquet", schema=SILVER_SCHEMA)
    # every non-January partition survives; January partitions of the new rows are replaced
    assert back.filter(F.col("invoice_month") != 1).count() == s.filter(F.col("invoice_month") != 1).count()
    io.write_silver(jan, p, overwrite="static")
    assert io.read_table(spark, p, "parquet", schema=SILVER_SCHEMA).count() == jan.count()


def test_append_mode(spark, sf_dir):
    s = silver(transactions_raw(spark, sf_dir)).filter(year_filter(1996))
    p = scratch_path(spark, "t-append")
    io.write_silver(s, p)
    io.write_silver(s, p, mode="append")
    assert io.read_table(spark, p, "parquet", schema=SILVER_SCHEMA).count() == 2 * s.count()


DIRTY = [
    ('"Gift ""A"", card"', "a,b", "\ttab\t", " 28"),
    ("line\nbreak", "cr\r\nlf", "back\\slash", "28.0"),
    ("\\n", "\\\\n\\", '"', ""),
    (None, "", " ", "\\"),
    ("\x00", "\\\x00", "\x00\\n\\0", "\\0\\\\\x00\n"),
]


def test_dirty_values_roundtrip(spark):
    df = spark.createDataFrame(DIRTY, "a string, b string, c string, d string")
    for fmt in ("csv", "tsv"):
        p = scratch_path(spark, f"t-dirty-{fmt}")
        io.write_table(df.coalesce(1), p, fmt=fmt)
        assert same(df, io.read_table(spark, p, fmt, schema=df.schema)), fmt
        assert spark.read.text(p).count() == len(DIRTY) + 1  # a row is a line


HEADER = "invoice_no,customer_id,gender,age,category,quantity,price,payment_method,invoice_date,shopping_mall"


def test_foreign_csv(spark, tmp_path):
    rows = ['I1,C1,Male, 28 ,"Gift ""A"", card",1,"1,500.25",Cash,1/2/2023,Mall', "I2,C2,Female,28.0,Shoes,2,3,Cash,2/2/2023,Mall"]
    (tmp_path / "raw.csv").write_text("\n".join([HEADER, *rows, "I3,short row", 'I4,C4,Male,x,"two\nlines",1,2,Cash,3/2/2023,Mall']) + "\n")
    got = {r.invoice_no: r for r in parsed(io.read_transactions(spark, str(tmp_path), multi_line=True)).collect()}
    assert got["I1"].category == 'Gift "A", card' and got["I1"].payment_method == "Cash" and got["I1"].price == 1500.25
    assert (got["I1"].age, got["I2"].age, got["I4"].age) == (28, 28, None)
    assert got["I2"].age_band == "20-29" and got["I4"].category == "two\nlines"
    assert io.malformed_rows(spark, str(tmp_path), multi_line=True) == 1
    assert io.malformed_rows(spark, str(tmp_path)) > 1


def test_missing_age_is_marked(spark):
    raw = spark.createDataFrame([("I1", None), ("I2", " 28 "), ("I3", "")], "invoice_no string, age string")
    assert [r.age for r in clean_fields(raw).orderBy("invoice_no").collect()] == ["NA", "28", "NA"]


def test_small_csv(spark, sf_dir):
    s = silver(transactions_raw(spark, sf_dir))
    p = scratch_path(spark, "t-small")
    io.write_small_csv(s.select("invoice_no", "category"), p, n=10, order=["invoice_no", "category"])
    assert spark.read.text(p).count() == 11 and len(spark.read.text(p).inputFiles()) == 1


def test_text_profile_does_not_depend_on_files(spark):
    df = spark.createDataFrame([("a b", "x"), ("\tc", None), ("", "")], "s string, t string")
    want = (3, 2 + 1 + 1, len("a b,x") + len("\tc,") + len(",") + 3, "s,t")
    for n in (1, 3):
        assert tuple(text_profile(df.repartition(n)).first()) == want


def test_escapes_of_foreign_lines_are_read_as_before(spark):
    values = ["\\", "a\\q", "\\\\n", "\\\\\\n", "\\n\\r\\0", "\\\\b\\0z", "\x00b\\n", "\x00z\\\\", "plain", "", None, "\\\\\\\\", "b\\0b\\\\z"]
    df = spark.createDataFrame([(v,) for v in values], "v string")

    def plain(v):
        parts = v.split("\\\\")
        return "\\".join(p.replace("\\n", "\n").replace("\\r", "\r").replace("\\0", "\x00") for p in parts)

    read = df.select("v", io._many_lines(F.col("v")).alias("r")).collect()
    assert [r.r for r in read] == [v if v is None or "\\" not in v else plain(v) for v in values]
    # only a value that holds a NUL is split
    plan = df.select(io._many_lines(F.col("v")))._jdf.queryExecution().analyzed().toString()
    assert plan.index("WHEN Contains(v") < plan.index("split(v") < plan.index("ELSE replace(")
