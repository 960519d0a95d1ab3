"""Schemas, column lists and the fixed thresholds of the transaction model.

The thresholds, formats and band edges below are fixed values: results
must equal the reference's, so they are stated plainly here and every
operator takes them as defaults that a caller may override.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- raw invoice lines -----------------------------------------------------
# age, quantity and price stay text on read so that blanks, thousands
# separators and junk can be handled by the cleaning step instead of turning
# the field into a null inside the CSV parser.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("invoice_no", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("age", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("quantity", T.StringType()),
        T.StructField("price", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("invoice_date", T.StringType()),
        T.StructField("shopping_mall", T.StringType()),
    ]
)
RAW_COLUMNS = [f.name for f in RAW_SCHEMA.fields]

# --- cleaned ("silver") transactions ----------------------------------------
SILVER_SCHEMA = T.StructType(
    [
        T.StructField("invoice_no", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("category", T.StringType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("invoice_date", T.StringType()),
        T.StructField("shopping_mall", T.StringType()),
        T.StructField("invoice_dt", T.DateType()),
        T.StructField("invoice_year", T.IntegerType()),
        T.StructField("invoice_month", T.IntegerType()),
        T.StructField("year_month", T.StringType()),
        T.StructField("category_lower", T.StringType()),
        T.StructField("spend", T.DoubleType()),
        T.StructField("age_band", T.StringType()),
    ]
)
SILVER_COLUMNS = [f.name for f in SILVER_SCHEMA.fields]
SILVER_PARTITION_COLUMNS = ["year_month", "shopping_mall"]
#: What single lines are looked up by.
SILVER_LOOKUP_COLUMNS = ["customer_id", "invoice_no"]

# Fixed values (must equal the reference's) --------------------------------
# invoice date formats, tried in this order, first success wins (day first)
DATE_FORMATS = ["d/M/yyyy", "M/d/yyyy", "yyyy-M-d", "yyyy/MM/dd"]
# quality bounds: 0 < quantity <= 1000, 0 < price <= 100000
MAX_QUANTITY = 1000
MAX_PRICE = 100000
# invoice numbers containing this (any case) are test rows
TEST_INVOICE_PATTERN = "(?i)test"
# categories containing these (any case) are test or dummy rows
DUMMY_CATEGORY_PATTERN = "(?i)test|dummy"
# missing-field marker of the text cleaning step
MISSING_MARKER = "NA"
# a transaction is "high price" above this unit price
HIGH_PRICE = 100
# price buckets on the average price per item: LO < 10 <= MID <= 100 < HI
BUCKET_LO = 10
BUCKET_HI = 100
# age bands: upper bounds (exclusive) and labels; null age is "unknown"
AGE_BAND_EDGES = [(20, "0-19"), (30, "20-29"), (40, "30-39"), (50, "40-49"), (60, "50-59")]
AGE_BAND_TOP = "60+"
AGE_BAND_UNKNOWN = "unknown"
# a basket is high-spend above this spend
HIGH_SPEND = 500
# constant segment of the generated mall dimension
MALL_SEGMENT = "General"
# plain unsigned decimal, as text
NUMERIC_TEXT_PATTERN = r"^[0-9]+(\.[0-9]+)?$"

# Numbers that are such a DECIMAL are summed as one, so that totals do not
# depend on the order in which partial sums meet; others are summed as doubles.
QTY_DECIMAL = T.DecimalType(18, 4)
PRICE_DECIMAL = T.DecimalType(18, 6)
