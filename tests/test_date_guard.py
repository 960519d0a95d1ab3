"""The shape guard in front of each date format is a necessary condition:
wherever the unguarded format parses a text, the guard matches it, so the
guarded chain returns exactly what the plain try_to_date chain returns."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from souk.functions import parse_invoice_date
from souk.functions.cleaning import format_shape
from souk.schema import DATE_FORMATS

EDGE_CASES = [
    "5/8/2022", "05/08/2022", "5/13/2022", "31/02/2022", "2022-1-3", "2022-01-03", "2022/01/04",
    "2022/1/4", "+2022-1-3", "02022-1-3", "1/1/02022", "12/12/12345", "0/0/2022", "2022-13-01",
    "1/1/22", "", " ", "bad", "NA", "2022-1-3 ", "2022/01/04/", "1//2022", "١/٢/٢٠٢٢",
]

parts = st.one_of(st.integers(0, 40).map(str), st.integers(0, 40).map(lambda i: f"{i:02d}"), st.integers(0, 99999).map(str))
texts = st.builds(lambda a, s1, b, s2, c: f"{a}{s1}{b}{s2}{c}", parts, st.sampled_from("/-."), parts, st.sampled_from("/-."), parts)


def check(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "d string")
    plain = F.coalesce(*[F.try_to_date("d", f) for f in DATE_FORMATS])
    cols = [plain.alias("plain"), parse_invoice_date("d").alias("guarded")]
    for i, f in enumerate(DATE_FORMATS):
        cols += [F.try_to_date("d", f).alias(f"p{i}"), F.col("d").rlike(format_shape(f)).alias(f"g{i}")]
    for r in df.select("d", *cols).collect():
        assert r.plain == r.guarded, r.d
        for i in range(len(DATE_FORMATS)):
            assert r[f"p{i}"] is None or r[f"g{i}"], (r.d, DATE_FORMATS[i])


def test_edge_cases(spark):
    check(spark, EDGE_CASES)


@settings(max_examples=5, deadline=None)
@given(st.lists(texts, min_size=50, max_size=200))
def test_random_texts(spark, values):
    check(spark, values)
