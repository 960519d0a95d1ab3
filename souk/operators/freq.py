"""Frequency tables, counts per key, first value per key, data-quality
profiles and the SQL-text bucket count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.predicates import customer_present, non_empty
from .topn import top_n


def frequency(df: DataFrame, col: str, skip_empty: bool = True) -> DataFrame:
    """``(col, count)``, most frequent first, ties by value. Whole column
    values are the key (multi-word values stay one group)."""
    src = df.filter(non_empty(col, df.schema[col].dataType)) if skip_empty else df
    return (
        src.groupBy(col)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.col(col).asc_nulls_first())
    )


def top_values(df: DataFrame, col: str, n: int = 5) -> DataFrame:
    """The ``n`` most frequent values of ``col`` (ties by value)."""
    return top_n(frequency(df, col), [F.desc("count"), F.col(col).asc_nulls_first()], n)


def mall_counts(tx: DataFrame) -> DataFrame:
    """Rows per mall, largest first: the skew check."""
    return frequency(tx, "shopping_mall", skip_empty=False)


def customer_counts(df: DataFrame) -> DataFrame:
    """Rows per customer id, by id; missing ids skipped."""
    return (
        df.filter(customer_present())
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("customer_id")
    )


def first_per_key(df: DataFrame, key: str, value: str, order: Sequence[str]) -> DataFrame:
    """One ``value`` per ``key``: the one of the smallest ``order`` (then the
    smallest value). ``min_by`` is mergeable, so a hot key is combined map-side."""
    ordering = F.struct(*[F.col(c) for c in order], F.col(value))
    return df.groupBy(key).agg(F.min_by(F.col(value), ordering).alias(value))


def top_customers_with_gender(df: DataFrame, n: int = 10, order: Sequence[str] = ("invoice_no",)) -> DataFrame:
    """Customers with the most rows, each with its first gender; count
    descending, id ascending.

    The reference joins a per-customer count table to a per-customer first
    gender table. Both are keyed on the customer, so one aggregate yields
    the same rows in a single pass over the input (one shuffle, both
    aggregates combined map-side)."""
    ordering = F.struct(*[F.col(c) for c in order], F.col("gender"))
    per = (
        df.filter(customer_present())
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("count"), F.min_by(F.col("gender"), ordering).alias("gender"))
    )
    return top_n(per, [F.desc("count"), F.asc("customer_id")], n)


def mod_bucket_counts(rows: DataFrame, key: str, buckets: int = 10) -> DataFrame:
    """Rows per ``key % buckets`` through SQL text over a temporary view, in
    bucket order."""
    return rows.sparkSession.sql(
        "SELECT CAST({key} % {b} AS BIGINT) AS bucket, COUNT(*) AS c FROM {rows} GROUP BY 1 ORDER BY 1",
        rows=rows,
        key=F.col(key),
        b=int(buckets),
    )


def missing_fields(df: DataFrame, markers: Sequence[str] = ("",)) -> DataFrame:
    """Per column: rows, and fields that are null or (text) one of ``markers``.
    One global aggregate, then one row per column."""
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for f in df.schema.fields:
        c = F.col(f.name)
        miss: Column = c.isNull()
        if isinstance(f.dataType, T.StringType):
            for m in markers:
                miss = miss | (c == m)
        aggs.append(F.sum(F.when(miss, 1).otherwise(0)).cast("bigint").alias(f.name))
    wide = df.agg(*aggs)
    rows = [
        F.struct(F.lit(f.name).alias("field"), F.col("__rows").alias("rows"), F.col(f.name).alias("missing"))
        for f in df.schema.fields
    ]
    return wide.select(F.inline(F.array(*rows)))


def text_profile(rows: DataFrame, sep: str = ",") -> DataFrame:
    """Lines, words and bytes of a table as separated text (``wc``), with the
    header line: one line per row whatever files hold them, a line end counted
    as one byte. Blanks and tabs separate words; a null is empty."""
    line = F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rows.columns])
    trimmed = F.regexp_replace(line, r"^\s+|\s+$", "")
    words = F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, r"\s+")))
    return rows.agg(
        F.count(F.lit(1)).alias("lines"),
        F.coalesce(F.sum(words), F.lit(0)).cast("bigint").alias("words"),
        F.coalesce(F.sum(F.octet_length(line) + 1), F.lit(0)).cast("bigint").alias("bytes"),
    ).withColumn("header", F.lit(sep.join(rows.columns)))


def duplicate_keys(df: DataFrame, key: str = "invoice_no") -> DataFrame:
    """Keys present on more than one row (missing keys skipped)."""
    return (
        df.filter(non_empty(key))
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("count"))
        .filter(F.col("count") > 1)
    )
