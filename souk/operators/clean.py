"""Cleaning operators: raw text -> clean text fields, and raw -> silver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cleaning import (
    fill_missing,
    parse_invoice_date,
    strip_quotes,
    strip_thousands,
    to_number,
)
from ..functions.derive import age_band, spend
from ..functions.predicates import DEFAULT_RULES, quality_predicate
from ..schema import DATE_FORMATS, MISSING_MARKER, RAW_COLUMNS, SILVER_COLUMNS

NUMERIC_TEXT_COLUMNS = ("age", "quantity", "price")


def clean_fields(
    raw: DataFrame, numeric_cols: Sequence[str] = NUMERIC_TEXT_COLUMNS, marker: str = MISSING_MARKER
) -> DataFrame:
    """Text-level cleaning of every field: trim, strip surrounding quotes,
    drop thousands separators inside numeric fields, and mark a missing
    field (null or empty) with ``marker``, field by field. Non-text
    columns pass unchanged."""
    out = []
    for f in raw.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            c = F.trim(strip_quotes(F.trim(c)))
            if f.name in numeric_cols:
                c = strip_thousands(c)
            c = fill_missing(c, marker)
        out.append(c.alias(f.name))
    return raw.select(*out)


def parsed(raw: DataFrame, date_formats: Sequence[str] = DATE_FORMATS, keep: Sequence[str] = ()) -> DataFrame:
    """Trimmed, typed and enriched rows *without* the quality filter: numbers
    coerced (bad text -> null), date parsed over several formats (a bad date
    is null and the row is kept), calendar fields, lower-case category,
    spend and age band, and the columns ``keep`` as they are. One projection."""
    types = {f.name: f.dataType for f in raw.schema.fields}

    def text(c: str):
        col = F.col(c)
        return F.trim(col) if isinstance(types[c], T.StringType) else col

    quantity = to_number(text("quantity"), types["quantity"])
    price = to_number(text("price"), types["price"])
    invoice_dt = parse_invoice_date(text("invoice_date"), date_formats)
    category = text("category")
    age = to_number(text("age"), types["age"]).try_cast("int")
    cols = {
        "invoice_no": text("invoice_no"),
        "customer_id": text("customer_id"),
        "gender": text("gender"),
        "age": age,
        "category": category,
        "quantity": quantity,
        "price": price,
        "payment_method": text("payment_method"),
        "invoice_date": text("invoice_date"),
        "shopping_mall": text("shopping_mall"),
        "invoice_dt": invoice_dt,
        "invoice_year": F.year(invoice_dt),
        "invoice_month": F.month(invoice_dt),
        "year_month": F.date_format(invoice_dt, "yyyy-MM"),
        "category_lower": F.lower(category),
        "spend": spend(quantity, price),
        "age_band": age_band(age),
    }
    return raw.select(*[cols[c].alias(c) for c in SILVER_COLUMNS], *keep)


#: Column of a raw line that hasn't the fields of the schema, as it stood in
#: its file; and the flag by which a staged table keeps such lines apart.
MALFORMED, IS_MALFORMED = "malformed_line", "is_malformed"

#: What :func:`staged` adds: the texts that numbers came from, and the verdict.
STAGED_EXTRA = ("age_text", "quantity_text", "price_text", "passes", MALFORMED, IS_MALFORMED)


def staged(raw: DataFrame, rules=DEFAULT_RULES, date_formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Every row parsed once, with the trimmed texts of its numbers and
    ``passes``, whether the quality rules keep it. Written out, all later
    tables read it instead of the raw input: silver is a filter of it. Written
    by ``is_malformed``, lines without the fields of the schema lie in a folder
    of their own (:func:`malformed_lines`), after the same one pass."""
    texts = {f"{c}_text": F.trim(F.col(c).cast("string")) for c in ("age", "quantity", "price")}
    line = F.col(MALFORMED) if MALFORMED in raw.columns else F.lit(None).cast("string")
    kept = raw.select("*", *[e.alias(n) for n, e in texts.items()])
    both = parsed(kept.withColumn(MALFORMED, line), date_formats, keep=(*texts, MALFORMED))
    return both.withColumns({"passes": F.coalesce(quality_predicate(rules), F.lit(False)), IS_MALFORMED: F.col(MALFORMED).isNotNull()})


def malformed_lines(stage: DataFrame) -> DataFrame:
    """The lines set aside, as they stood in their files, and whether the
    rules keep what could be read of them. Prunes to their folder."""
    # a folder's name is read as text
    return stage.where(F.col(IS_MALFORMED).cast("boolean")).select(MALFORMED, "passes")


def observed_rejects(rows: DataFrame, rules=DEFAULT_RULES) -> tuple[DataFrame, Observation]:
    """``rows`` that count, while some action runs over them, the rows that
    fail each rule: no scan of their own."""
    counts = [F.count(F.when(F.coalesce(rule(), F.lit(False)), None).otherwise(1)).alias(rule.__name__) for rule in rules]
    every = F.coalesce(quality_predicate(rules), F.lit(False))
    observation = Observation()
    return rows.observe(observation, *counts, F.count(F.when(~every, 1)).alias("any"), F.count(F.lit(1)).alias("rows")), observation


def reject_table(spark: SparkSession, observation: Observation, rules=DEFAULT_RULES) -> DataFrame:
    """``(rule, rejected, rows)``, one row per rule and one for all of them,
    once an action over the observed rows is done."""
    found = observation.get
    named = [*[rule.__name__ for rule in rules], "any"]
    return spark.createDataFrame([(n, found[n], found["rows"]) for n in named], "rule string, rejected long, rows long")


def all_rejects(tables: DataFrame) -> DataFrame:
    """One reject table of those of several inputs."""
    return tables.groupBy("rule").agg(F.sum("rejected").alias("rejected"), F.sum("rows").alias("rows"))


def silver_of(stage: DataFrame) -> DataFrame:
    return stage.where("passes").select(*SILVER_COLUMNS)


def texts_of(stage: DataFrame) -> DataFrame:
    """The raw columns of a staged table as trimmed text."""
    numbers = {"age", "quantity", "price"}
    return stage.select(*[F.col(f"{c}_text").alias(c) if c in numbers else F.col(c) for c in RAW_COLUMNS])


def silver(raw: DataFrame, rules=DEFAULT_RULES, date_formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Clean, filtered transactions (the silver table).

    The rules look at the parsed columns. Pushed below them, they would hold
    each column's whole expression as often as they name it, down to the texts
    it is made from, and the generated method grows past what the JVM compiles.
    The number of the partition, which no filter is moved below, keeps them
    where the columns are made."""
    rows = parsed(raw, date_formats).withColumn("__part", F.spark_partition_id())
    return rows.filter(quality_predicate(rules) & (F.col("__part") >= 0)).drop("__part")


def skinny_transactions(df: DataFrame) -> DataFrame:
    """Five-column view: invoice, customer, category, quantity, price."""
    return df.select("invoice_no", "customer_id", "category", "quantity", "price")


def customer_demographics(df: DataFrame) -> DataFrame:
    """Distinct (customer_id, gender, age)."""
    return df.select("customer_id", "gender", "age").distinct()


def preview(df: DataFrame, n: int = 10, order: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows in a total order (all columns after the given ones),
    planned as a top-k, not a full sort."""
    keys = list(order or [])
    keys += [c for c in df.columns if c not in keys]
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in keys]).limit(n)
