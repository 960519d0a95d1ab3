"""Named queries over the test tables, each paired with its DuckDB oracle.

A query is ``fn(spark, sf_dir) -> DataFrame`` and reads the star-schema
tables at ``sf_dir`` through the ``transactions_raw`` view, so its work grows
with the tables. ``ORACLE[name]`` is the independent SQL for the same
result; queries without one get a rows-only check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from . import oracle as O
from ..functions.cleaning import to_number, trim_strings, year_month_from_text
from ..functions.predicates import customer_present
from ..operators import clean as C
from ..operators import clusters as CL
from ..operators import freq as F_
from ..operators import joins as J
from ..operators import kpis as K
from ..operators import layout as L
from ..operators import model as M
from ..operators import sampling as S
from ..operators import state as ST
from ..schema import RAW_COLUMNS, SILVER_COLUMNS, SILVER_SCHEMA
from ..session import scratch_path, staging_session
from ..sources import io
from ..sources.fixture import malls, read_table, transactions_raw
from ..sources.versions import Versions

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_raw(spark, sf_dir)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.silver(raw(spark, sf_dir))


def stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver as files, for queries that read it more than once."""
    return io.stored(silver(spark, sf_dir), scratch_path(spark, "stored-silver"))


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.parsed(raw(spark, sf_dir))


# --------------------------------------------------------------------------
# cleaning
# --------------------------------------------------------------------------


@register("transactions_clean", O.W_CLEAN + "SELECT * FROM clean")
def q_transactions_clean(spark, sf_dir):
    return silver(spark, sf_dir)


# --------------------------------------------------------------------------
# customer KPIs
# --------------------------------------------------------------------------

_CUSTOMER_SQL = f"""
cust AS (
SELECT customer_id,
       COUNT(*) AS transactions,
       {O.QTY_SUM} AS total_items,
       {O.SPEND_SUM} AS total_spend,
       {O.PRICE_MEAN} AS price_mean,
       quantile_disc(price, 0.5) AS price_median,
       CAST(SUM(CASE WHEN price > 100 THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS high_price_tx_ratio
FROM clean GROUP BY customer_id),
summary AS (
SELECT *, CASE WHEN total_items > 0 THEN total_spend / total_items ELSE 0.0 END AS avg_price_per_item
FROM cust),
bucketed AS (
SELECT *, CASE WHEN total_items = 0 THEN 'ZERO' WHEN avg_price_per_item < 10 THEN 'LO'
               WHEN avg_price_per_item <= 100 THEN 'MID' ELSE 'HI' END AS bucket
FROM summary)"""


@register("customer_summary", O.W_CLEAN.rstrip() + "," + _CUSTOMER_SQL + "\nSELECT * FROM bucketed")
def q_customer_summary(spark, sf_dir):
    return K.customer_summary(silver(spark, sf_dir))


# whole numbers of the sums' last decimals: 14 of spend, 5 of items
_S = f"CAST(replace(CAST(SUM(CAST(quantity AS {O.QD}) * CAST(price AS {O.PD})) AS VARCHAR), '.', '') AS HUGEINT)"
_I = f"CAST(replace(CAST(SUM(CAST(quantity AS {O.QD})) AS VARCHAR), '.', '') AS HUGEINT)"


@register(
    "customer_summary_money",
    O.W_CLEAN.rstrip()
    + f""",{_CUSTOMER_SQL},
sums AS (
SELECT customer_id, {_S} AS s, {_I} AS i, COUNT(*) AS n, COUNT(*) FILTER (WHERE price > 100) AS h FROM clean GROUP BY customer_id)
SELECT customer_id, transactions, total_items,
       CAST((s + 500000000000) // 1000000000000 AS DOUBLE) / 100 AS total_spend,
       CASE WHEN i > 0 THEN CAST((2 * s + i * 10000000) // (2 * i * 10000000) AS DOUBLE) / 100 ELSE 0.0 END AS avg_price_per_item,
       CAST((200 * h + n) // (2 * n) AS DOUBLE) / 100 AS high_price_tx_ratio, bucket
FROM bucketed JOIN sums USING (customer_id)""",
)
def q_customer_summary_money(spark, sf_dir):
    return K.customer_summary_money(silver(spark, sf_dir))


@register(
    "bucket_counts",
    O.W_CLEAN.rstrip() + "," + _CUSTOMER_SQL + "\nSELECT bucket, COUNT(*) AS count FROM bucketed GROUP BY bucket",
)
def q_bucket_counts(spark, sf_dir):
    return K.bucket_counts(K.customer_summary(silver(spark, sf_dir)))


def trimmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trim_strings(raw(spark, sf_dir))


def _sql(ctes: str, *extra: str, body: str) -> str:
    """``ctes`` is one of the ``W_*`` prefixes; ``extra`` adds CTEs."""
    head = ctes.rstrip()
    for e in extra:
        head += "," + e
    return head + "\n" + body


@register("cleaned_fields", O.W_FIELDS + "SELECT * FROM fields")
def q_cleaned_fields(spark, sf_dir):
    return C.clean_fields(raw(spark, sf_dir))


@register(
    "cleaning_preview",
    O.W_FIELDS
    + "SELECT * FROM fields ORDER BY "
    + ", ".join(f"{c} NULLS FIRST" for c in RAW_COLUMNS)
    + " LIMIT 10",
)
def q_cleaning_preview(spark, sf_dir):
    return C.preview(C.clean_fields(raw(spark, sf_dir)), 10, ["invoice_no"])


@register("transactions_skinny", O.W_FIELDS + "SELECT invoice_no, customer_id, category, quantity, price FROM fields")
def q_transactions_skinny(spark, sf_dir):
    return C.skinny_transactions(C.clean_fields(raw(spark, sf_dir)))


@register("customer_demographics", O.W_TRIMMED + "SELECT DISTINCT customer_id, gender, age FROM trimmed")
def q_customer_demographics(spark, sf_dir):
    return C.customer_demographics(trimmed(spark, sf_dir))


# --------------------------------------------------------------------------
# sources and sinks (write to a fresh folder under the checkpoint dir, read back)
# --------------------------------------------------------------------------


@register("csv_scan", O.W_RAW + "SELECT * FROM raw")
def q_csv_scan(spark, sf_dir):
    path = scratch_path(spark, "csv_scan")
    io.write_table(raw(spark, sf_dir), path, fmt="csv")
    return io.read_transactions(spark, path)


@register("tsv_roundtrip", O.W_CLEAN + "SELECT * FROM clean")
def q_tsv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "tsv")
    io.write_table(silver(spark, sf_dir), path, fmt="tsv")
    return io.read_table(spark, path, fmt="tsv", schema=SILVER_SCHEMA)


ROUNDTRIP_YEAR = 1996
_YEAR_SQL = f"year_month >= '{ROUNDTRIP_YEAR}-01' AND year_month < '{ROUNDTRIP_YEAR + 1}-01'"


def _read_silver(spark, path):
    return io.read_table(spark, path, "parquet", schema=SILVER_SCHEMA).select(*SILVER_COLUMNS)


@register("silver_roundtrip", O.W_CLEAN + "SELECT * FROM clean")
def q_silver_roundtrip(spark, sf_dir):
    """The whole silver table through the partitioned parquet sink and back."""
    path = scratch_path(spark, "silver")
    io.write_silver(silver(spark, sf_dir), path)
    return _read_silver(spark, path)


# the new batch of the dynamic overwrite: a subset of the first half of one year
_DYN_NEW = f"{_YEAR_SQL} AND invoice_month <= 6 AND quantity <= 25"


@register(
    "dynamic_overwrite",
    _sql(
        O.W_CLEAN,
        f"\nnew_rows AS (SELECT * FROM clean WHERE {_DYN_NEW})",
        body="""SELECT * FROM new_rows UNION ALL
SELECT * FROM clean c WHERE NOT EXISTS (
  SELECT 1 FROM new_rows n WHERE n.year_month = c.year_month AND n.shopping_mall = c.shopping_mall)""",
    ),
)
def q_dynamic_overwrite(spark, sf_dir):
    """Write the whole silver table, then overwrite dynamically with a new
    batch: partitions present in the batch are replaced, all others stay."""
    path = scratch_path(spark, "dynamic")
    io.write_silver(silver(spark, sf_dir), path)
    # a dynamic overwrite puts its partitions in place once all rows are read
    batch = _read_silver(spark, path).filter(L.year_filter(ROUNDTRIP_YEAR) & (F.col("invoice_month") <= 6) & (F.col("quantity") <= 25))
    io.write_silver(batch, path, mode="overwrite", overwrite="dynamic")
    return _read_silver(spark, path)


@register(
    "mod_bucket_counts",
    "SELECT CAST(l_orderkey % 10 AS BIGINT) AS bucket, COUNT(*) AS c FROM lineitem GROUP BY 1",
)
def q_mod_bucket_counts(spark, sf_dir):
    """Invoice lines by the last digit of their order, through SQL text."""
    return F_.mod_bucket_counts(read_table(spark, sf_dir, "lineitem"), "l_orderkey", 10)


_LINE = "concat_ws(',', " + ", ".join(f"coalesce({c}, '')" for c in RAW_COLUMNS) + ")"


@register(
    "file_profile",
    _sql(
        O.W_RAW,
        f"\nlines AS (SELECT {_LINE} AS line FROM raw)",
        body=f"""SELECT COUNT(*) AS lines,
       CAST(SUM(len(list_filter(regexp_split_to_array(line, '\\s+'), lambda w: w <> ''))) AS BIGINT) AS words,
       CAST(SUM(strlen(line) + 1) AS BIGINT) AS bytes, '{",".join(RAW_COLUMNS)}' AS header
FROM lines""",
    ),
)
def q_file_profile(spark, sf_dir):
    return F_.text_profile(raw(spark, sf_dir))


# values that break careless text formats, planted in every row
_DIRTY = {
    "invoice_no": ("concat('\"', {c}, '\"\"')", lambda c: F.concat(F.lit('"'), c, F.lit('""'))),
    "customer_id": ("concat({c}, ',x')", lambda c: F.concat(c, F.lit(",x"))),
    "gender": ("concat({c}, chr(10), 'n')", lambda c: F.concat(c, F.lit("\nn"))),
    "age": ("concat(' ', {c}, '.0 ')", lambda c: F.concat(F.lit(" "), c, F.lit(".0 "))),
    "category": ("concat({c}, chr(9), 't')", lambda c: F.concat(c, F.lit("\tt"))),
    "payment_method": ("concat(chr(92), 'n', {c}, chr(92))", lambda c: F.concat(F.lit("\\n"), c, F.lit("\\"))),
    "shopping_mall": ("concat({c}, chr(13), chr(10))", lambda c: F.concat(c, F.lit("\r\n"))),
}


@register(
    "csv_dirty_roundtrip",
    _sql(
        O.W_RAW,
        "\ndirty AS (SELECT " + ", ".join(f"{_DIRTY[c][0].format(c=c)} AS {c}" if c in _DIRTY else c for c in RAW_COLUMNS) + " FROM raw)",
        body="SELECT *, CAST(TRY_CAST(trim(age) AS DOUBLE) AS INT) AS age_years FROM dirty",
    ),
)
def q_csv_dirty_roundtrip(spark, sf_dir):
    """Doubled quotes, separators, line breaks, tabs, backslashes and blanks in
    every row, through CSV, then TSV, and back."""
    dirty = raw(spark, sf_dir)
    # DuckDB's concat skips nulls, and so does this
    planted = {c: make(F.coalesce(F.col(c), F.lit(""))) for c, (_, make) in _DIRTY.items()}
    rows = dirty.withColumns(planted)
    for fmt in ("csv", "tsv"):
        path = scratch_path(spark, f"dirty-{fmt}")
        io.write_table(rows, path, fmt=fmt)
        rows = io.read_table(spark, path, fmt, schema=rows.schema)
    return rows.withColumn("age_years", to_number(F.trim("age")).try_cast("int"))


@register("silver_csv_roundtrip", O.W_CLEAN + "SELECT * FROM clean")
def q_silver_csv_roundtrip(spark, sf_dir):
    """Silver as CSV and back."""
    path = scratch_path(spark, "silver_csv")
    io.write_silver(silver(spark, sf_dir), path, fmt="csv")
    return io.read_table(spark, path, "csv", schema=SILVER_SCHEMA)


@register(
    "small_csv_roundtrip",
    O.W_CLEAN + f"SELECT shopping_mall, {O.SPEND_SUM} AS total_revenue FROM clean GROUP BY shopping_mall "
    "ORDER BY total_revenue DESC, shopping_mall LIMIT 10",
)
def q_small_csv_roundtrip(spark, sf_dir):
    """The ten malls with the most revenue as a single CSV file and back."""
    path = scratch_path(spark, "small_csv")
    revenue = L.mall_revenue(silver(spark, sf_dir))
    io.write_small_csv(revenue, path, 10, [F.desc("total_revenue"), F.asc("shopping_mall")])
    return io.read_table(spark, path, "csv", schema=revenue.schema)


_RULES_SQL = {
    "ids_present": "customer_id <> '' AND customer_id <> 'NA' AND invoice_no <> ''",
    "not_test_invoice": "NOT contains(lower(invoice_no), 'test')",
    "not_dummy_category": "NOT regexp_matches(lower(category), 'test|dummy')",
    "quantity_in_bounds": "quantity > 0 AND quantity <= 1000",
    "price_in_bounds": "price > 0 AND price <= 100000",
}
_RULES_SQL["any"] = " AND ".join(f"({r})" for r in _RULES_SQL.values())


@register(
    "rejected_by_rule",
    O.W_PARSED
    + " UNION ALL ".join(
        f"SELECT '{n}' AS rule, COUNT(*) FILTER (WHERE NOT coalesce({r}, FALSE)) AS rejected, COUNT(*) AS rows FROM parsed" for n, r in _RULES_SQL.items()
    ),
)
def q_rejected_by_rule(spark, sf_dir):
    """Rows that fail each rule, counted while the staged table is written."""
    rows, rejects = C.observed_rejects(C.staged(raw(staging_session(spark), sf_dir)))
    io.write_table(rows, scratch_path(spark, "observed"), partition_by=[C.IS_MALFORMED])
    return C.reject_table(spark, rejects)


@register(
    "quarantined_lines",
    O.W_RAW + "SELECT 'broken,' || invoice_no AS malformed_line, FALSE AS passes FROM raw WHERE regexp_matches(invoice_no, '^[A-Za-z0-9]+$')",
)
def q_quarantined_lines(spark, sf_dir):
    """A CSV of all raw lines and as many of two fields: staged in one pass,
    the latter lie in a folder of their own, as they stood in the file."""
    path = scratch_path(spark, "broken_csv")
    lines = raw(spark, sf_dir).select(*RAW_COLUMNS)
    io.write_table(lines, path, fmt="csv")
    short = lines.where(F.col("invoice_no").rlike("^[A-Za-z0-9]+$")).select(F.lit("broken").alias("invoice_no"), F.col("invoice_no").alias("customer_id"))
    io.write_table(short, path, fmt="csv", mode="append")
    staged = scratch_path(spark, "staged_lines")
    every = io.read_transactions(staging_session(spark), path, malformed=C.MALFORMED)
    io.write_table(C.staged(every), staged, partition_by=[C.IS_MALFORMED])
    return C.malformed_lines(io.read_table(spark, staged))


@register("append_roundtrip", O.W_CLEAN + "SELECT * FROM clean")
def q_append_roundtrip(spark, sf_dir):
    """Silver written in two halves, the second one appended. Made once."""
    path = scratch_path(spark, "append")
    s = stored_silver(spark, sf_dir)
    early = F.coalesce(F.col("invoice_month") <= 6, F.lit(False))
    io.write_silver(s.where(early), path)
    io.write_silver(s.where(~early), path, mode="append")
    return _read_silver(spark, path)


@register(
    "sql_result_roundtrip",
    O.W_CLEAN + "SELECT payment_method, age_band, COUNT(*) AS c, MIN(invoice_dt) AS first_day FROM clean GROUP BY ALL",
)
def q_sql_result_roundtrip(spark, sf_dir):
    """The result of a SQL statement over a view as parquet and back."""
    path = scratch_path(spark, "sql_result")
    result = spark.sql(
        "SELECT payment_method, age_band, COUNT(*) AS c, MIN(invoice_dt) AS first_day FROM {tx} GROUP BY ALL",
        tx=silver(spark, sf_dir),
    )
    io.write_table(result, path)
    return io.read_table(spark, path)


# --------------------------------------------------------------------------
# gold: months, categories, distributions, signals
# --------------------------------------------------------------------------


def _monthly_sql(src: str) -> str:
    return f"SELECT year_month, COUNT(*) AS tx_count, {O.PRICE_MEAN} AS avg_price FROM {src} GROUP BY year_month"


@register("monthly_summary", O.W_CLEAN + _monthly_sql("clean"))
def q_monthly_summary(spark, sf_dir):
    return K.monthly_summary(silver(spark, sf_dir))


@register("monthly_summary_raw", O.W_PARSED + _monthly_sql("parsed"))
def q_monthly_summary_raw(spark, sf_dir):
    return K.monthly_summary(parsed(spark, sf_dir))


_SPLIT_MONTH = (
    "concat_ws('-', split_part(invoice_date, '/', 3), lpad(split_part(invoice_date, '/', 2), 2, '0'))"
)


@register(
    "monthly_summary_by_split",
    O.W_PARSED
    + f"SELECT {_SPLIT_MONTH} AS year_month, COUNT(*) AS tx_count, {O.PRICE_MEAN} AS avg_price FROM parsed "
    "WHERE regexp_matches(invoice_date, '^[0-9]+/[0-9]+/[0-9]{4}$') GROUP BY 1",
)
def q_monthly_summary_by_split(spark, sf_dir):
    """The monthly summary with the month taken from ``d/m/y`` text by splitting."""
    dated = parsed(spark, sf_dir).where(F.col("invoice_date").rlike(r"^[0-9]+/[0-9]+/[0-9]{4}$"))
    return K.monthly_summary(dated.withColumn("year_month", year_month_from_text("invoice_date")))


def _category_cte(src: str) -> str:
    return f"""
cat AS (
SELECT category, COUNT(*) AS tx, coalesce({O.SPEND_SUM}, 0.0) AS total_spend
FROM {src} WHERE category IS NOT NULL AND category <> '' GROUP BY category),
cat_avg AS (SELECT category, tx, total_spend, total_spend / tx AS avg_spend_per_tx FROM cat)"""


@register("category_avg_spend", _sql(O.W_CLEAN, _category_cte("clean"), body="SELECT * FROM cat_avg"))
def q_category_avg_spend(spark, sf_dir):
    return K.category_avg_spend(silver(spark, sf_dir))


@register("category_avg_spend_raw", _sql(O.W_PARSED, _category_cte("parsed"), body="SELECT * FROM cat_avg"))
def q_category_avg_spend_raw(spark, sf_dir):
    return K.category_avg_spend(parsed(spark, sf_dir))


@register(
    "category_top10",
    _sql(O.W_CLEAN, _category_cte("clean"), body="SELECT * FROM cat_avg ORDER BY avg_spend_per_tx DESC, category LIMIT 10"),
)
def q_category_top10(spark, sf_dir):
    return K.category_top(silver(spark, sf_dir), 10)


def _dist_row(col: str) -> str:
    return (
        f"SELECT '{col}' AS feature, COUNT({col}) AS count, {O.mean_pd(col)} AS mean, "
        f"round(stddev_pop({col}), 6) AS stddev, CAST(min({col}) AS DOUBLE) AS min, "
        f"CAST(max({col}) AS DOUBLE) AS max FROM parsed"
    )


@register("numeric_distributions", O.W_PARSED + _dist_row("quantity") + "\nUNION ALL\n" + _dist_row("price"))
def q_numeric_distributions(spark, sf_dir):
    return K.numeric_distributions(parsed(spark, sf_dir))


@register(
    "signals_ranked",
    _sql(
        O.W_PARSED,
        _category_cte("parsed"),
        body=f"""SELECT 'quantity_mean' AS signal, 'simple' AS kind, round({O.mean_pd('quantity')}, 2) AS value FROM parsed
UNION ALL SELECT 'price_mean', 'simple', round({O.mean_pd('price')}, 2) FROM parsed
UNION ALL SELECT * FROM (SELECT category, 'category_avg_spend', round(avg_spend_per_tx, 2) FROM cat_avg
                         ORDER BY avg_spend_per_tx DESC, category LIMIT 10)""",
    ),
)
def q_signals_ranked(spark, sf_dir):
    return K.signals_ranked(parsed(spark, sf_dir), 10)


# --------------------------------------------------------------------------
# gold: baskets, bands, payments
# --------------------------------------------------------------------------

_BASKET_KEYS = "invoice_no, customer_id, shopping_mall, year_month"


@register(
    "invoice_baskets",
    O.W_CLEAN
    + f"""SELECT {_BASKET_KEYS}, {O.SPEND_SUM} AS basket_spend, {O.QTY_SUM} AS basket_items,
       COUNT(DISTINCT category) AS basket_category_count
FROM clean GROUP BY {_BASKET_KEYS}""",
)
def q_invoice_baskets(spark, sf_dir):
    return K.invoice_baskets(silver(spark, sf_dir))


@register(
    "mall_month_extended",
    _sql(
        O.W_CLEAN,
        f"""
b AS (SELECT {_BASKET_KEYS}, SUM(CAST(quantity AS {O.QD}) * CAST(price AS {O.PD})) AS s,
             SUM(CAST(quantity AS {O.QD})) AS i
      FROM clean GROUP BY {_BASKET_KEYS}),
m AS (SELECT shopping_mall, year_month, CAST(CAST(SUM(s) AS VARCHAR) AS DOUBLE) AS total_revenue,
             COUNT(*) AS num_invoices, CAST(CAST(SUM(i) AS VARCHAR) AS DOUBLE) AS items
      FROM b GROUP BY shopping_mall, year_month)""",
        body="""SELECT shopping_mall, year_month, total_revenue, num_invoices,
       total_revenue / num_invoices AS avg_basket_value, items / num_invoices AS avg_basket_items FROM m""",
    ),
)
def q_mall_month_extended(spark, sf_dir):
    return K.mall_month_extended(silver(spark, sf_dir))


@register(
    "age_band_category",
    O.W_CLEAN
    + f"SELECT age_band, category, {O.SPEND_SUM} AS total_revenue, {O.QTY_SUM} AS items_sold "
    "FROM clean GROUP BY age_band, category",
)
def q_age_band_category(spark, sf_dir):
    return K.age_band_category(silver(spark, sf_dir))


@register(
    "payment_behavior",
    O.W_CLEAN
    + f"SELECT shopping_mall, age_band, payment_method, {O.SPEND_SUM} AS total_revenue "
    "FROM clean GROUP BY shopping_mall, age_band, payment_method",
)
def q_payment_behavior(spark, sf_dir):
    return K.payment_behavior(silver(spark, sf_dir))


# --------------------------------------------------------------------------
# malls: counts, revenue layouts, pruning, dimension joins
# --------------------------------------------------------------------------


@register("mall_counts", O.W_CLEAN + "SELECT shopping_mall, COUNT(*) AS count FROM clean GROUP BY shopping_mall")
def q_mall_counts(spark, sf_dir):
    return F_.mall_counts(silver(spark, sf_dir))


_MALL_REVENUE_SQL = O.W_CLEAN + f"SELECT shopping_mall, {O.SPEND_SUM} AS total_revenue FROM clean GROUP BY shopping_mall"


@register("mall_revenue", _MALL_REVENUE_SQL)
def q_mall_revenue(spark, sf_dir):
    return L.mall_revenue(silver(spark, sf_dir))


@register("mall_revenue_repartitioned", _MALL_REVENUE_SQL)
def q_mall_revenue_repartitioned(spark, sf_dir):
    return L.mall_revenue(silver(spark, sf_dir), repartition=8)


_MM_SQL = f"SELECT shopping_mall, year_month, {O.SPEND_SUM} AS total_revenue FROM clean"


@register("mall_month_revenue", O.W_CLEAN + _MM_SQL + " GROUP BY shopping_mall, year_month")
def q_mall_month_revenue(spark, sf_dir):
    return L.mall_month_revenue(silver(spark, sf_dir))


@register("mall_month_revenue_year", O.W_CLEAN + _MM_SQL + f" WHERE {_YEAR_SQL} GROUP BY shopping_mall, year_month")
def q_mall_month_revenue_year(spark, sf_dir):
    return L.mall_month_revenue(silver(spark, sf_dir), year=ROUNDTRIP_YEAR)


_DIM_CTE = "\ndim AS (SELECT DISTINCT shopping_mall, 'General' AS mall_segment FROM clean)"


@register("mall_dimension", _sql(O.W_CLEAN, _DIM_CTE, body="SELECT * FROM dim"))
def q_mall_dimension(spark, sf_dir):
    return J.mall_dimension(silver(spark, sf_dir))


_JOIN_SQL = _sql(O.W_CLEAN, _DIM_CTE, body="SELECT clean.*, dim.mall_segment FROM clean LEFT JOIN dim USING (shopping_mall)")


def stored_dimension(spark, sf_dir):
    """The dimension from the stored mall tables, not from the fact rows."""
    return J.mall_dimension(malls(spark, sf_dir))


@register("mall_join_regular", _JOIN_SQL)
def q_mall_join_regular(spark, sf_dir):
    return J.join_mall_dim(silver(spark, sf_dir), stored_dimension(spark, sf_dir), strategy="merge")


@register("mall_join_broadcast", _JOIN_SQL)
def q_mall_join_broadcast(spark, sf_dir):
    return J.join_mall_dim(silver(spark, sf_dir), stored_dimension(spark, sf_dir), strategy="broadcast")


# --------------------------------------------------------------------------
# frequency tables and top-N
# --------------------------------------------------------------------------


def _freq_sql(col: str, where: str | None = None) -> str:
    cond = where or f"{col} IS NOT NULL AND {col} <> ''"
    return O.W_TRIMMED + f"SELECT {col}, COUNT(*) AS count FROM trimmed WHERE {cond} GROUP BY {col}"


for _col in ("category", "payment_method", "gender", "shopping_mall"):

    def _freq(spark, sf_dir, _c=_col):
        return F_.frequency(trimmed(spark, sf_dir), _c)

    register(f"freq_{_col}", _freq_sql(_col))(_freq)


@register("top5_ages", _freq_sql("age") + " ORDER BY count DESC, age LIMIT 5")
def q_top5_ages(spark, sf_dir):
    return F_.top_values(trimmed(spark, sf_dir), "age", 5)


@register("top5_malls", _freq_sql("shopping_mall") + " ORDER BY count DESC, shopping_mall LIMIT 5")
def q_top5_malls(spark, sf_dir):
    return F_.top_values(trimmed(spark, sf_dir), "shopping_mall", 5)


@register(
    "top_customers_by_quantity",
    O.W_PARSED
    + f"SELECT customer_id, coalesce({O.QTY_SUM}, 0.0) AS total_quantity FROM parsed WHERE {O.CUSTOMER_OK} "
    "GROUP BY customer_id ORDER BY total_quantity DESC, customer_id LIMIT 10",
)
def q_top_customers_by_quantity(spark, sf_dir):
    return K.top_customers_by_quantity(parsed(spark, sf_dir), 10)


@register(
    "customer_counts",
    O.W_TRIMMED + f"SELECT customer_id, COUNT(*) AS count FROM trimmed WHERE {O.CUSTOMER_OK} GROUP BY customer_id",
)
def q_customer_counts(spark, sf_dir):
    return F_.customer_counts(trimmed(spark, sf_dir))


@register(
    "top_customers_with_gender",
    _sql(
        O.W_TRIMMED,
        f"\nb AS (SELECT customer_id, gender, invoice_no FROM trimmed WHERE {O.CUSTOMER_OK})",
        "\nc AS (SELECT customer_id, COUNT(*) AS count FROM b GROUP BY customer_id)",
        """
g AS (SELECT customer_id, gender FROM (
        SELECT customer_id, gender, row_number() OVER (
          PARTITION BY customer_id ORDER BY invoice_no NULLS FIRST, gender NULLS FIRST) AS rn FROM b)
      WHERE rn = 1)""",
        body="SELECT c.customer_id, c.count, g.gender FROM c JOIN g USING (customer_id) "
        "ORDER BY c.count DESC, c.customer_id LIMIT 10",
    ),
)
def q_top_customers_with_gender(spark, sf_dir):
    return F_.top_customers_with_gender(trimmed(spark, sf_dir), 10)


@register(
    "first_gender",
    O.W_TRIMMED
    + f"""SELECT customer_id, gender FROM (
  SELECT customer_id, gender, row_number() OVER (
    PARTITION BY customer_id ORDER BY invoice_no NULLS FIRST, gender NULLS FIRST) AS rn
  FROM trimmed WHERE {O.CUSTOMER_OK}) WHERE rn = 1""",
)
def q_first_gender(spark, sf_dir):
    return F_.first_per_key(trimmed(spark, sf_dir).where(customer_present()), "customer_id", "gender", ["invoice_no"])


# --------------------------------------------------------------------------
# data-quality profile
# --------------------------------------------------------------------------


def _missing_sql() -> str:
    parts = []
    for c in RAW_COLUMNS:
        miss = f"{c} IS NULL OR {c} = ''"
        parts.append(
            f"SELECT '{c}' AS field, COUNT(*) AS rows, "
            f"CAST(SUM(CASE WHEN {miss} THEN 1 ELSE 0 END) AS BIGINT) AS missing FROM trimmed"
        )
    return O.W_TRIMMED + "\nUNION ALL\n".join(parts)


@register("missing_fields", _missing_sql())
def q_missing_fields(spark, sf_dir):
    return F_.missing_fields(trimmed(spark, sf_dir))


@register(
    "duplicate_invoices",
    O.W_TRIMMED + "SELECT invoice_no, COUNT(*) AS count FROM trimmed WHERE invoice_no IS NOT NULL AND invoice_no <> '' "
    "GROUP BY invoice_no HAVING COUNT(*) > 1",
)
def q_duplicate_invoices(spark, sf_dir):
    return F_.duplicate_keys(trimmed(spark, sf_dir), "invoice_no")


# --------------------------------------------------------------------------
# clusters over the category/customer edge list
# --------------------------------------------------------------------------

MIN_CLUSTER = 10
_EDGES = "\ne AS (SELECT category, customer_id FROM trimmed)"
_EC = f"\nec AS (SELECT category, COUNT(*) AS count FROM e GROUP BY category HAVING COUNT(*) >= {MIN_CLUSTER})"
_ET = "\net AS (SELECT * FROM e WHERE category IN (SELECT category FROM ec))"


def edges(spark, sf_dir):
    return CL.category_customer_edges(trimmed(spark, sf_dir))


def kept_edges(spark, sf_dir):
    e = edges(spark, sf_dir)
    return CL.threshold_edges(e, CL.entity_counts(e, MIN_CLUSTER))


@register("category_customer_edges", _sql(O.W_TRIMMED, _EDGES, body="SELECT * FROM e"))
def q_category_customer_edges(spark, sf_dir):
    return edges(spark, sf_dir)


@register("entity_counts", _sql(O.W_TRIMMED, _EDGES, _EC, body="SELECT * FROM ec"))
def q_entity_counts(spark, sf_dir):
    return CL.entity_counts(edges(spark, sf_dir), MIN_CLUSTER)


@register("edges_thresholded", _sql(O.W_TRIMMED, _EDGES, _EC, _ET, body="SELECT * FROM et"))
def q_edges_thresholded(spark, sf_dir):
    return kept_edges(spark, sf_dir)


@register(
    "cluster_sizes",
    _sql(O.W_TRIMMED, _EDGES, _EC, _ET, body="SELECT category, COUNT(*) AS count FROM et GROUP BY category"),
)
def q_cluster_sizes(spark, sf_dir):
    return CL.cluster_sizes(kept_edges(spark, sf_dir))


_CP = r"""
cp AS (SELECT category AS entity, CAST(price AS DOUBLE) AS price FROM trimmed
       WHERE regexp_matches(price, '^[0-9]+(\.[0-9]+)?$'))"""


@register("category_prices", _sql(O.W_TRIMMED, _CP, body="SELECT * FROM cp"))
def q_category_prices(spark, sf_dir):
    return CL.category_prices(trimmed(spark, sf_dir))


@register(
    "cluster_outcomes",
    _sql(
        O.W_TRIMMED,
        _CP,
        body=f"SELECT entity, COUNT(price) AS count, {O.mean_pd('price')} AS mean, median(price) AS median "
        "FROM cp GROUP BY entity",
    ),
)
def q_cluster_outcomes(spark, sf_dir):
    return CL.cluster_outcomes(CL.category_prices(trimmed(spark, sf_dir)))


_T30C = "\nt30c AS (SELECT category, COUNT(*) AS count FROM et GROUP BY category ORDER BY count DESC, category LIMIT 30)"
_T30O = "\nt30o AS (SELECT category, COUNT(*) AS count FROM e GROUP BY category ORDER BY count DESC, category LIMIT 30)"


@register("top30_clusters", _sql(O.W_TRIMMED, _EDGES, _EC, _ET, _T30C, body="SELECT * FROM t30c"))
def q_top30_clusters(spark, sf_dir):
    return CL.top_entities(kept_edges(spark, sf_dir), 30)


@register("top30_overall", _sql(O.W_TRIMMED, _EDGES, _T30O, body="SELECT * FROM t30o"))
def q_top30_overall(spark, sf_dir):
    return CL.top_entities(edges(spark, sf_dir), 30)


@register(
    "top30_diff",
    _sql(
        O.W_TRIMMED,
        _EDGES,
        _EC,
        _ET,
        _T30C,
        _T30O,
        body="""SELECT category, count, '<' AS side FROM (SELECT * FROM t30c EXCEPT ALL SELECT * FROM t30o)
UNION ALL SELECT category, count, '>' AS side FROM (SELECT * FROM t30o EXCEPT ALL SELECT * FROM t30c)""",
    ),
)
def q_top30_diff(spark, sf_dir):
    return CL.top_diff(CL.top_entities(kept_edges(spark, sf_dir), 30), CL.top_entities(edges(spark, sf_dir), 30))


@register(
    "edge_nodes",
    _sql(
        O.W_TRIMMED,
        _EDGES,
        _EC,
        _ET,
        """
e2 AS (SELECT category AS l, customer_id AS r FROM et
       WHERE category IS NOT NULL AND category <> '' AND customer_id IS NOT NULL AND customer_id <> ''),
ends AS (SELECT l AS node, r AS nbr, 1 AS is_left FROM e2 UNION ALL SELECT r, l, 0 FROM e2)""",
        body="SELECT node, CASE WHEN max(is_left) = 1 THEN 'entity' ELSE 'customer' END AS role, "
        "COUNT(DISTINCT nbr) AS degree FROM ends GROUP BY node",
    ),
)
def q_edge_nodes(spark, sf_dir):
    return CL.edge_nodes(kept_edges(spark, sf_dir))


# --------------------------------------------------------------------------
# layouts that spare reads and exchanges
# --------------------------------------------------------------------------


@register("customer_lookup", O.W_CLEAN + "SELECT * FROM clean WHERE customer_id = (SELECT MIN(customer_id) FROM clean)")
def q_customer_lookup(spark, sf_dir):
    """All lines of one customer from partitioned silver: files and row groups
    without the id are skipped."""
    path = scratch_path(spark, "lookup")
    io.write_silver(silver(spark, sf_dir), path)
    s = _read_silver(spark, path)
    first = s.agg(F.min("customer_id")).first()[0]
    return s.where(F.col("customer_id") == first)


def bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver in buckets of customers, as a table of the session's catalog."""
    path = scratch_path(spark, "bucketed")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return io.write_bucketed(silver(spark, sf_dir), path.rsplit("/", 1)[-1].replace("-", "_"), path, buckets)


@register("customer_summary_bucketed", ORACLE["customer_summary"])
def q_customer_summary_bucketed(spark, sf_dir):
    return K.customer_summary(bucketed(spark, sf_dir))


@register("invoice_baskets_bucketed", ORACLE["invoice_baskets"])
def q_invoice_baskets_bucketed(spark, sf_dir):
    return K.invoice_baskets(bucketed(spark, sf_dir))


# --------------------------------------------------------------------------
# appending: states of two inputs, merged
# --------------------------------------------------------------------------


def appended(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    """The states ``names`` of silver taken in as three batches that share
    most of their months and many of their keys. Silver is made once, as the
    job does, and all batches read its files."""
    s = stored_silver(spark, sf_dir)
    path = scratch_path(spark, "states")
    part = F.pmod(F.xxhash64("invoice_no", "category"), F.lit(5))
    for k, share in enumerate([part < 2, part == 2, part > 2]):
        rows = s.where(share)
        states = Versions(spark, path)
        months = [r[0] for r in rows.select(ST.MONTH).distinct().collect()]
        for name in names:
            states.add(name, ST.STATES[name], rows, months, f"batch-{k}")
        states.commit(f"batch-{k}", 0)
    last = Versions(spark, path)
    return [last.state(name, ST.STATES[name], s) for name in names]


@register("append_merge", ORACLE["customer_summary"])
def q_append_merge(spark, sf_dir):
    return ST.customer_summary(*appended(spark, sf_dir, "customers", "customer_prices"))


@register("append_merge_baskets", ORACLE["invoice_baskets"])
def q_append_merge_baskets(spark, sf_dir):
    """A basket whose categories come with different batches is one basket."""
    return ST.invoice_baskets(*appended(spark, sf_dir, "baskets"))


@register("append_merge_mall_months", ORACLE["mall_month_extended"])
def q_append_merge_mall_months(spark, sf_dir):
    return ST.mall_month_extended(*appended(spark, sf_dir, "baskets"))


@register("append_merge_months", ORACLE["monthly_summary"])
def q_append_merge_months(spark, sf_dir):
    return ST.monthly_summary(*appended(spark, sf_dir, "malls"))


@register("append_merge_categories", ORACLE["category_avg_spend"])
def q_append_merge_categories(spark, sf_dir):
    return ST.category_avg_spend(*appended(spark, sf_dir, "categories"))


# --------------------------------------------------------------------------
# samples and the classifier
# --------------------------------------------------------------------------


def _hash_sql(columns: list[str], *more: str) -> str:
    return "md5(concat_ws(chr(31), " + ", ".join([*(f"coalesce({c}, chr(0))" for c in columns), *more]) + "))"


def _sample_sql(src: str, columns: list[str], n: int, out: str) -> str:
    every = ", ".join(columns)
    return f"""
numbered AS (SELECT {every}, row_number() OVER (PARTITION BY {every}) AS i FROM {src}),
firsts AS (SELECT *, {_hash_sql(columns, "'1'", "'42'")} AS h1 FROM numbered),
drawn AS (SELECT *, CASE WHEN i = 1 THEN h1 ELSE md5(concat_ws(chr(31), h1, CAST(i AS VARCHAR), '42')) END AS h FROM firsts)
SELECT {out} FROM (SELECT * FROM drawn ORDER BY h, {", ".join(f"{c} NULLS FIRST" for c in columns)} LIMIT {n})"""


@register("sample_rows", O.W_RAW.rstrip() + "," + _sample_sql("raw", RAW_COLUMNS, 1000, ", ".join(RAW_COLUMNS)))
def q_sample_rows(spark, sf_dir):
    return S.sample_rows(raw(spark, sf_dir), 1000, 42)


@register("edge_sample", O.W_TRIMMED.rstrip() + "," + _sample_sql("trimmed", RAW_COLUMNS, 500, "category, customer_id"))
def q_edge_sample(spark, sf_dir):
    return S.edge_sample(trimmed(spark, sf_dir), 500, 42)


_IN_TRAIN = f"CAST(concat('0x', substr({_hash_sql(['invoice_no'], chr(39) + '42' + chr(39))}, 1, 8)) AS BIGINT) % 100 < 80"


@register("train_test_split", O.W_CLEAN + f"SELECT invoice_no, CASE WHEN {_IN_TRAIN} THEN 'train' ELSE 'test' END AS share, COUNT(*) AS rows FROM clean GROUP BY ALL")
def q_train_test_split(spark, sf_dir):
    train, test = S.train_test_split(silver(spark, sf_dir))
    both = train.withColumn("share", F.lit("train")).unionByName(test.withColumn("share", F.lit("test")))
    return both.groupBy("invoice_no", "share").agg(F.count(F.lit(1)).alias("rows"))


def training(spark, sf_dir):
    return M.basket_features(K.invoice_baskets(silver(spark, sf_dir)), stored_dimension(spark, sf_dir))


def stored_training(spark, sf_dir):
    """The training rows as files: a fit and its evaluation take many passes."""
    return io.stored(training(spark, sf_dir), scratch_path(spark, "training"))


@register(
    "high_spend_training",
    _sql(
        O.W_CLEAN,
        _DIM_CTE,
        f"""
b AS (SELECT {_BASKET_KEYS}, {O.SPEND_SUM} AS basket_spend, {O.QTY_SUM} AS basket_items,
             COUNT(DISTINCT category) AS basket_category_count FROM clean GROUP BY {_BASKET_KEYS})""",
        body="SELECT b.*, dim.mall_segment, CAST(b.basket_spend > 500 AS INT) AS high_spend "
        "FROM b LEFT JOIN dim USING (shopping_mall)",
    ),
)
def q_high_spend_training(spark, sf_dir):
    return training(spark, sf_dir)


@register("high_spend_predictions")
def q_high_spend_predictions(spark, sf_dir):
    model, test = M.HIGH_SPEND_BASKETS.fit_split(stored_training(spark, sf_dir), "invoice_no")
    return M.predictions(model, test)


@register("high_spend_auc")
def q_high_spend_auc(spark, sf_dir):
    model, test = M.HIGH_SPEND_BASKETS.fit_split(stored_training(spark, sf_dir), "invoice_no")
    return M.auc_table(M.predictions(model, test, flat=False))


@register(
    "basket_items_auc",
    _sql(
        O.W_CLEAN,
        f"""
b AS (SELECT {_BASKET_KEYS}, {O.SPEND_SUM} > 500 AS hit, {O.QTY_SUM} AS score FROM clean GROUP BY {_BASKET_KEYS}),
r AS (SELECT hit, rank() OVER (ORDER BY score) + (COUNT(*) OVER (PARTITION BY score) - 1) / 2.0 AS place FROM b)""",
        body="""SELECT round((SUM(place) FILTER (hit) - n1 * (n1 + 1) / 2.0) / (n1 * n0), 6) AS auc,
       CAST(any_value(n1 + n0) AS BIGINT) AS test_rows, 'areaUnderROC' AS metric
FROM r, (SELECT CAST(COUNT(*) FILTER (hit) AS DOUBLE) AS n1, CAST(COUNT(*) FILTER (NOT hit) AS DOUBLE) AS n0 FROM b)
GROUP BY n1, n0""",
    ),
)
def q_basket_items_auc(spark, sf_dir):
    """How well the number of items alone ranks high-spend baskets."""
    return M.auc_table(stored_training(spark, sf_dir), score="basket_items")
