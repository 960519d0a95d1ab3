"""Independent DuckDB SQL for every registered query.

Each statement rebuilds the ``transactions_raw`` view from the star-schema
tables (FIXTURES.md §2), cleans it, and computes the result its own way.
Money is summed as DECIMAL; the oracle casts decimals to double through
text so that the conversion is correctly rounded, as Spark's is.
"""

from __future__ import annotations

RAW = r"""
raw AS (
SELECT
  CASE WHEN l_orderkey % 113 = 0 THEN concat('test', CAST(l_orderkey AS VARCHAR))
       WHEN l_orderkey % 131 = 0 THEN ''
       WHEN l_linenumber % 5 = 0 THEN concat('  I', CAST(l_orderkey AS VARCHAR), ' ')
       ELSE concat('I', CAST(l_orderkey AS VARCHAR)) END              AS invoice_no,
  CASE WHEN o_custkey % 137 = 0 THEN NULL WHEN o_custkey % 139 = 0 THEN ''
       WHEN o_custkey % 149 = 0 THEN 'NA'
       ELSE concat('C', CAST(o_custkey AS VARCHAR)) END               AS customer_id,
  CASE WHEN c_nationkey % 2 = 0 THEN 'Female' ELSE 'Male' END         AS gender,
  CASE WHEN o_custkey % 41 = 0 THEN NULL
       ELSE CAST(18 + o_custkey % 52 AS VARCHAR) END                  AS age,
  CASE WHEN l_partkey % 127 = 0 THEN 'Dummy item'
       WHEN l_orderkey % 499 = 0 THEN concat('Rare ', CAST(l_orderkey AS VARCHAR))
       WHEN p_type = 'STANDARD' THEN 'STANDARD & MIXED'
       ELSE p_type END                                                AS category,
  CASE WHEN l_orderkey % 101 = 0 THEN '0' WHEN l_orderkey % 103 = 0 THEN '5000'
       WHEN l_orderkey % 107 = 0 THEN ''
       ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) END              AS quantity,
  CASE WHEN l_orderkey % 109 = 0 THEN '200000' WHEN l_orderkey % 151 = 0 THEN '-1'
       WHEN l_orderkey % 157 = 0 THEN '1,500.25'
       ELSE CAST(CAST(l_extendedprice / 500 AS DECIMAL(18,5)) AS VARCHAR) END AS price,
  o_orderpriority                                                     AS payment_method,
  CASE WHEN l_orderkey % 163 = 0 THEN 'bad'
       WHEN l_linenumber % 4 = 0 THEN strftime(l_shipdate, '%Y-%-m-%-d')
       WHEN l_linenumber % 4 = 1 THEN strftime(l_shipdate, '%Y/%m/%d')
       WHEN l_linenumber = 2 AND day(l_shipdate) > 12 THEN strftime(l_shipdate, '%-m/%-d/%Y')
       ELSE strftime(l_shipdate, '%-d/%-m/%Y') END                    AS invoice_date,
  concat('Mall of ', n_name)                                          AS shopping_mall
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey
)"""

# trimmed + typed + enriched, no quality filter
PARSED = r"""
typed AS (
SELECT trim(invoice_no) AS invoice_no, trim(customer_id) AS customer_id, trim(gender) AS gender,
       CAST(TRY_CAST(trim(age) AS DOUBLE) AS INT) AS age, trim(category) AS category,
       TRY_CAST(replace(trim(quantity), ',', '') AS DOUBLE) AS quantity,
       TRY_CAST(replace(trim(price), ',', '') AS DOUBLE) AS price,
       trim(payment_method) AS payment_method, trim(invoice_date) AS invoice_date,
       trim(shopping_mall) AS shopping_mall,
       CAST(try_strptime(trim(invoice_date), ['%d/%m/%Y', '%m/%d/%Y', '%Y-%m-%d', '%Y/%m/%d']) AS DATE) AS invoice_dt
FROM raw),
parsed AS (
SELECT invoice_no, customer_id, gender, age, category, quantity, price, payment_method,
       invoice_date, shopping_mall, invoice_dt,
       CAST(year(invoice_dt) AS INT) AS invoice_year,
       CAST(month(invoice_dt) AS INT) AS invoice_month,
       strftime(invoice_dt, '%Y-%m') AS year_month,
       lower(category) AS category_lower,
       quantity * price AS spend,
       CASE WHEN age IS NULL THEN 'unknown' WHEN age < 20 THEN '0-19' WHEN age < 30 THEN '20-29'
            WHEN age < 40 THEN '30-39' WHEN age < 50 THEN '40-49' WHEN age < 60 THEN '50-59'
            ELSE '60+' END AS age_band
FROM typed)"""

CLEAN = r"""
clean AS (
SELECT * FROM parsed
WHERE customer_id IS NOT NULL AND customer_id <> '' AND customer_id <> 'NA'
  AND invoice_no IS NOT NULL AND invoice_no <> '' AND NOT contains(lower(invoice_no), 'test')
  AND category IS NOT NULL AND NOT regexp_matches(lower(category), 'test|dummy')
  AND quantity > 0 AND quantity <= 1000 AND price > 0 AND price <= 100000)"""

# text-level cleaning (trim, quotes, separators in numeric fields, NA marker)
FIELDS = r"""
fields AS (
SELECT coalesce(nullif(trim(regexp_replace(trim(invoice_no), '^"|"$', '', 'g')), ''), 'NA') AS invoice_no,
       coalesce(nullif(trim(regexp_replace(trim(customer_id), '^"|"$', '', 'g')), ''), 'NA') AS customer_id,
       coalesce(nullif(trim(regexp_replace(trim(gender), '^"|"$', '', 'g')), ''), 'NA') AS gender,
       coalesce(nullif(replace(trim(regexp_replace(trim(age), '^"|"$', '', 'g')), ',', ''), ''), 'NA') AS age,
       coalesce(nullif(trim(regexp_replace(trim(category), '^"|"$', '', 'g')), ''), 'NA') AS category,
       coalesce(nullif(replace(trim(regexp_replace(trim(quantity), '^"|"$', '', 'g')), ',', ''), ''), 'NA') AS quantity,
       coalesce(nullif(replace(trim(regexp_replace(trim(price), '^"|"$', '', 'g')), ',', ''), ''), 'NA') AS price,
       coalesce(nullif(trim(regexp_replace(trim(payment_method), '^"|"$', '', 'g')), ''), 'NA') AS payment_method,
       coalesce(nullif(trim(regexp_replace(trim(invoice_date), '^"|"$', '', 'g')), ''), 'NA') AS invoice_date,
       coalesce(nullif(trim(regexp_replace(trim(shopping_mall), '^"|"$', '', 'g')), ''), 'NA') AS shopping_mall
FROM raw)"""

# exact money: decimal sums, cast to double through text. The widths are the
# oracle's own: far wider than any planted number needs, and not the engine's.
QD = "DECIMAL(13,5)"
PD = "DECIMAL(25,9)"


def dsum(expr: str) -> str:
    return f"CAST(CAST(SUM({expr}) AS VARCHAR) AS DOUBLE)"


SPEND_SUM = dsum(f"CAST(quantity AS {QD}) * CAST(price AS {PD})")
QTY_SUM = dsum(f"CAST(quantity AS {QD})")
PRICE_MEAN = f"({dsum(f'CAST(price AS {PD})')} / COUNT(price))"


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


W_RAW = with_ctes(RAW)
W_PARSED = with_ctes(RAW, PARSED)
W_CLEAN = with_ctes(RAW, PARSED, CLEAN)
W_FIELDS = with_ctes(RAW, FIELDS)


def mean_pd(col: str) -> str:
    """Exact mean of a column summed as DECIMAL."""
    return f"({dsum(f'CAST({col} AS {PD})')} / COUNT({col}))"


# trimmed raw text (no coercion)
TRIMMED = r"""
trimmed AS (
SELECT trim(invoice_no) AS invoice_no, trim(customer_id) AS customer_id, trim(gender) AS gender, trim(age) AS age,
       trim(category) AS category, trim(quantity) AS quantity, trim(price) AS price,
       trim(payment_method) AS payment_method, trim(invoice_date) AS invoice_date,
       trim(shopping_mall) AS shopping_mall
FROM raw)"""

W_TRIMMED = with_ctes(RAW, TRIMMED)
CUSTOMER_OK = "customer_id IS NOT NULL AND customer_id <> '' AND customer_id <> 'NA'"
