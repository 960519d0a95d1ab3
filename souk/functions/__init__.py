"""Scalar column expressions (built-in Spark functions only, no UDFs)."""

from .cleaning import (
    fill_missing,
    parse_invoice_date,
    strip_quotes,
    strip_thousands,
    to_number,
    trim_strings,
    year_month_from_text,
)
from .derive import (
    age_band,
    exact_mean,
    exact_parts,
    high_spend_label,
    money,
    price_bucket,
    qty_sum,
    safe_div,
    spend,
    spend_parts,
    spend_sum,
    total,
)
from .predicates import (
    DEFAULT_RULES,
    customer_present,
    ids_present,
    non_empty,
    not_dummy_category,
    not_test_invoice,
    numeric_text,
    price_in_bounds,
    quality_filter,
    quality_predicate,
    quantity_in_bounds,
)

__all__ = [
    "DEFAULT_RULES",
    "age_band",
    "customer_present",
    "exact_mean",
    "exact_parts",
    "fill_missing",
    "high_spend_label",
    "ids_present",
    "money",
    "non_empty",
    "not_dummy_category",
    "not_test_invoice",
    "numeric_text",
    "parse_invoice_date",
    "price_bucket",
    "price_in_bounds",
    "qty_sum",
    "quality_filter",
    "quality_predicate",
    "quantity_in_bounds",
    "safe_div",
    "spend",
    "spend_parts",
    "spend_sum",
    "strip_quotes",
    "strip_thousands",
    "to_number",
    "total",
    "trim_strings",
    "year_month_from_text",
]
