"""Column expressions that clean raw invoice text (trim, quotes, separators,
missing markers, numeric and date coercion, calendar fields)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import DATE_FORMATS, MISSING_MARKER


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim every string column, driven by the schema; other columns pass."""
    return df.select(
        *[
            F.trim(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def strip_quotes(c: str | Column) -> Column:
    """Remove one surrounding double quote at either end."""
    return F.regexp_replace(_col(c), r'^"|"$', "")


def strip_thousands(c: str | Column) -> Column:
    """Drop thousands separators inside a numeric value: ``1,500.25`` -> ``1500.25``.
    The regex only runs on values that contain a comma."""
    col = _col(c)
    return F.when(col.contains(","), F.regexp_replace(col, r"(?<=\d),(?=\d{3})", "")).otherwise(col)


def fill_missing(c: str | Column, marker: str = MISSING_MARKER) -> Column:
    """Null or empty text becomes ``marker``; field by field."""
    return F.coalesce(F.nullif(_col(c), F.lit("")), F.lit(marker))


def to_number(c: str | Column, dtype: T.DataType | None = None) -> Column:
    """Numeric coercion that never raises: separators dropped, bad text -> null.

    ``dtype`` is the type of the input column; (trimmed) text is cleaned
    and ``try_cast``; numbers are only widened to double.
    """
    if dtype is not None and not isinstance(dtype, T.StringType):
        return _col(c).cast("double")
    return strip_thousands(_col(c)).try_cast("double")


_PATTERN_SHAPES = {
    "d": r"\d+",
    "dd": r"\d{2}",
    "M": r"\d+",
    "MM": r"\d{2}",
    "yyyy": r"[+-]?\d{4,}",
}


def format_shape(fmt: str) -> str | None:
    """A regex that every text accepted by the numeric date format ``fmt``
    matches (a necessary condition), or None when ``fmt`` has other letters."""
    out, i = "^", 0
    while i < len(fmt):
        j = i
        while j < len(fmt) and fmt[j] == fmt[i]:
            j += 1
        tok = fmt[i:j]
        if tok[0].isalpha():
            if tok not in _PATTERN_SHAPES:
                return None
            out += _PATTERN_SHAPES[tok]
        else:
            out += re.escape(tok)
        i = j
    return out + "$"


def parse_invoice_date(c: str | Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Parse a date over several formats; the first one that succeeds wins.

    Each ``try_to_date`` is guarded by a cheap shape test that any text the
    format accepts passes, so a text is only handed to the formats that can
    parse it; results equal the plain chain, without a parser failure per
    row and format.
    """
    col = _col(c)
    tries = []
    for f in formats:
        shape = format_shape(f)
        parse = F.try_to_date(col, f)
        tries.append(parse if shape is None else F.when(col.rlike(shape), parse))
    return F.coalesce(*tries)


def year_month_from_text(c: str | Column) -> Column:
    """``d/m/y`` text -> ``yyyy-MM`` by splitting, with a zero-padded month."""
    parts = F.split(_col(c), "/")
    return F.concat_ws("-", parts.getItem(2), F.lpad(parts.getItem(1), 2, "0"))
