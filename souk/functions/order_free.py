"""Sums of doubles that don't depend on the order in which they are added.

A finite double is cut into whole numbers of two neighbouring limbs: limb
``k`` counts multiples of ``2**(52 k)``, and a number of 53 bits lies in limb
``k`` of its leading bit and the one below. Amounts of one limb are summed as
DECIMAL(38, 0), which 2**40 rows don't fill, so sums are exact and partial sums
may meet in any order, over any partitioning and any number of merges. Carries
are settled once, at the end, and the total is rounded to a double there.

Few numbers need it (what a DECIMAL of their column holds exactly is summed as
one, see ``derive.exact_parts``), so limbs are rows of their own: ``with_limbs``
adds them to a table as rows with a ``limb``, and an aggregate by ``(keys,
limb)`` is a mergeable state. Everything is in built-in expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 52
#: Limbs of the smallest subnormal's bits and of the carry out of the largest double.
LOWEST, HIGHEST = -21, 20
BASE = 1 << BITS
AMOUNT = "decimal(38,0)"
ENTRIES = "array<struct<limb: int, of: int, amount: bigint>>"

#: The column of a limb's number; null on the rows of the table itself.
LIMB = "limb"


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def _entries(x: str, of: int) -> str:
    """SQL: the two limbs of a number, marked as the value ``of``; none of
    null, zero and numbers that aren't finite."""
    high = f"named_struct('limb', {x}__k, 'of', {of}, 'amount', {x}__h)"
    low = f"named_struct('limb', {x}__k - 1, 'of', {of}, 'amount', CAST(({x}__y - {x}__h) * {float(BASE)!r}D AS BIGINT))"
    return f"CASE WHEN {x}__k IS NOT NULL THEN array({high}, {low}) ELSE CAST(array() AS {ENTRIES}) END"


def with_limbs(df: DataFrame, rests: list[str]) -> DataFrame:
    """``df`` with the columns ``limb``, ``of`` and ``amount``: each row once
    with nulls there, and once more per limb of its columns ``rests``.

    The limb of the leading bit comes from a logarithm, which is rounded, and
    is settled by comparison with the powers themselves. What is used more than
    once is a column, so that the planner doesn't copy it."""
    lowest, least = LOWEST + 1, f"CAST(floor(log2(abs(x)) / {BITS}) AS INT)"
    steps = {
        "n": f"CASE WHEN x <> 0 AND NOT isnan(x) AND abs(x) < double('infinity') THEN greatest({least}, {lowest}) END",
        "k": f"CASE WHEN abs(x) >= pow(2.0D, (x__n + 1) * {BITS}) THEN x__n + 1 "
        f"WHEN abs(x) < pow(2.0D, x__n * {BITS}) AND x__n > {lowest} THEN x__n - 1 ELSE x__n END",
        "y": f"x / pow(2.0D, x__k * {BITS})",
        "h": "CASE WHEN x__y >= 0 THEN floor(x__y) ELSE ceil(x__y) END",
    }
    rows = df
    for name, sql in steps.items():
        rows = rows.withColumns({f"{x}__{name}": F.expr(re.sub(r"\bx(?=\b|__)", x, sql)) for x in rests})
    own = f"CAST(array(named_struct('limb', NULL, 'of', NULL, 'amount', NULL)) AS {ENTRIES})"
    some = " OR ".join(f"{x}__k IS NOT NULL" for x in rests) or "FALSE"
    every = f"concat({', '.join([own, *(_entries(x, k) for k, x in enumerate(rests))])})"
    return rows.select(*df.columns, F.expr(f"inline(CASE WHEN {some} THEN {every} ELSE {own} END)"))


def limb_sum(of: int) -> Column:
    """Aggregate by ``(keys, limb)``: the limb's amount of the value ``of``."""
    return F.sum(F.when(F.col("of") == of, F.col("amount"))).cast(AMOUNT)


def special_sum(x: Column) -> Column:
    """Sum of the values that aren't finite, alike in any order; null without one."""
    return F.sum(F.when(F.col(LIMB).isNull() & ~finite(x), x))


def limbs(amount: str | Column) -> Column:
    """Aggregate over rows of several limbs: a list for :func:`value_of`, at
    most as many entries as limbs times the tables merged."""
    a = F.col(amount) if isinstance(amount, str) else amount
    return F.collect_list(F.when(F.col(LIMB).isNotNull() & a.isNotNull(), F.struct(F.col(LIMB).alias("limb"), a.cast(AMOUNT).alias("amount"))))


def _settled(listed: str, sign: str) -> str:
    """SQL: the carry out of the highest limb, and the digits from the lowest up."""
    amount = f"aggregate(filter({listed}, e -> e.limb = k), acc.carry, (s, e) -> CAST(s {sign} e.amount AS {AMOUNT}))"
    digit = f"CAST(pmod(a, {BASE}) AS {AMOUNT})"
    carry = f"CAST(CAST(a - {digit} AS {AMOUNT}) / {BASE} AS {AMOUNT})"
    step = f"transform(array({amount}), a -> named_struct('carry', {carry}, 'digits', concat(acc.digits, array({digit}))))[0]"
    start = f"named_struct('carry', CAST(0 AS {AMOUNT}), 'digits', CAST(array() AS array<{AMOUNT}>))"
    return f"aggregate(sequence({LOWEST}, {HIGHEST}), {start}, (acc, k) -> {step})"


def _total(settled: str) -> str:
    """SQL: the digits as a double, from the highest down."""
    k, one = f"(i + {LOWEST})", float(1 << BITS)
    low = f"CAST(d AS DOUBLE) / {one!r}D * pow(2.0D, ({k} + 1) * {BITS})"
    high = f"CAST(d AS DOUBLE) * pow(2.0D, {k} * {BITS})"
    weighed = f"transform({settled}.digits, (d, i) -> CASE WHEN d = 0 THEN 0.0D WHEN {k} < 0 THEN {low} ELSE {high} END)"
    return f"aggregate(reverse({weighed}), 0.0D, (s, x) -> s + x)"


def value_of(listed: str) -> Column:
    """The double nearest to the total of a column made by :func:`limbs`, to a
    unit in the last place; null for an empty list. SQL text, as the
    expression is long and each call to build it would cost."""
    signed = f"CASE WHEN p.carry < 0 THEN -({_total(_settled(listed, '-'))}) ELSE {_total('p')} END"
    return F.expr(f"CASE WHEN size({listed}) > 0 THEN transform(array({_settled(listed, '+')}), p -> {signed})[0] END")


def combined(*parts: Column) -> Column:
    """Sum of the parts that aren't null; null if all are."""
    known = F.coalesce(*parts)
    return F.when(known.isNotNull(), sum((F.coalesce(p, F.lit(0.0)) for p in parts[1:]), F.coalesce(parts[0], F.lit(0.0))))
