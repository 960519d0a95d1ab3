"""Repeatable samples and a hash split tied to row identity.

Hashes are MD5 over the fields as text: any engine can repeat them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .clusters import category_customer_edges
from .joins import MAX_BROADCAST_BYTES

#: Between the fields of a hashed row, and in place of a null.
FIELD_END, NULL_FIELD = "\x1f", "\x00"
#: Numbers of equal rows that are made at once, and bytes of a drawn hash.
BLOCK, HASH_BYTES = 1 << 16, 64


def row_hash(columns: list[str], *more: Column) -> Column:
    fields = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_FIELD)) for c in columns]
    return F.md5(F.concat_ws(FIELD_END, *fields, *more))


def sample_rows(df: DataFrame, n: int = 1000, seed: int = 42, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, uniform over rows and repeatable: the
    ``n`` smallest seeded hashes. The first of equal rows is hashed from its
    fields and number 1, the others from that hash and their number, so equal
    rows are drawn independently.

    Rows are fetched last: what is counted and exchanged is a row's hash, and
    the top-k keeps ``n`` of these in a task. The rows of the ``n`` drawn ones are
    then picked where they lie, by a broadcast of at most ``n`` hashes (where
    these take no more than ``max_bytes``). ``df`` is read twice."""
    columns = df.columns
    first = row_hash(columns, F.lit("1"), F.lit(str(seed)))
    # the second hash tells rows apart whose fields join to the same text
    keyed = df.select("*", first.alias("__h"), F.xxhash64(*columns).alias("__x"))
    counted = keyed.groupBy("__h", "__x").agg(F.count(F.lit(1)).alias("__c"))
    # numbers in blocks, so that none of many equal rows makes one long array
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__c") - 1) / BLOCK)))
    blocks = counted.select("__h", "__x", "__c", block.alias("__b"))
    numbers = F.sequence(F.col("__b") * BLOCK + 1, F.least(F.col("__c"), (F.col("__b") + 1) * BLOCK))
    each = blocks.select("__h", "__x", F.explode(numbers).alias("__i"))
    again = F.md5(F.concat_ws(FIELD_END, "__h", F.col("__i").cast("string"), F.lit(str(seed))))
    order = [F.when(F.col("__i") == 1, F.col("__h")).otherwise(again).alias("__o"), "__h", "__x", "__i"]
    drawn = each.select(*order).orderBy("__o", "__h", "__x", "__i").limit(n)
    wanted = drawn.groupBy("__h", "__x").agg(F.count(F.lit(1)).alias("__k"))
    met = keyed.join(F.broadcast(wanted) if n * HASH_BYTES <= max_bytes else wanted, ["__h", "__x"])
    # equal rows are one row so often
    one = met.groupBy("__h", "__x").agg(F.first(F.struct(*columns)).alias("__row"), F.first("__k").alias("__k"))
    return one.select(F.col("__row.*"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("__k"))).alias("__i")).select(*columns)


def edge_sample(tx: DataFrame, n: int = 500, seed: int = 42) -> DataFrame:
    """Edges of a row sample (sampling rows first keeps repeated edges as
    independent draws)."""
    return category_customer_edges(sample_rows(tx, n, seed))


def split_flag(key: str, pct: int = 80, seed: int = 42) -> Column:
    """True for the training share: the first 32 bits of the seeded hash of
    the key, modulo 100, are below ``pct``."""
    bits = F.conv(F.substring(row_hash([key], F.lit(str(seed))), 1, 8), 16, 10).cast("long")
    return bits % 100 < pct


def train_test_split(df: DataFrame, key: str = "invoice_no", pct: int = 80, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """A split that depends only on the key, not on partitioning."""
    flag = split_flag(key, pct, seed)
    return df.filter(flag), df.filter(~flag)
