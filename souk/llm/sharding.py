"""Sharding by histogram sort (law ``bytes``: shards of nearly equal size).

Rows are ordered by ``(hash of the text, hash of the id)``, so equal texts lie
together. The boundaries between shards ("splitters") are found by counting
exact bytes below candidate boundaries: each round splits the key range that
still holds a wanted boundary into 2**BITS equal parts and sums the bytes of
each part in one distributed aggregate. A boundary is taken as soon as a part
edge is within the tolerance, so equal texts stay in one shard unless their
group alone is larger than the tolerance; such a group is then cut by the hash
of the id. Rows are exchanged once, to number the slots of each shard.

Defined results: a null text has size 1 and crc32 0; equal rows may land in
one shard together; an empty table gives no rows; other columns are kept
(``size``, ``law``, ``shard``, ``slot`` of the input are replaced).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table, text_or_empty

SHARDS = 16
#: Share of the ideal shard size by which a boundary may miss its place.
TOLERANCE = 0.002
#: Each round splits an open range into 2**BITS parts.
BITS = 12
#: Rows numbered by one window group.
ROWS_PER_BUCKET = 4096

LOW, HIGH = -(1 << 63), (1 << 63) - 1


@dataclass(frozen=True)
class Range:
    """Keys ``lo <= k < lo + 2**shift`` of the text hash, or of the id hash
    within one text hash ``of``; ``below`` bytes lie before it."""

    lo: int
    shift: int
    below: int
    of: int | None = None

    @property
    def hi(self) -> int:
        return self.lo + (1 << self.shift) - 1

    def holds(self) -> Column:
        if self.of is None:
            return F.col("_text_key").between(self.lo, self.hi)
        return (F.col("_text_key") == self.of) & F.col("_id_key").between(self.lo, self.hi)

    def part(self) -> Column:
        """Number of the part of this range that a row falls in."""
        key = F.col("_text_key" if self.of is None else "_id_key")
        step = max(0, self.shift - BITS)
        return F.shiftright(key, step) - F.lit(self.lo >> step)


def with_keys(docs: DataFrame, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """Adds the size (UTF-8 bytes plus 1) and the two sort keys of each row."""
    body = text_or_empty(text)
    return docs.withColumns(
        {
            "size": (F.octet_length(body) + 1).cast("long"),
            "_text_key": F.xxhash64(body),
            "_id_key": F.xxhash64(F.col(row_id)),
        }
    )


def bytes_by_part(keyed: DataFrame, ranges: list[Range]) -> dict[int, list[tuple[int, int, int]]]:
    """Exact bytes and rows of each non-empty part of each range: at most
    ``len(ranges) * 2**BITS`` rows reach the driver."""
    which = F.coalesce(*[F.when(r.holds(), F.lit(i)) for i, r in enumerate(ranges)])
    part = F.coalesce(*[F.when(r.holds(), r.part()) for r in ranges])
    counted = (
        keyed.select(which.alias("r"), part.alias("p"), "size")
        .where(F.col("r").isNotNull())
        .groupBy("r", "p")
        .agg(F.sum("size").alias("b"), F.count("*").alias("n"))
    )
    found: dict[int, list[tuple[int, int, int]]] = {i: [] for i in range(len(ranges))}
    for row in counted.toLocalIterator():
        found[row.r].append((row.p, row.b, row.n))
    return {i: sorted(x) for i, x in found.items()}


def find_splitters(keyed: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """The ``shards - 1`` boundaries ``(text key, id key)``, ascending: a row
    is in shard i if exactly i boundaries are at or below its keys."""
    whole = Range(LOW, 64, 0)
    counted = {whole: bytes_by_part(keyed, [whole])[0]}
    total = sum(b for _, b, _ in counted[whole])
    if total == 0:
        return []
    slack = tolerance * total / shards
    splitters: list[tuple[int, int]] = []
    open_ranges = {j: whole for j in range(1, shards)}
    while open_ranges:
        still_open: dict[int, Range] = {}
        for j, r in open_ranges.items():
            goal, seen = total * j / shards, r.below
            step = max(0, r.shift - BITS)
            for part, size, rows in counted[r]:
                if seen + size < goal:
                    seen += size
                    continue
                start, end = r.lo + (part << step), r.lo + ((part + 1) << step)
                near = min((abs(seen - goal), start), (abs(seen + size - goal), end))
                if near[0] <= slack or rows == 1 or (step == 0 and r.of is not None):
                    splitters.append(_boundary(r, near[1]))
                elif step == 0:  # all the texts of one hash: go on by the id
                    still_open[j] = Range(LOW, 64, seen, of=start)
                else:
                    still_open[j] = Range(start, step, seen, of=r.of)
                break
        open_ranges = still_open
        ranges = sorted(set(open_ranges.values()), key=lambda r: (r.below, r.lo))
        counted = dict(zip(ranges, bytes_by_part(keyed, ranges).values())) if ranges else {}
    return sorted(splitters)


def _boundary(r: Range, at: int) -> tuple[int, int]:
    if r.of is None:
        return (at, LOW)
    return (r.of, at) if at <= HIGH else (r.of + 1, LOW)


def shard_of(splitters: list[tuple[int, int]]) -> Column:
    """Number of boundaries at or below a row's keys."""
    number = F.lit(0)
    for text_key, id_key in splitters:
        if text_key > HIGH:
            continue
        at = F.col("_text_key") == text_key
        if id_key > LOW:
            at = at & (F.col("_id_key") >= id_key)
        number = number + F.when((F.col("_text_key") > text_key) | at, 1).otherwise(0)
    return number.cast("int")


def number_slots(sharded: DataFrame, keys: DataFrame, rows: int, shards: int = SHARDS) -> DataFrame:
    """Adds ``slot``, gapless from 0 within each shard. Rows are numbered in
    small buckets of a shard and shifted by the rows of the buckets before,
    so no task holds a whole shard. ``keys``: shard and keys of the same rows."""
    buckets = max(1, rows // (shards * ROWS_PER_BUCKET))
    bucket = F.pmod("_id_key", F.lit(buckets)).alias("_bucket")
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = (
        keys.groupBy("shard", bucket)
        .agg(F.count("*").alias("n"))
        .select("shard", "_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))
    )
    inside = Window.partitionBy("shard", "_bucket").orderBy("_id_key", "_text_key")
    return (
        sharded.withColumn("_bucket", bucket)
        .withColumn("_nr", F.row_number().over(inside))
        .join(first, ["shard", "_bucket"])
        .withColumn("slot", F.col("_first") + F.col("_nr") - 1)
        .drop("_nr", "_first", "_bucket")
    )


def shard_documents(
    docs: DataFrame, text: str = "text", row_id: str = "doc_id", shards: int = SHARDS, tolerance: float = TOLERANCE
) -> DataFrame:
    """``docs`` with ``size``, ``law``, ``shard`` and ``slot``."""
    keyed = with_keys(docs.drop("size", "law", "shard", "slot"), text, row_id)
    keys = stored(keyed.select("size", "_text_key", "_id_key"), "shard-keys")
    shard = shard_of(find_splitters(keys, shards, tolerance)).alias("shard")
    sharded = keyed.select("*", F.lit("bytes").alias("law"), shard)
    return number_slots(sharded, keys.select("*", shard), keys.count(), shards).drop("_text_key", "_id_key")


def write_shards(sharded: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """One folder per shard; a file holds consecutive slots."""
    chunk = F.floor(F.col("slot") / rows_per_file)
    sharded.repartition("shard", chunk).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("text_crc32", F.crc32(text_or_empty()))
    return shard_documents(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "size",
        "text_crc32",
        "law",
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
