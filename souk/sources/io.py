"""Sources and sinks: CSV / TSV / parquet / delta reads and writes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import RAW_SCHEMA, SILVER_LOOKUP_COLUMNS, SILVER_PARTITION_COLUMNS

# Text options shared by every CSV/TSV read and write: quotes inside a value
# are doubled, and blanks inside values stay (the cleaning step trims them).
# The writer puts nothing for a null and a quoted "" for an empty string; the
# reader maps an unquoted empty field to a marker that no value uses (then to
# null) and a quoted "" to the empty string, so null and '' survive a round trip.
_TEXT_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
_READ_NULL_MARKER = "\u0000"
_MALFORMED = "_malformed"


def _text_reader(spark: SparkSession, schema: T.StructType | None, sep: str, multi_line: bool = False):
    r = (
        spark.read.options(**_TEXT_OPTIONS)
        .option("nullValue", _READ_NULL_MARKER)
        .option("emptyValue", "")
        .option("sep", sep)
        .option("mode", "PERMISSIVE")
        .option("multiLine", str(multi_line).lower())
    )
    return r.schema(schema) if schema is not None else r


def read_transactions(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RAW_SCHEMA,
    sep: str = ",",
    multi_line: bool = False,
    malformed: str | None = None,
) -> DataFrame:
    """Raw invoice CSV with a header and a fixed schema (no inference).
    ``multi_line`` takes quoted values with line breaks; a file is then read
    by one task, so leave it off for large files without such values.
    ``malformed`` names a further column: the line as it stands in the file
    where it hasn't the fields of the schema, else null. All fields are then
    looked at, whatever a plan needs."""
    if malformed is None:
        return _text_reader(spark, schema, sep, multi_line).csv(path)
    told = T.StructType([*schema.fields, T.StructField(malformed, T.StringType())])
    rows = _text_reader(spark, told, sep, multi_line).option("columnNameOfCorruptRecord", malformed)
    return rows.option("columnPruning", "false").csv(path)


def malformed_rows(
    spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA, sep: str = ",", multi_line: bool = False
) -> int:
    """How many rows don't have the fields of the schema, in a scan of its
    own. The job counts and keeps them while it stages the input."""
    every = read_transactions(spark, path, schema, sep, multi_line, _MALFORMED)
    bad = F.sum(F.when(F.col(_MALFORMED).isNotNull(), 1).otherwise(0))
    return every.agg(bad.alias("bad"), F.max(F.xxhash64(*schema.names))).first().bad or 0


def _map_text(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    return df.select(*[change(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else f.name for f in df.schema])


#: How signs that would break a line, or stand for a null, are written.
_ESCAPES = {"\n": "\\n", "\r": "\\r", _READ_NULL_MARKER: "\\0"}


def _one_line(c: Column) -> Column:
    """Backslashes doubled and line breaks and NUL written as ``\\n``, ``\\r``
    and ``\\0``, so that every row is one line, files stay splittable and no
    value is taken for a null."""
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for sign, written in _ESCAPES.items():
        c = F.replace(c, F.lit(sign), F.lit(written))
    return c


#: What doubled backslashes and a written NUL are for a while when they are
#: read: a line holds no NUL, so one stands here for nothing else.
_HELD = {"\\\\": ("\u0000b", "\\"), _ESCAPES[_READ_NULL_MARKER]: ("\u0000z", _READ_NULL_MARKER)}


def _many_lines(c: Column) -> Column:
    """Undoes :func:`_one_line`: between doubled backslashes, which are found
    from left to right, a single one starts an escape. The doubled ones are put
    aside first, so plain replacements do; a foreign value that holds a NUL is
    split at them."""
    read = c
    for written, (held, _) in _HELD.items():
        read = F.replace(read, F.lit(written), F.lit(held))
    for sign in "\n\r":
        read = F.replace(read, F.lit(_ESCAPES[sign]), F.lit(sign))
    for held, sign in _HELD.values():
        read = F.replace(read, F.lit(held), F.lit(sign))
    return F.when(~c.contains("\\"), c).when(c.contains(_READ_NULL_MARKER), _split_lines(c)).otherwise(read)


def _split_lines(c: Column) -> Column:
    def read(part: Column) -> Column:
        for sign, written in _ESCAPES.items():
            part = F.replace(part, F.lit(written), F.lit(sign))
        return part

    return F.array_join(F.transform(F.split(c, r"\\\\"), read), "\\")


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    sep: str = ",",
    base_path: str | None = None,
) -> DataFrame:
    """Read a table written by :func:`write_table` / :func:`write_silver`.

    CSV and TSV are read with a schema (``schema``) so that numbers and dates
    come back typed; parquet and delta are self-describing, and a given
    schema only pins the partition column types.
    """
    if fmt in ("csv", "tsv"):
        return _map_text(_text_reader(spark, schema, "\t" if fmt == "tsv" else sep).csv(path), _many_lines)
    reader = spark.read.format(fmt)
    if base_path:
        reader = reader.option("basePath", base_path)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
    overwrite: str = "static",
    compression: str | None = "zstd",
    sep: str = ",",
    options: dict[str, str] | None = None,
) -> None:
    """Write a table: parquet / delta / csv / tsv, with a header for text.
    A text row is one line: line breaks inside values are escaped, and
    :func:`read_table` restores them.

    ``overwrite="dynamic"`` replaces only the partitions present in ``df``
    (stale partitions stay); ``"static"`` rebuilds the whole table.
    ``options``: further ones of the writer.
    """
    text = fmt in ("csv", "tsv")
    w = (_map_text(df, _one_line) if text else df).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if mode == "overwrite":
        w = w.option("partitionOverwriteMode", overwrite)
    if text:
        w.options(**_TEXT_OPTIONS).option("sep", "\t" if fmt == "tsv" else sep).csv(path)
        return
    if fmt == "parquet" and compression:
        w = w.option("compression", compression)
    w.options(**(options or {})).format(fmt).save(path)


def stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written once and read back, for what takes several passes: each
    of them scans files instead of making the rows again."""
    write_table(df, path)
    return read_table(df.sparkSession, path, schema=df.schema)


def clustered_for_write(df: DataFrame, keys: Sequence[str], how: str = "rebalance") -> DataFrame:
    """Cluster rows by the partition keys before a partitioned write.

    ``rebalance`` (default) asks AQE for output partitions of the advisory
    size: rows of one key go together, but a hot key is split over several
    tasks and tiny keys are merged, so one mall holding a third of the rows
    does not become one task. ``repartition`` is the plain hash exchange
    (one file per directory, one task per key).
    """
    if how == "rebalance":
        return df.hint("rebalance", *keys)
    if how == "repartition":
        return df.repartition(*keys)
    if how == "none":
        return df
    raise ValueError(f"unknown clustering {how!r}")


def _bloom_filters(columns: Sequence[str]) -> dict[str, str]:
    """Writer options for a bloom filter on each column, as small as the values
    of a row group allow: of filters from a megabyte down to 64 bytes, each half
    of the one before, the smallest that still holds them is kept."""
    own = {"enabled": "true", "candidates.number": "15"}
    return {f"parquet.bloom.filter.{k}#{c}": v for k, v in own.items() for c in columns} | {"parquet.bloom.filter.adaptive.enabled": "true"}


def write_silver(
    tx: DataFrame,
    base: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    overwrite: str = "static",
    partition_by: Sequence[str] = SILVER_PARTITION_COLUMNS,
    clustering: str = "rebalance",
    lookup: Sequence[str] = SILVER_LOOKUP_COLUMNS,
) -> None:
    """Silver sink: parquet (zstd) or delta partitioned by month and mall;
    CSV and TSV unpartitioned, with a header.

    Rows of a file are in the order of the ``lookup`` columns, and parquet
    files have a bloom filter on each, so a scan for one customer or invoice
    skips the row groups that don't hold it. The order takes the place of the
    sort by partition that the writer does anyway."""
    if fmt in ("csv", "tsv"):
        write_table(tx, base, fmt=fmt, mode=mode)
        return
    clustered = clustered_for_write(tx, partition_by, clustering)
    lookup = [c for c in lookup if c in tx.columns]
    write_table(
        clustered.sortWithinPartitions(*partition_by, *lookup) if lookup else clustered,
        base,
        fmt=fmt,
        mode=mode,
        partition_by=list(partition_by),
        overwrite=overwrite,
        options=_bloom_filters(lookup) if fmt == "parquet" else None,
    )


def write_bucketed(tx: DataFrame, table: str, path: str, buckets: int, by: Sequence[str] = ("customer_id",), order: Sequence[str] = ("invoice_no",)) -> DataFrame:
    """A table of the catalog, at ``path``, whose rows are dealt into ``buckets``
    by the hash of ``by``. Aggregates and joins on keys that hold ``by`` need
    no exchange when they read it: customers, and the baskets of customers.
    The rows are exchanged once, here."""
    w = tx.repartition(buckets, *by).write.mode("overwrite").format("parquet").option("path", path).option("compression", "zstd")
    w.bucketBy(buckets, *by).sortBy(*by, *order).saveAsTable(table)
    return tx.sparkSession.table(table)


def write_small_csv(df: DataFrame, path: str, n: int = 10, order: Sequence | None = None) -> None:
    """A single-file CSV of the first ``n`` rows; one task only behind a limit."""
    small = df.orderBy(*order).limit(n) if order else df.limit(n)
    write_table(small.coalesce(1), path, fmt="csv")


def _place(spark: SparkSession, path: str):
    """A path of any file system that Spark knows, and that file system."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, fs = _place(spark, path)
    return fs.exists(place)


def children(spark: SparkSession, path: str) -> list:
    """What lies in a folder; nothing if there is none."""
    place, fs = _place(spark, path)
    return [status.getPath() for status in fs.listStatus(place)] if fs.exists(place) else []


def delete(spark: SparkSession, path: str) -> None:
    place, fs = _place(spark, path)
    fs.delete(place, True)
