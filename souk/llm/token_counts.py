"""Token counts by a separator scan of flat token files.

A token file is a plain run of 16-bit ids, each document closed by the
end-of-document id; nothing says where documents start. Files of any size are
read in blocks, ranges of bytes that are dealt out to the tasks. Each block is
searched for the separator on its own, by one vectorised comparison; what it
knows is how many separators it holds, the tokens before the first, between
them, and after the last. A prefix scan over these block summaries stitches
documents across blocks: it gives each block the number of documents closed
before it and the tokens left open. The scan runs in two levels (blocks within a
group of blocks, groups within a file), so a file of any length needs no task
that holds all its blocks.

``write_files`` writes documents as such files, one a task. Beside them stands
the order of the documents' ids, without places or lengths, so that counts can
be told per document. A task that is run again writes a file of its own name;
what counts are the files that the rows committed by Spark name.

Defined results: a null or empty text is a document of 0 tokens; tokens after
the last separator of a file are its last document; an empty file has none; a
byte left over at the end of a file is no token.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .bpe import PATTERN, read_ranks, vocabulary_path
from .common import by_bytes, filesystem, stored, table, text_or_empty

END = 50_256
#: Tokens of a block, and blocks of a group in the prefix scan.
BLOCK = 1 << 18
GROUP = 1 << 10


@lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=read_ranks(path), special_tokens={})


WRITTEN = "file string, size long, number long, doc_id long"


def write_files(docs: DataFrame, folder: str, path: str | None = None) -> DataFrame:
    """Writes one token file per partition of ``docs`` under ``folder``: rows
    ``(file, number, doc_id)`` of its documents in order, and ``(file, size)``
    of the files. Each action writes again: store the rows."""
    path = path or vocabulary_path()
    arrow = pa.schema([("file", pa.string()), ("size", pa.int64()), ("number", pa.int64()), ("doc_id", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(path).encode_ordinary
        store, place = filesystem(folder)
        store.create_dir(place, recursive=True)
        name = f"tokens-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.bin"
        out, size, number = None, 0, 0
        for batch in by_bytes(batches, 1, 256):
            out = out or store.open_output_stream(f"{place}/{name}")
            for text in batch.column(1).to_pylist():
                ids = np.array([*encode(text), END], "<u2").tobytes()
                out.write(ids)
                size += len(ids)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"] * n), pa.nulls(n, pa.int64()), pa.array(range(number, number + n), pa.int64()), batch.column(0)], schema=arrow)
            number += n
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"file": f"{folder}/{name}", "size": size}], schema=arrow)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return texts.mapInArrow(run, WRITTEN)


def files_in(spark: SparkSession, folder: str) -> DataFrame:
    """``(file, size)`` of the files in a folder; none is opened."""
    return spark.read.format("binaryFile").load(folder).select(F.col("path").alias("file"), F.col("length").alias("size"))


def ranges(files: DataFrame, block: int = BLOCK, tasks: int | None = None) -> DataFrame:
    """``(file, block, start, length)``: the bytes of each block of ``block``
    tokens, dealt out over ``tasks``, as many as the session's shuffles have."""
    bytes_ = F.lit(2 * block).cast("long")
    whole = F.col("size") - F.col("size") % 2
    cut = files.where("size > 1").select("file", whole.alias("size"), F.explode(F.sequence(F.lit(0).cast("long"), F.floor((whole - 1) / bytes_))).alias("block"))
    start = F.col("block") * bytes_
    each = cut.select("file", "block", start.alias("start"), F.least(bytes_, F.col("size") - start).alias("length"))
    return each.repartition(tasks or int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), "file", "block")


def scan_ranges(blocks: DataFrame, end: int = END) -> DataFrame:
    """Of each block: ``n_ends`` separators, ``head`` tokens before the first
    (all without one), ``inner`` lengths between them, ``tail`` after the last."""
    arrow = pa.schema(
        [("file", pa.string()), ("block", pa.int64()), ("n_ends", pa.int64()), ("head", pa.int64()), ("inner", pa.list_(pa.int64())), ("tail", pa.int64())]
    )

    def summary(data: bytes) -> tuple[int, int, np.ndarray, int]:
        tokens = np.frombuffer(data, "<u2")
        at = np.flatnonzero(tokens == end)
        if not len(at):
            return 0, len(tokens), at, len(tokens)
        return len(at), int(at[0]), np.diff(at) - 1, len(tokens) - int(at[-1]) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part, found = batch.slice(at, 64), []
                for path, start, length in zip(*(part.column(k).to_pylist() for k in (0, 2, 3))):
                    store, place = filesystem(path)
                    with store.open_input_file(place) as file:
                        found.append(summary(file.read_at(length, start)))
                columns = [pa.array(c, f.type) for c, f in zip(zip(*found), list(arrow)[2:])]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], schema=arrow)

    return blocks.mapInArrow(run, "file string, block long, n_ends long, head long, inner array<long>, tail long")


def _scan(rows: DataFrame, by: list[str], order: str) -> DataFrame:
    """Exclusive prefix scan of ``(n_ends, tail)``: adds ``ended``, the
    separators before a row, ``left``, the tokens since the last one, and
    ``reset``, whether there was one."""
    through = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*by).orderBy(order)
    run = Window.partitionBy(*by, "run").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = rows.withColumn("run", F.sum(F.when(F.col("n_ends") > 0, 1).otherwise(0)).over(through))
    after = marked.withColumns({"sum_ends": F.sum("n_ends").over(through), "sum_tail": F.sum("tail").over(run)})
    return after.withColumns(
        {
            "ended": F.col("sum_ends") - F.col("n_ends"),
            "left": F.coalesce(F.lag("sum_tail").over(before), F.lit(0)),
            "reset": F.coalesce(F.lag("run").over(before), F.lit(0)) > 0,
        }
    )


def document_lengths(scanned: DataFrame, group: int = GROUP) -> DataFrame:
    """``(file, number, n_tokens)`` of each document from block summaries."""
    slim = scanned.select("file", "block", "n_ends", "tail", F.floor(F.col("block") / group).alias("g"))
    inside = _scan(slim, ["file", "g"], "block")
    # what a whole group does to the scan: its last row, by a partial aggregate
    last = F.max_by(F.struct("sum_ends", "sum_tail"), "block").alias("s")
    groups = inside.groupBy("file", "g").agg(last).select("file", "g", F.col("s.sum_ends").alias("n_ends"), F.col("s.sum_tail").alias("tail"))
    across = _scan(groups, ["file"], "g").select("file", "g", F.col("ended").alias("ended0"), F.col("left").alias("left0"))
    carried = inside.join(across, ["file", "g"]).select(
        "file",
        "block",
        (F.col("ended0") + F.col("ended")).alias("ended"),
        (F.when(F.col("reset"), 0).otherwise(F.col("left0")) + F.col("left")).alias("left"),
    )
    met = scanned.join(carried, ["file", "block"])
    closed = met.where("n_ends > 0").select(
        "file",
        "ended",
        F.posexplode(F.concat(F.array(F.col("left") + F.col("head")), F.col("inner"))).alias("k", "n_tokens"),
    )
    closed = closed.select("file", (F.col("ended") + F.col("k")).alias("number"), "n_tokens")
    ends = met.groupBy("file").agg(F.max_by(F.struct("ended", "n_ends", "left", "tail"), "block").alias("z"))
    rest = F.when(F.col("z.n_ends") > 0, F.col("z.tail")).otherwise(F.col("z.left") + F.col("z.tail"))
    open_ = ends.select("file", (F.col("z.ended") + F.col("z.n_ends")).alias("number"), rest.alias("n_tokens")).where("n_tokens > 0")
    return closed.unionAll(open_)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = stored(write_files(table(spark, sf_dir, "documents"), scratch_path(spark, "tokens")), "token-files")
    files = written.where("size is not null").select("file", "size")
    scanned = stored(scan_ranges(ranges(files)), "token-blocks")
    order = written.where("size is null").select("file", "number", "doc_id")
    return order.join(document_lengths(scanned), ["file", "number"]).select("doc_id", "n_tokens")
