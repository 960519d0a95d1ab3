"""Token ids in Arrow files of equal-length sequences.

Documents are sorted by range in ascending order of their ids and encoded
where they lie, each closed by the end id. A task writes what it gets as one
or more Arrow IPC files: the stream of record batches with a footer that tells
where each lies. A row is one sequence:

    ids     fixed_size_list<uint16 or uint32>[LENGTH]   padded with the end id
    mask    fixed_size_list<bool>[LENGTH]               false where padded
    doc_id  list<int64>                                 documents that end here
    end     list<int32>                                 tokens up to each end

Only the last sequence of a file is padded. All batches but the last have the
same number of rows and nothing is compressed, so sequence ``i`` is a slice of
a memory-mapped file: ``SequenceFile`` copies nothing.

A task that is run again writes files of its own names. What counts is the
manifest, one row a file, which Spark's commit protocol writes: a lost or
second attempt leaves at most files that no manifest names. Files are opened
by ``pyarrow.fs``, so the folder may be a path that all workers share or a URI
of a store that it knows.

Defined results: a null or empty text is the end id alone; ids sort with null
first, equal ids by the hash of their text; equal rows are documents of their
own; an empty table gives no file; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import posixpath
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .bpe import vocabulary_path
from .common import filesystem, parts_for, stored, table, text_or_empty

VOCABULARY = "byte_bpe_50k.json"
END = 0
#: Ids of a sequence, and sequences of a record batch.
LENGTH, SEQUENCES = 1024, 256
#: A file is closed at the first document that ends beyond this many tokens.
FILE_TOKENS = 1 << 27
#: Documents of a task.
ROWS_PER_TASK = 1 << 17
#: Chunks whose ids a worker remembers.
KNOWN = 1 << 19


@lru_cache(maxsize=2)
def _tokenizer(vocabulary: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks fill the cores
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(vocabulary)
    tokenizer.encode_special_tokens = True  # a text can't forge them
    return tokenizer


# Signs and letters at which the ends of pieces are certain, whatever stands around.
_LETTER, _SIGN, _SPACE = "A-Za-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", "!-/:-@\\[-`{-~", " \\t\\n\\r"

#: A text is cut where a piece of the tokenizer's pattern ends for certain: after
#: letters or digits in front of a sign; after signs, the last no apostrophe, in front
#: of letters or digits; after anything in front of a space, tab or line break (see
#: ``bpe``). So chunks encode alone as they do in the text.
CHUNK = re.compile(
    rf"\s*[{_LETTER}]+(?=[{_SPACE}{_SIGN}]|\Z)"
    rf"|\s*[{_SIGN}]*(?!')[{_SIGN}](?=[{_SPACE}{_LETTER}]|\Z)"
    rf"|\s*\S+(?:[^\S{_SPACE}]\s*\S*)*"
    r"|\s+"
)


class Encoder(dict):
    """Ids of texts as bytes of fixed width. The library encodes each distinct
    chunk, mostly a word, once for as long as it is remembered here."""

    def __init__(self, vocabulary: str, kind: str, end: int = END, known: int = KNOWN):
        super().__init__()
        self.tokenizer, self.kind, self.limit = _tokenizer(vocabulary), np.dtype(kind), known
        self.code = "H" if self.kind.itemsize == 2 else "I"
        self.end = array(self.code, [end]).tobytes()

    def __missing__(self, chunk: str) -> bytes:
        ids = array(self.code, self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()
        self[chunk] = ids
        return ids

    def ids(self, text: str) -> np.ndarray:
        """The ids of a text, with the end id."""
        found = np.frombuffer(b"".join([*map(self.__getitem__, CHUNK.findall(text)), self.end]), self.kind)
        if len(self) > self.limit:
            self.clear()
        return found


@lru_cache(maxsize=2)
def encoder(vocabulary: str, kind: str, end: int) -> Encoder:
    """One for all tasks of a worker."""
    return Encoder(vocabulary, kind, end)


def file_schema(kind: pa.DataType, length: int) -> pa.Schema:
    return pa.schema(
        [
            pa.field("ids", pa.list_(pa.field("item", kind, nullable=False), length), nullable=False),
            pa.field("mask", pa.list_(pa.field("item", pa.bool_(), nullable=False), length), nullable=False),
            pa.field("doc_id", pa.list_(pa.int64())),
            pa.field("end", pa.list_(pa.int32())),
        ]
    )


class SequenceWriter:
    """One file; holds at most a record batch and the document being added."""

    def __init__(self, folder: str, name: str, kind: pa.DataType, length: int = LENGTH, end: int = END):
        store, path = filesystem(folder)
        store.create_dir(path, recursive=True)
        self.path, self.length, self.end = posixpath.join(folder, name), length, end
        self.kind, self.schema = kind.to_pandas_dtype(), file_schema(kind, length)
        self.out = store.open_output_stream(posixpath.join(path, name))
        self.writer = pa.ipc.new_file(self.out, self.schema)
        self.held: list[np.ndarray] = []
        self.ends: list[tuple[int | None, int]] = []  # of documents, in tokens held
        self.waiting = self.tokens = self.docs = self.sequences = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.waiting += len(ids)
        self.tokens += len(ids)
        self.docs += 1
        self.ends.append((doc_id, self.waiting))
        if self.waiting >= self.length * SEQUENCES:
            self._flush()

    def _flush(self, all_: bool = False) -> None:
        """Writes the whole batches held, or everything."""
        size = self.length * SEQUENCES
        ids, ends, at = np.concatenate(self.held), self.ends, 0
        while len(ids) - at >= size or (all_ and at < len(ids)):
            stop = min(at + size, len(ids))
            done = sum(e <= stop for _, e in ends)
            self._write(ids[at:stop], [(d, e - at) for d, e in ends[:done]])
            ends, at = ends[done:], stop
        self.held, self.waiting = [ids[at:]], len(ids) - at
        self.ends = [(d, e - at) for d, e in ends]

    def _write(self, ids: np.ndarray, ends: list[tuple[int | None, int]]) -> None:
        rows = -(-len(ids) // self.length)
        padded = np.full(rows * self.length, self.end, self.kind)
        padded[: len(ids)] = ids
        mask = np.arange(rows * self.length) < len(ids)
        places = np.array([e for _, e in ends], np.int64)
        row = (places - 1) // self.length
        offsets = pa.array(np.searchsorted(row, np.arange(rows + 1)), pa.int32())
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(padded), type=self.schema.field("ids").type),
            pa.FixedSizeListArray.from_arrays(pa.array(mask), type=self.schema.field("mask").type),
            pa.ListArray.from_arrays(offsets, pa.array([d for d, _ in ends], pa.int64())),
            pa.ListArray.from_arrays(offsets, pa.array(places - row * self.length, pa.int32())),
        ]
        self.writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.sequences += rows

    def close(self) -> None:
        if self.held:
            self._flush(all_=True)
        self.writer.close()
        self.out.close()


class SequenceFile:
    """Random access to the sequences of a file, without copies where it can
    be mapped into memory."""

    def __init__(self, path: str):
        store, own = filesystem(path)
        local = isinstance(store, pafs.LocalFileSystem)
        self.source = pa.memory_map(own) if local else store.open_input_file(own)
        self.reader = pa.ipc.open_file(self.source)
        self.length = self.reader.schema.field("ids").type.list_size
        self.batches = self.reader.num_record_batches
        self.rows = self.reader.get_batch(0).num_rows if self.batches else 0
        last = self.reader.get_batch(self.batches - 1).num_rows if self.batches else 0
        self.count = max(0, self.batches - 1) * self.rows + last

    def __len__(self) -> int:
        return self.count

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """The ids and the mask of sequence ``i``."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        batch, row = self.reader.get_batch(i // self.rows), i % self.rows
        at = row * self.length
        ids, mask = batch.column("ids").values, batch.column("mask").values
        return ids.slice(at, self.length).to_numpy(zero_copy_only=True), mask.slice(at, self.length)

    def parts(self) -> Iterator[tuple[np.ndarray, list, np.ndarray]]:
        """Of each batch its ids in a row, and of the documents that end in it
        their ids and the places of their ends."""
        for k in range(self.batches):
            batch = self.reader.get_batch(k)
            ends = batch.column("end")
            counts = ends.value_lengths().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(batch.num_rows, dtype=np.int64), counts)
            places = row * self.length + ends.flatten().to_numpy()
            yield batch.column("ids").values.to_numpy(zero_copy_only=True), batch.column("doc_id").flatten().to_pylist(), places

    def close(self) -> None:
        self.source.close()


MANIFEST = "part int, piece int, path string, n_docs long, n_tokens long, n_sequences long"


def write_sequences(
    docs: DataFrame,
    folder: str,
    row_id: str = "doc_id",
    text: str = "text",
    vocabulary: str | None = None,
    end: int = END,
    length: int = LENGTH,
    file_tokens: int = FILE_TOKENS,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Writes ``docs`` as files under ``folder`` and returns the manifest,
    whose ``(part, piece)`` order is that of the documents. ``vocabulary``:
    path of a tokenizer's JSON on the driver, which is sent to the workers."""
    with open(vocabulary or vocabulary_path(VOCABULARY), encoding="utf-8") as file:
        model = file.read()
    largest = max([end, *json.loads(model)["model"]["vocab"].values(), *(t["id"] for t in json.loads(model)["added_tokens"])])
    kind = pa.uint16() if largest < 1 << 16 else pa.uint32()
    sent = docs.sparkSession.sparkContext.broadcast(model)
    own = docs.select(F.col(row_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    tied = own.withColumns({"_key": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    by = ["doc_id", "_key", "_row"]
    parts = parts_for(docs, docs.count(), rows_per_task)
    placed = tied.repartitionByRange(parts, *by).sortWithinPartitions(*by).select("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, piece, rows = encoder(sent.value, str(kind), end), TaskContext.get().partitionId(), 0, []
        writer = None

        def closed() -> None:
            writer.close()
            rows.append((part, piece, writer.path, writer.docs, writer.tokens, writer.sequences))

        for batch in batches:
            for doc_id, body in zip(batch.column(0), batch.column(1)):
                if writer is None:
                    writer = SequenceWriter(folder, f"part-{part:06d}-{piece:04d}-{uuid.uuid4().hex}.arrow", kind, length, end)
                writer.add(doc_id.as_py(), own.ids(body.as_py()))
                if writer.tokens >= file_tokens:
                    closed()
                    writer, piece = None, piece + 1
        if writer is not None:
            closed()
        names = [f.split()[0] for f in MANIFEST.split(", ")]
        types = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        columns = list(zip(*rows)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return stored(placed.mapInArrow(write, MANIFEST), "sequence-manifest")


def with_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with ``start``, the tokens of all files before. A row a
    file, so the files of a task are summed first and the tasks in one window."""
    tasks = manifest.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = tasks.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    return manifest.withColumn("own", own).join(based, "part").withColumn("start", F.col("base") + F.col("own")).drop("own", "base")


DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_documents(manifest: DataFrame) -> DataFrame:
    """Per document of the files: its id, the tokens before it, its tokens and
    their checksum as little-endian 32-bit numbers. One task reads whole files,
    a batch at a time."""
    names = [f.split()[0] for f in DOCUMENTS.split(", ")]
    files = with_starts(manifest).select("path", "start").repartition(max(1, manifest.count()))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                file = SequenceFile(path)
                crc = open_ = 0  # of the document that a batch left open
                for ids, docs, places in file.parts():
                    data = memoryview(ids.astype("<u4")).cast("B")
                    at, sums, sizes = 0, [], []
                    for place in places.tolist():
                        sums.append(zlib.crc32(data[4 * at : 4 * place], crc))
                        sizes.append(open_ + place - at)
                        at, crc, open_ = place, 0, 0
                    crc, open_ = zlib.crc32(data[4 * at :], crc), open_ + len(ids) - at
                    n = np.array(sizes, np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(docs, pa.int64()), pa.array(start + np.cumsum(n) - n), pa.array(n), pa.array(sums, pa.int64())], names=names
                    )
                    start += int(n.sum())
                file.close()

    return files.mapInArrow(read, DOCUMENTS)


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return read_documents(write_sequences(docs, scratch_path(spark, "sequences")))
