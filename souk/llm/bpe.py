"""Byte-level BPE encoding and decoding by monoid tree reduction.

A text is halved down to short leaves, each leaf is encoded alone, and
neighbours are joined up the tree. Joining ``a + b`` keeps the tokens that
cannot change and encodes a window around the seam again. The window grows on
either side until it starts and ends at a stable place: in front of a space,
tab or line break that follows a character that isn't white space. There a
piece (a match of the pattern) always ends, whatever stands around: no
alternative goes on from such a character to white space, none looks back, and
only white space looks ahead, at what follows itself. So the tokens on either
side of such a place are those of the two parts alone, and what lies outside
the window is final. A side without such a place is taken whole.

Joining is associative and the result doesn't depend on the cuts. Decoding
concatenates the bytes of the ids up a tree as well.

Spark deals out the documents; each row is reduced where it lies, so nothing
is exchanged. Defined results: a null or empty text has no ids and decodes to
empty bytes; extra columns of the input are kept.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import DOCUMENT_COLUMNS, table, text_or_empty

#: Folder of the public tokenizers, importable as ``public_tokenizers`` or not.
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
TOKENIZERS = "/opt/tokenizers"

#: Characters of a leaf: most documents are several.
LEAF = 1 << 11
#: Characters on either side of a seam that are looked at first.
REACH = 32


def vocabulary_path(name: str = VOCABULARY, folder: str = TOKENIZERS) -> str:
    try:
        import public_tokenizers

        return public_tokenizers.path(name)
    except ImportError:
        return f"{folder}/{name}"


# Fixed value: the pattern that splits a text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


Part = tuple[str, list[int]]  # a text and its ids


class Codec:
    """Ids of texts by the ranks of a vocabulary, and bytes of ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        import tiktoken

        self.leaf_ids = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.bytes_of = {rank: token for token, rank in ranks.items()}

    def join(self, left: Part, right: Part) -> Part:
        """The joined text and its ids."""
        (a, ids_a), (b, ids_b) = left, right
        start, end = stable_end(a), stable_start(b)
        old_a, old_b = self.leaf_ids(a[start:]), self.leaf_ids(b[:end])
        seam = self.leaf_ids(a[start:] + b[:end])
        return a + b, ids_a[: len(ids_a) - len(old_a)] + seam + ids_b[len(old_b) :]

    def reduce(self, text: str, leaf: int) -> Part:
        if len(text) <= leaf:
            return text, self.leaf_ids(text)
        half = len(text) // 2
        return self.join(self.reduce(text[:half], leaf), self.reduce(text[half:], leaf))

    def encode(self, text: str, leaf: int = LEAF) -> list[int]:
        return self.reduce(text, leaf)[1]

    def decode(self, ids: list[int], leaf: int = LEAF) -> bytes:
        if len(ids) <= leaf:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half], leaf) + self.decode(ids[half:], leaf)


def _stable(text: str, at: int) -> bool:
    return text[at] in " \t\n\r" and not text[at - 1].isspace()


def stable_end(text: str) -> int:
    """The last stable place of a text, searched in growing windows; 0 if
    there is none."""
    reach, high = REACH, len(text)
    while high > 1:
        low = max(1, len(text) - reach)
        for at in range(high - 1, low - 1, -1):
            if _stable(text, at):
                return at
        reach, high = 2 * reach, low
    return 0


def stable_start(text: str) -> int:
    """The first stable place of a text; its end if there is none."""
    reach, low = REACH, 1
    while low < len(text):
        high = min(len(text), reach)
        for at in range(low, high):
            if _stable(text, at):
                return at
        reach, low = 2 * reach, max(high, low)
    return len(text)


@lru_cache(maxsize=2)
def codec(path: str, pattern: str = PATTERN) -> Codec:
    return Codec(read_ranks(path), pattern)


def _mapped(df: DataFrame, source: str, added: list[T.StructField], convert: Callable[[list], list[pa.Array]]) -> DataFrame:
    """``df`` with columns made from another one, a few rows at a time."""
    keep = df.drop(*[f.name for f in added])
    schema = T.StructType([*keep.schema.fields, *added])
    names, at = schema.names, keep.columns.index(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                yield pa.RecordBatch.from_arrays([*part.columns, *convert(part.column(at).to_pylist())], names=names)
            pa.default_memory_pool().release_unused()

    return keep.mapInArrow(run, schema)


#: Rows that a task holds as Python objects at once.
ROWS = 64


def encode(
    docs: DataFrame, text: str = "text", ids: str = "ids", decoded: str | None = None, path: str | None = None, leaf: int = LEAF
) -> DataFrame:
    """``docs`` with the token ids of ``text`` as an array; with ``decoded``,
    also the bytes that these ids decode to, in the same pass."""
    path = path or vocabulary_path()

    def convert(texts: list) -> list[pa.Array]:
        c = codec(path)
        lists = [c.encode(t or "", leaf) for t in texts]
        out = [pa.array(lists, pa.list_(pa.int32()))]
        return out if decoded is None else [*out, pa.array([c.decode(x) for x in lists], pa.binary())]

    added = [T.StructField(ids, T.ArrayType(T.IntegerType()))]
    return _mapped(docs, text, added if decoded is None else [*added, T.StructField(decoded, T.BinaryType())], convert)


def decode(encoded: DataFrame, ids: str = "ids", decoded: str = "decoded", path: str | None = None) -> DataFrame:
    """``encoded`` with the bytes that the token ids stand for."""
    path = path or vocabulary_path()

    def convert(lists: list) -> list[pa.Array]:
        c = codec(path)
        return [pa.array([c.decode(x or []) for x in lists], pa.binary())]

    return _mapped(encoded, ids, [T.StructField(decoded, T.BinaryType())], convert)


def with_digests(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``."""
    round_trip = encode(docs, decoded="decoded")
    return round_trip.select(
        *[c for c in round_trip.columns if c not in ("text", "ids", "decoded")],
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return with_digests(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: the documents with their ids, and whether
    these decode to the text."""
    round_trip = encode(docs.select(*DOCUMENT_COLUMNS), decoded="decoded")
    return round_trip.select(
        *DOCUMENT_COLUMNS,
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        (F.col("decoded") == F.encode(text_or_empty(), "UTF-8")).alias("decodes"),
    )
