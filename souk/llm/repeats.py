"""Periodic runs of words by online dyadic square catching.

A run is a maximal stretch of words with smallest period ``q`` that is at
least ``4 q`` words (and six) long. Words are appended to a ``SquareCatcher``;
how they are cut into appends doesn't change what it finds.

Level ``k`` looks for periods ``q`` in ``[2**k, 2**(k + 1))``. As soon as a
block of ``2**k`` words is complete, a catcher holds it: with each word
appended after it, the last ``2**k`` words are compared with the block, at
distances ``2**k`` to ``2**(k + 1) - 1``. A match at distance ``q`` is a square
in the making; it's caught once the last ``2**k`` words of its second half match
those of the first, as the two comparisons cover all ``q`` words, and the words
after it go on like the block. The first whole block of a run starts before the
run's word ``2**k``, so all of that lies in the run's first ``4 q`` words: no run
escapes. What two stretches of ``2**k`` words have in common is told by names:
the name of ``2**k`` words is made from those of its halves, so comparing the
suffix after one more word costs one step, and a whole append is one array
comparison a level.

A caught square is extended word by word on both sides, which also rules out
names that agree by chance. Squares within a known stretch whose period is a
multiple of the stretch's merge into it, so a long run is extended once and not
for each block and multiple of its period, and what is left has its smallest
period: a smaller one would divide it and be known from a lower level.

Work is ``O(n log n)`` array steps for ``n`` words, memory a few words a word.
Spark deals out the documents; nothing is exchanged.

Defined results: a null or empty text has no words and no run; a document
without id is never made periodic; equal rows give equal results; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: A run has at least this many words, and this many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4

#: Odd factors by which the names of two halves are joined.
_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

Run = tuple[int, int, int]  # start, length, period


def _join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = left * _LEFT + right * _RIGHT
    return mixed ^ (mixed >> np.uint64(29))


def same_ahead(words: np.ndarray, start: int, period: int) -> int:
    """Words from ``start`` on that equal the one a period later."""
    at, step, end = start, 32, len(words) - period
    while at < end:
        stop = min(end, at + step)
        differ = np.flatnonzero(words[at:stop] != words[at + period : stop + period])
        if len(differ):
            return at + int(differ[0]) - start
        at, step = stop, step * 2
    return max(0, end - start)


def same_behind(words: np.ndarray, end: int, period: int) -> int:
    """Words before ``end`` that equal the one a period later."""
    at, step = end, 32
    while at > 0:
        start = max(0, at - step)
        differ = np.flatnonzero(words[start:at] != words[start + period : at + period])
        if len(differ):
            return end - (start + int(differ[-1]) + 1)
        at, step = start, step * 2
    return end


class SquareCatcher:
    """Runs of a growing sequence of word numbers."""

    def __init__(self) -> None:
        self.words = np.zeros(0, np.int64)
        #: names of the last stretches of each level, and the first's place
        self.names: list[tuple[int, np.ndarray]] = []
        #: stretches known: {period: [(start, end)]}, ends of open ones still move
        self.known: dict[int, list[tuple[int, int]]] = {}

    def append(self, words: np.ndarray) -> None:
        old, self.words = len(self.words), np.concatenate([self.words, words])
        self._grow(old)
        fresh, place = np.asarray(words).astype(np.uint64) + np.uint64(1), old
        level = 0
        while len(fresh):
            size = 1 << level
            if level == len(self.names):
                self.names.append((place, np.zeros(0, np.uint64)))
            first, kept = self.names[level]
            names = np.concatenate([kept, fresh])
            self._catch(level, first, names, place)
            # names of twice the size that end in the new words
            begin = max(0, place - size - first)
            fresh = _join(names[begin : max(begin, len(names) - size)], names[begin + size :])
            place = first + begin
            # a catcher watches up to three blocks ahead, in whole blocks
            keep = max(0, (first + len(names) - 4 * size) // size * size - first)
            self.names[level] = (first + keep, names[keep:].copy())
            level += 1

    def _grow(self, old: int) -> None:
        """Moves the ends of stretches that reached the end of the words."""
        for period, stretches in self.known.items():
            for k, (start, end) in enumerate(stretches):
                if end == old:
                    stretches[k] = (start, end + same_ahead(self.words, end - period, period))

    def _catch(self, level: int, first: int, names: np.ndarray, place: int) -> None:
        """Squares whose last comparison is one of the names from ``place``."""
        size = 1 << level
        begin = -(-first // size) * size
        blocks = (first + len(names) - begin - size) // size
        if blocks <= 0:
            return
        own = names[begin - first : begin - first + (blocks + 1) * size].reshape(blocks + 1, size)
        block, shift = np.nonzero(own[1:] == own[:-1, :1])
        start, period = begin + block * size, size + shift
        # words that go on after two periods; of those not there yet a later append tells
        after = start + 2 * period - first
        new = (after < len(names)) & (after + first >= place)
        start, period, after = start[new], period[new], after[new]
        end = after - size  # the last words of the second period
        caught = (names[end - period] == names[end]) & (names[after] == names[after - 2 * period])
        start, period = start[caught], period[caught]
        # what lies in a known stretch of a divisor of the period merges into it
        merged = np.zeros(len(start), bool)
        for q, stretches in self.known.items() if len(start) else ():
            for s, e in stretches:
                if q < 2 * size and e - s >= 2 * size:
                    own = slice(*np.searchsorted(start, [s, e - 2 * size + 1]))
                    merged[own] |= (period[own] % q == 0) & (start[own] + 2 * period[own] <= e)
        start, period = start[~merged], period[~merged]
        order = np.lexsort((start, period))
        q, e = 0, 0
        for k in order.tolist():
            b = int(start[k])
            if period[k] == q and b + 2 * q <= e:
                continue
            q = int(period[k])
            s, e = b - same_behind(self.words, b, q), b + q + same_ahead(self.words, b, q)
            if e - s >= 2 * q:  # else names agreed by chance
                self.known.setdefault(q, []).append((s, e))

    def runs(self) -> list[Run]:
        found = [(s, e - s, q) for q, stretches in self.known.items() for s, e in stretches if e - s >= max(LEAST_WORDS, LEAST_PERIODS * q)]
        return sorted(set(found), key=lambda r: (r[0], r[2]))


def numbered(words: list) -> np.ndarray:
    """Equal words have equal numbers."""
    seen: dict = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def runs_of(words: list) -> list[Run]:
    """The runs ``(start, length, period)`` by start, then period."""
    catcher = SquareCatcher()
    catcher.append(numbered(words))
    return catcher.runs()


def greatest(runs: list[Run]) -> Run | None:
    """The run with the greatest exact length / period; the first of equals."""

    def compare(a: Run, b: Run) -> int:
        return b[1] * a[2] - a[1] * b[2]

    return min(runs, key=cmp_to_key(compare), default=None)


def collapsed(words: list, runs: list[Run]) -> list:
    """The words outside of runs, and of each run its first period, unless
    another run drops it."""
    if not runs:
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return [words[k] for k in np.flatnonzero(np.cumsum(edges[:-1]) == 0)]


def planted(doc_id: int | None, words: list) -> list:
    """The words of a document, made periodic from some word on if the
    checksum of its id says so."""
    n = len(words)
    if doc_id is None or not n:
        return words
    g, chosen = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if chosen:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_runs", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("period", pa.int64()),
        ("exponent_milli", pa.int64()),
        ("runs_sha256", pa.string()),
        ("collapsed_sha256", pa.string()),
    ]
)
DDL = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"

#: Texts that a task holds as Python objects at once.
ROWS = 64


def _report(doc_id: int | None, words: list) -> tuple:
    runs = runs_of(words)
    top = greatest(runs)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = b" ".join(collapsed(words, runs))
    first = (None, None, None, None) if top is None else (*top, 1000 * top[1] // top[2])
    return doc_id, len(runs), *first, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()


def _words(text: bytes | None) -> list[bytes]:
    return (text or b"").split()  # of bytes: ASCII white space alone


def periodic_runs(docs: DataFrame, row_id: str = "doc_id", text: str = "text", plant: bool = False) -> DataFrame:
    """Per row its id, its runs ``(start, length, period)`` and the collapsed text."""
    own = docs.select(F.col(row_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                found, texts = [], []
                for doc_id, own_text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    words = planted(doc_id, _words(own_text)) if plant else _words(own_text)
                    runs = runs_of(words)
                    found.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                    texts.append(b" ".join(collapsed(words, runs)).decode())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.list_(run)), pa.array(texts, pa.string())], names=["doc_id", "runs", "collapsed"])

    return own.mapInArrow(find, "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def run_report(docs: DataFrame, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row the digest columns of its runs, after planting."""
    own = docs.select(F.col(row_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                rows = [_report(i, planted(i, _words(t))) for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), SCHEMA)], schema=SCHEMA)

    return own.mapInArrow(find, DDL)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_report(table(spark, sf_dir, "documents"))
