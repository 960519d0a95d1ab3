"""Benchmark decontamination: SimHash over item-sized windows.

Every benchmark item of L words is compared with the windows of L words of
every document. A window that is alike shares at least one shingle with the
item, so windows around shared shingles are all that can match; their
fingerprints come from running sums of the word signs. Fingerprints within
RADIUS bits of an item are found through RADIUS + 1 blocks of bits: two that
differ in at most RADIUS bits agree in one block at least. Windows that are
alike may be further apart, so the fingerprint is no condition: windows it
misses are candidates too if the item's shingles in them weigh enough. Only
items with one of their rarest shingles in the document can get there, which
is how they are found. Candidates are verified by the exact weighted similarity
of their shingles: weight of the common ones over weight of all, a shingle
weighing ln(1 + items / items that have it).

Documents never meet each other: one pass over the table, no exchange. The
items are cut into blocks of at most ITEMS_PER_BLOCK shingles by a hash, and a
block (not the whole benchmark) is sent to the tasks; a larger benchmark takes
more passes. Items that have a shingle are counted over the whole benchmark, so
blocks don't change a weight; every block comes with the counts above one, as
a window may hold shingles of items of other blocks.

Defined results: A-Z is lower-cased, words are split at ASCII white space;
items with fewer than five words are one shingle; null, empty or blank items
and documents match nothing; equal items are reported each; of overlapping
windows that match one item the most alike, then the first, is reported; a
document with fewer words than an item is its one window, whole; a similarity
within TIE of SIMILARITY is equal to it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import DOCUMENT_COLUMNS, table
from .shingles import TOGETHER, distinct, mix, roll, signed, word_hashes

SHINGLE = 5
SIMILARITY = 0.75
TIE = 1e-9
RADIUS = 12
#: Shingles of the items that are sent to the tasks at a time (8 bytes each).
ITEMS_PER_BLOCK = 2_000_000
FILTER_BITS = 20


@dataclass
class Item:
    item_id: int
    n_words: int
    shingles: np.ndarray
    fingerprint: np.uint64
    weights: np.ndarray | None = None
    total: float = 0.0


def signs(hashes: np.ndarray) -> np.ndarray:
    """Plus or minus one for each of the 64 bits of each word."""
    bits = np.unpackbits(mix(hashes).view(np.uint8), bitorder="little").reshape(len(hashes), 64)
    return bits.astype(np.int32) * 2 - 1


def fingerprints(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view(np.uint64).reshape(-1)


#: Items of the whole benchmark; shingles that several items have, in order; how many have each.
Counts = tuple[int, np.ndarray, np.ndarray]


def counted(sets: list[np.ndarray]) -> Counts:
    """Counts of these items alone."""
    shingles, share = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_counts=True)
    return len(sets), shingles[share > 1], share[share > 1]


class Index:
    """Items by number of words and, within one, by each block of bits."""

    def __init__(self, rows: list[tuple[int, bytes]], counts: Counts | None = None):
        self.items: list[Item] = []
        for item_id, text in rows:
            h, _ = word_hashes([text], lower=True)
            if len(h):
                grams = distinct(roll(h, min(SHINGLE, len(h))))
                self.items.append(Item(item_id, len(h), grams, fingerprints(signs(h).sum(axis=0)[None, :])[0]))
        n_items, self.repeated, share = counts or counted([i.shingles for i in self.items])
        self.alone = math.log1p(n_items)
        self.weight_repeated = np.log1p(n_items / share)
        self.sizes = sorted({min(SHINGLE, i.n_words) for i in self.items})
        own: dict[int, tuple[list, list]] = {}
        for k, i in enumerate(self.items):
            grams, lengths = own.setdefault(min(SHINGLE, i.n_words), ([], []))
            grams.append(i.shingles)
            lengths.append(np.full(len(i.shingles), i.n_words))
        #: per shingle size: shingles in order, with the lengths of items that have them
        self.grams: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for size, (grams, lengths) in own.items():
            both = np.unique(np.stack([np.concatenate(grams).view(np.int64), np.concatenate(lengths)]), axis=1)
            order = np.argsort(both[0].view(np.uint64), kind="stable")
            g = both[0][order].view(np.uint64)
            passes = np.zeros(1 << FILTER_BITS, bool)
            passes[(g >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
            self.grams[size] = (g, both[1][order], passes)
        edges = np.linspace(0, 64, RADIUS + 2).astype(int)
        self.blocks = [(np.uint64(a), np.uint64((1 << (b - a)) - 1)) for a, b in zip(edges, edges[1:])]
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, list]] = {}
        for n in {i.n_words for i in self.items}:
            ids = np.array([k for k, i in enumerate(self.items) if i.n_words == n])
            prints = np.array([self.items[k].fingerprint for k in ids], np.uint64)
            tables = []
            for shift, mask in self.blocks:
                value = ((prints >> shift) & mask).astype(np.int64)
                order = np.argsort(value, kind="stable")
                starts = np.searchsorted(value[order], np.arange(int(mask) + 2))
                tables.append((order, starts))
            self.by_length[n] = (ids, prints, tables)

        self._rarest()

    def _rarest(self) -> None:
        """Per shingle size: the rarest shingles of the items, in order, with
        the items. What an item has besides weighs too little to be alike."""
        own: dict[int, tuple[list, list]] = {}
        for k, i in enumerate(self.items):
            i.weights = self.weights(i.shingles)
            i.total = math.fsum(i.weights)
            order = np.argsort(-i.weights, kind="stable")
            rest = i.total - np.cumsum(i.weights[order])
            first = order[: 1 + int((rest >= SIMILARITY * i.total * (1 - 1e-6)).sum())]
            grams, items = own.setdefault(min(SHINGLE, i.n_words), ([], []))
            grams.append(i.shingles[first])
            items.append(np.full(len(first), k))
        self.rarest: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for size, (grams, items) in own.items():
            g, k = np.concatenate(grams), np.concatenate(items)
            order = np.argsort(g, kind="stable")
            passes = np.zeros(1 << FILTER_BITS, bool)
            passes[(g >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
            self.rarest[size] = (g[order], k[order], passes)

    def near(self, n_words: int, prints: np.ndarray) -> list[tuple[int, int, int]]:
        """``(window, item, distance)`` of all fingerprints within RADIUS."""
        ids, own, tables = self.by_length[n_words]
        found: list[np.ndarray] = []
        for (shift, mask), (order, starts) in zip(self.blocks, tables):
            value = ((prints >> shift) & mask).astype(np.int64)
            count = starts[value + 1] - starts[value]
            window = np.repeat(np.arange(len(prints)), count)
            place = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(starts[value], count)
            found.append(window * len(ids) + order[place])
        pairs = np.unique(np.concatenate(found))
        window, item = pairs // len(ids), pairs % len(ids)
        apart = np.bitwise_count(prints[window] ^ own[item])
        near = apart <= RADIUS
        return list(zip(window[near].tolist(), ids[item[near]].tolist(), apart[near].tolist()))

    def weights(self, shingles: np.ndarray) -> np.ndarray:
        if not len(self.repeated):
            return np.full(len(shingles), self.alone)
        at = np.minimum(np.searchsorted(self.repeated, shingles), len(self.repeated) - 1)
        return np.where(self.repeated[at] == shingles, self.weight_repeated[at], self.alone)

    def similarity(self, window: np.ndarray, item: Item) -> float:
        own = np.isin(window, item.shingles, assume_unique=True)
        weights = self.weights(window)
        alike = math.fsum(weights[own]) / math.fsum([*weights[~own], *item.weights])
        return SIMILARITY if abs(alike - SIMILARITY) <= TIE else alike

    def sharing(self, grams: dict[int, np.ndarray], n_words: int) -> Iterator[tuple[int, np.ndarray]]:
        """By item: the starts of windows where its shingles weigh enough."""
        for size, (known, items, passes) in self.rarest.items():
            g = grams[size]
            maybe = np.flatnonzero(passes[(g >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
            low, high = np.searchsorted(known, g[maybe], "left"), np.searchsorted(known, g[maybe], "right")
            hit = np.repeat(maybe, high - low)
            if not len(hit):
                continue
            place = np.arange(len(hit)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + np.repeat(low, high - low)
            order = np.argsort(items[place], kind="stable")
            hit, owner = hit[order], items[place][order]
            edges = np.flatnonzero(np.diff(owner, prepend=-1, append=-1))
            for a, b in zip(edges[:-1], edges[1:]):
                item = self.items[owner[a]]
                n = min(item.n_words, n_words)
                wide = n - size + 1  # shingles of a window
                first = np.maximum(hit[a:b] - wide + 1, 0)
                last = np.minimum(hit[a:b], n_words - n)
                for group in np.split(np.arange(b - a), np.flatnonzero(first[1:] > last[:-1] + 1) + 1):
                    begin, end = int(first[group[0]]), int(last[group[-1]])
                    part = g[begin : end + wide]
                    at = np.minimum(np.searchsorted(item.shingles, part), len(item.shingles) - 1)
                    sums = np.concatenate(([0.0], np.cumsum(np.where(item.shingles[at] == part, item.weights[at], 0.0))))
                    enough = sums[wide:] - sums[: end - begin + 1] >= SIMILARITY * item.total * (1 - 1e-6)
                    if enough.any():
                        yield int(owner[a]), begin + np.flatnonzero(enough)

    def windows(self, grams: dict[int, np.ndarray], n_words: int) -> dict[int, np.ndarray]:
        """By item length: the starts of windows that share a shingle."""
        out: dict[int, list[np.ndarray]] = {}
        for size, (known, lengths, passes) in self.grams.items():
            g = grams[size]
            maybe = np.flatnonzero(passes[(g >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
            low, high = np.searchsorted(known, g[maybe], "left"), np.searchsorted(known, g[maybe], "right")
            hit = np.repeat(maybe, high - low)
            place = np.arange(len(hit)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + np.repeat(low, high - low)
            for n in np.unique(lengths[place]).tolist():
                at, room = hit[lengths[place] == n], n_words - n + 1
                if room <= 0:
                    continue
                # a shingle lies in the windows of a range of starts; their union by its edges
                edges = np.bincount(np.clip(at - (n - size), 0, room), minlength=room + 1) - np.bincount(np.minimum(at + 1, room), minlength=room + 1)
                starts = np.flatnonzero(np.cumsum(edges[:-1]))
                if len(starts):
                    out.setdefault(n, []).append(starts)
        return {n: np.unique(np.concatenate(x)) for n, x in out.items()}

    def matches(self, texts: list[bytes | None]) -> Iterator[list[tuple[int, int, int, int, float]]]:
        """``(item_id, start, n_words, distance, similarity)`` of each text."""
        for k in range(0, len(texts), TOGETHER):
            hashes, offsets = word_hashes(texts[k : k + TOGETHER], lower=True)
            for begin, end in zip(offsets[:-1], offsets[1:]):
                yield self._matches(hashes[begin:end]) if end > begin and self.items else []

    def _matches(self, h: np.ndarray) -> list[tuple[int, int, int, int, float]]:
        grams = {size: roll(h, size) for size in self.sizes}
        by_item: dict[int, set[int]] = {}
        for k, starts in self.sharing(grams, len(h)):
            by_item.setdefault(k, set()).update(starts.tolist())
        found = self.windows(grams, len(h))
        if not found and not by_item:
            return []
        sums = np.concatenate((np.zeros((1, 64), np.int32), np.cumsum(signs(h), axis=0, dtype=np.int32)))
        for n, starts in found.items():
            for w, k, _ in self.near(n, fingerprints(sums[starts + n] - sums[starts])):
                by_item.setdefault(k, set()).add(int(starts[w]))
        out = []
        for k, starts in by_item.items():
            item = self.items[k]
            n, size = min(item.n_words, len(h)), min(SHINGLE, item.n_words)
            hits = []
            for at in starts:
                alike = self.similarity(distinct(grams[size][at : at + n - size + 1]), item)
                if alike >= SIMILARITY:
                    hits.append((-alike, at))
            taken: list[int] = []
            for alike, at in sorted(hits):
                if all(abs(at - t) >= n for t in taken):
                    taken.append(at)
                    apart = int(np.bitwise_count(fingerprints((sums[at + n] - sums[at])[None, :])[0] ^ item.fingerprint))
                    out.append((item.item_id, at, n, apart, -alike))
        return sorted(out)


def item_blocks(benchmark: DataFrame, per_block: int) -> list:
    """The items as broadcast blocks ``[(item_id, text)]``, fetched one by one."""
    items = benchmark.where("text is not null and item_id is not null")
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / 2 / per_block))  # a shingle takes two bytes of text at least
    out = []
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).collect()
        out.append(benchmark.sparkSession.sparkContext.broadcast(sorted((r.item_id, bytes(r.text)) for r in own)))
    return out


def item_counts(benchmark: DataFrame) -> Broadcast:
    """``Counts`` of the whole benchmark, as a broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0).to_pylist():
                h, _ = word_hashes([text], lower=True)
                if len(h):  # the null counts the item
                    own = signed(distinct(roll(h, min(SHINGLE, len(h))))).tolist()
                    yield pa.RecordBatch.from_arrays([pa.array([None, *own], pa.int64())], names=["shingle"])

    texts = benchmark.where("text is not null and item_id is not null").select(F.col("text").cast("binary").alias("text"))
    counts = texts.mapInArrow(run, "shingle long").groupBy("shingle").count().where("shingle is null or count > 1").toArrow()
    shingles, share = counts.column("shingle").combine_chunks(), counts.column("count").to_numpy()
    none = shingles.is_null().to_numpy(zero_copy_only=False)
    own = shingles.drop_null().to_numpy().view(np.uint64)
    order = np.argsort(own)
    whole = (int(share[none].sum()), own[order], share[~none][order])
    return benchmark.sparkSession.sparkContext.broadcast(whole)


MATCHES = "doc_id long, item_id long, start int, n_words int, distance int, similarity double"


def find_leaks(docs: DataFrame, benchmark: DataFrame, per_block: int = ITEMS_PER_BLOCK) -> DataFrame:
    """Places of benchmark items in documents, one row for each."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    arrow = pa.schema(
        [("doc_id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int32()), ("n_words", pa.int32()), ("distance", pa.int32()), ("similarity", pa.float64())]
    )
    out = None
    counts = item_counts(benchmark)
    for shared in item_blocks(benchmark, per_block):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value, counts.value)
            for batch in batches:
                rows = [
                    (doc_id, *m)
                    for doc_id, found in zip(batch.column(0).to_pylist(), index.matches(batch.column(1).to_pylist()))
                    for m in found
                ]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), arrow)], schema=arrow)

        found = narrow.mapInArrow(run, MATCHES)
        out = found if out is None else out.unionAll(found)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, per_block: int = ITEMS_PER_BLOCK) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    at = docs.columns.index("text")
    counts = item_counts(benchmark)
    for shared in item_blocks(benchmark, per_block):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value, counts.value)
            for batch in batches:
                texts = [t and t.encode() for t in batch.column(at).to_pylist()]
                yield batch.filter(pa.array([not found for found in index.matches(texts)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark item go."""
    return without_leaks(docs.select(*DOCUMENT_COLUMNS), table(spark, sf_dir, "benchmark"))
