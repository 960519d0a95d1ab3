"""Substring dedup: words in passages that occur more than once go.

A passage is a window of ``WINDOW`` words. Equal windows are brought together
by their minimizer: the run of ``GRAM`` words in the window with the smallest
hash. Consecutive windows of one minimizer, ``REACH`` at most, make a segment,
so the segments of a text hold each of its windows exactly once, and two equal
windows lie in segments of the same minimizer. That routes the work:

1. Every text gives its anchors ``(minimizer, text, place)``. Anchors whose
   minimizer occurs once in the whole table cannot hold a repeated window and
   are dropped; one exchange, no group is held.
2. Texts with anchors left give their segments, equal ones once per task.
3. Segments are dealt by minimizer to shards. Each shard of bounded size gets
   a compressed FM-index, its segments are streamed against it by backward
   search over the wavelet matrix, and the windows with two or more matches are
   reported. A segment found in several places is repeated as it stands.
4. The word intervals go back to their texts, which are cut and digested.

A text that occurs more than once needs no search: all its windows repeat.
Minimizers with more than ``HOT`` anchors, or ``SURE`` in one task, are dealt
out by the first and the last word of each window, so a passage in a third of
all texts is spread over the shards together with its many contexts; nothing
is capped. Those that one task met so often aren't brought together at all in
step 1, as they are known to be shared.

Defined results: words are split at ASCII white space and compared as bytes;
null, empty, blank and short texts lose nothing; repeated rows and ids are
copies of a text; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table
from .fm_index import FMIndex
from .jaccard import by_ids
from .shingles import TOGETHER, roll, signed, word_hashes

WINDOW = 35
GRAM = 8
#: Grams of a window, and windows of a segment at most.
REACH = WINDOW - GRAM + 1
#: Anchors of one minimizer beyond which its windows are dealt out one by one.
HOT = 20_000
#: Anchors of one minimizer in one task beyond which it is known to be hot,
#: and the counters that tell, which minimizers share by their hash.
SURE, COUNTERS = 1_000, 1 << 20
#: Words of one shard's index.
SHARD_WORDS = 2_000_000
#: Words of a long text that are handled at a time.
CHUNK_WORDS = 1 << 19


def anchors_of(hashes: np.ndarray) -> list[tuple[int, int, int, bool]]:
    """``(minimizer, first window, windows, again)`` of each run of windows
    that share their minimizer, cut after ``REACH`` windows. A text that
    repeats a few words over and over is one run, not one for each time;
    ``again``: the minimizer stands in more than one place of the run."""
    out = []
    for base in range(0, max(1, len(hashes) - WINDOW + 1), CHUNK_WORDS):
        part = hashes[base : base + CHUNK_WORDS + WINDOW - 1]
        if len(part) < WINDOW:
            break
        grams = roll(part, GRAM)
        low = (grams & ~np.uint64((1 << 20) - 1)) | np.arange(len(grams), dtype=np.uint64)
        span = 1
        least = low
        while 2 * span <= REACH:  # smallest of 1, 2, 4 ... grams from each place
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < REACH:
            least = np.minimum(least[: len(low) - REACH + 1], least[REACH - span :])
        place = (least & np.uint64((1 << 20) - 1)).astype(np.int64)
        least = signed(grams[place])
        begin = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        count = np.diff(np.concatenate((begin, [len(least)])))
        pieces = -(-count // REACH)
        within = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = np.repeat(begin, pieces) + within * REACH
        size = np.minimum(REACH, np.repeat(begin + count, pieces) - start)
        again = place[start] != place[start + size - 1]
        out += list(zip(least[start].tolist(), (start + base).tolist(), size.tolist(), again.tolist()))
    return out


def _slices(batches: Iterator[pa.RecordBatch], rows: int = TOGETHER) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


SURVEY = "key long, n_words int, minimizer long, start int, n int, again boolean, sure boolean"


def survey(texts: DataFrame) -> DataFrame:
    """Of ``(key, text)``: a row with the number of words per text, and its
    anchors, once per task for equal texts."""
    arrow = pa.schema(
        [
            ("key", pa.int64()),
            ("n_words", pa.int32()),
            ("minimizer", pa.int64()),
            ("start", pa.int32()),
            ("n", pa.int32()),
            ("again", pa.bool_()),
            ("sure", pa.bool_()),
        ]
    )
    often = SURE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        counts = np.zeros(COUNTERS, np.int64)
        for batch in _slices(batches):
            keys, found = batch.column(0).to_pylist(), []
            hashes, offsets = word_hashes(batch.column(1).to_pylist())
            sizes = np.diff(offsets)
            for key, begin, end in zip(keys, offsets[:-1].tolist(), offsets[1:].tolist()):
                if end - begin >= WINDOW and key not in seen:
                    seen.add(key)
                    found += [(key, *a) for a in anchors_of(hashes[begin:end])]
            k = len(keys)
            none, no = pa.nulls(k, pa.int32()), pa.nulls(k, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int32()), pa.nulls(k, pa.int64()), none, none, no, no], schema=arrow)
            if found:
                a = np.array(found, np.int64)
                slot = a[:, 1] & (COUNTERS - 1)
                np.add.at(counts, slot, 1)
                columns = [pa.array(a[:, 0]), pa.nulls(len(a), pa.int32()), pa.array(a[:, 1])]
                columns += [pa.array(a[:, 2], pa.int32()), pa.array(a[:, 3], pa.int32())]
                columns += [pa.array(a[:, 4] > 0), pa.array(counts[slot] > often)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return texts.mapInArrow(run, SURVEY)


def shared_anchors(anchors: DataFrame, hot: int) -> DataFrame:
    """``(key, anchors)`` of texts with anchors whose minimizer stands in more
    than one place; ``many`` flags hot minimizers."""
    known = stored(anchors.where("sure").select("minimizer").distinct(), "substrings-hot")
    columns = ["key", "start", "n", "minimizer"]
    sure = by_ids(anchors, known, "left_semi", "minimizer").select(*columns).distinct().withColumn("many", F.lit(True))
    rest = by_ids(anchors, known, "left_anti", "minimizer")
    by = Window.partitionBy("minimizer").orderBy("key", "start")
    group = Window.partitionBy("minimizer")
    here = F.struct("key", "start")
    last, many = F.lag(here).over(by), F.count("*").over(group) > hot
    met = rest.withColumns({"last": last, "least": F.min(here).over(group), "most": F.max(here).over(group), "many": many})
    met = met.where((F.col("again") | (F.col("least") != F.col("most"))) & (F.col("last").isNull() | (F.col("last") != here)))
    every = met.select(*columns, "many").unionByName(sure)
    return every.groupBy("key").agg(F.collect_list(F.struct("start", "n", "minimizer", "many")).alias("anchors"))


SEGMENTS = "route long, segment long, words binary, times int, key long, start int"


def segments(texts: DataFrame) -> DataFrame:
    """Of ``(key, text, anchors)``: each segment's text with the times it was
    met, once per task, and one row for each place of a segment."""
    arrow = pa.schema(
        [("route", pa.int64()), ("segment", pa.int64()), ("words", pa.binary()), ("times", pa.int32()), ("key", pa.int64()), ("start", pa.int32())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times: dict[int, int] = {}
        routes: dict[int, int] = {}
        last = None
        for batch in _slices(batches):
            rows: list[tuple] = []
            for key, text, anchors in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if key == last:  # copies of a text lie together
                    continue
                last = key
                words = text.split()
                for a in anchors:
                    start, n = a["start"], a["n"]
                    if a["many"]:
                        pieces = [
                            (j, 1, xxhash.xxh3_64_intdigest(words[j] + b" " + words[j + WINDOW - 1], a["minimizer"] & 0xFFFFFFFF) - (1 << 63))
                            for j in range(start, start + n)
                        ]
                    else:
                        pieces = [(start, n, a["minimizer"])]
                    for at, count, route in pieces:
                        body = b" ".join(words[at : at + count + WINDOW - 1])
                        segment = xxhash.xxh3_64_intdigest(body) - (1 << 63)
                        new = segment not in times
                        times[segment] = times.get(segment, 0) + 1
                        if new:
                            routes[segment] = route
                        rows.append((route, segment, body if new else None, None, key, at))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), arrow)], schema=arrow)
        again = [(routes[s], s, None, n - 1, None, None) for s, n in times.items() if n > 1]
        if again:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*again), arrow)], schema=arrow)

    return texts.mapInArrow(run, SEGMENTS)


FOUND = "segment long, first int, last int"


def search_shards(routed: DataFrame, shard_words: int) -> DataFrame:
    """Repeated windows of each segment. A task builds one index after the
    other over whole routes, each of about ``shard_words`` words."""
    arrow = pa.schema([("segment", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])

    def search(texts: dict[int, bytes], times: dict[int, int]) -> pa.RecordBatch:
        ids = np.array(list(texts), np.int64)
        hashes, offsets = word_hashes(list(texts.values()))
        bodies = np.split(hashes, offsets[1:-1])
        windows = np.array([len(b) - WINDOW + 1 for b in bodies])
        first, last = np.zeros(len(ids), np.int64), windows - 1
        once = np.flatnonzero([times[s] < 2 for s in texts])
        if len(once):
            first[once], last[once] = FMIndex(bodies).covered(once, windows[once], WINDOW)
        hit = first >= 0
        return pa.RecordBatch.from_arrays([pa.array(ids[hit]), pa.array(first[hit], pa.int32()), pa.array(last[hit], pa.int32())], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: dict[int, bytes] = {}
        times: dict[int, int] = {}
        size, last = 0, None
        for batch in batches:
            for route, segment, words, n in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if size >= shard_words and route != last:
                    yield search(texts, times)
                    texts, times, size = {}, {}, 0
                last = route
                if words is not None:
                    if segment not in texts:
                        size += words.count(b" ") + 2
                        texts[segment] = words
                    n = 1
                times[segment] = times.get(segment, 0) + n
        if texts:
            yield search(texts, times)

    return routed.mapInArrow(run, FOUND)


def repeated_intervals(docs: DataFrame, hot: int = HOT, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame]:
    """``docs`` as ``(doc_id, key, text)`` and ``(key, cuts)``: the word
    intervals ``[start, end)`` of each text that repeated windows cover."""
    spark = docs.sparkSession
    keyed = docs.select("doc_id", F.xxhash64("text").alias("key"), F.col("text").cast("binary").alias("text"))
    texts = keyed.select("key", "text")
    surveyed = stored(survey(texts), "substrings-survey")
    anchors = surveyed.where("n is not null").select("key", "start", "n", "minimizer", "again", "sure")
    kept = stored(shared_anchors(anchors, hot), "substrings-anchors")
    met = by_ids(texts, kept.select("key"), "left_semi", "key").join(kept, "key")
    cut = stored(segments(met), "substrings-segments")
    bodies = cut.where("words is not null or key is null").select("route", "segment", "words", F.coalesce("times", F.lit(1)).alias("times"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), bodies.count() * 50 // (4 * shard_words))
    found = search_shards(bodies.repartition(parts, "route").sortWithinPartitions("route"), shard_words)
    places = cut.where("key is not null").select("key", "segment", "start").distinct()
    spans = places.join(found, "segment").select(
        "key", F.struct((F.col("start") + F.col("first")).alias("start"), (F.col("start") + F.col("last") + WINDOW).alias("end")).alias("cut")
    )
    copies = surveyed.where("n_words is not null").groupBy("key").agg(F.count("*").alias("c"), F.max("n_words").alias("n_words"))
    whole = copies.where(f"c > 1 and n_words >= {WINDOW}").select("key", F.struct(F.lit(0).alias("start"), F.col("n_words").alias("end")).alias("cut"))
    return keyed, spans.unionAll(whole).groupBy("key").agg(F.collect_list("cut").alias("cuts"))


RESULT = "doc_id long, n_words long, n_removed long, kept binary"


def remove_repeats(docs: DataFrame, hot: int = HOT, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Per document: ``doc_id``, ``n_words``, ``n_removed`` and ``kept``, the
    words that stay joined by one space (UTF-8)."""
    keyed, cuts = repeated_intervals(docs, hot, shard_words)
    cuts = stored(cuts, "substrings-cuts")
    keys = cuts.select("key")
    none = F.lit(None).cast(cuts.schema["cuts"].dataType).alias("cuts")
    touched = by_ids(keyed, keys, "left_semi", "key").join(cuts, "key")
    untouched = by_ids(keyed, keys, "left_anti", "key")
    both = touched.select("doc_id", "text", "cuts").unionAll(untouched.select("doc_id", "text", none))
    arrow = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows = []
            for text, cuts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = (text or b"").split()
                n = len(words)
                if cuts:
                    gone = np.zeros(n + 1, np.int64)
                    np.add.at(gone, [c["start"] for c in cuts], 1)
                    np.add.at(gone, [c["end"] for c in cuts], -1)
                    stays = np.cumsum(gone[:-1]) == 0
                    words = [w for w, s in zip(words, stays.tolist()) if s]
                rows.append((n, n - len(words), b" ".join(words)))
            columns = [pa.array(c, t.type) for c, t in zip(zip(*rows), list(arrow)[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema=arrow)

    return both.mapInArrow(run, RESULT)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


# windows by position over the words of each text, compared as whole texts
OP8_SQL = r"""
WITH w AS (
  SELECT rowid AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM (SELECT row_number() OVER () AS rowid, doc_id, text FROM documents)
), s AS (
  SELECT r, i, sha256(list_aggregate(ws[i:i + 34], 'string_agg', ' ')) AS h
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35)
), d AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY h) AS c FROM s) WHERE c > 1
), gone AS (
  SELECT r, list_sort(list_distinct(list(p))) AS ps FROM (SELECT DISTINCT r, unnest(range(i, i + 35)) AS p FROM d) GROUP BY r
), words AS (
  SELECT w.r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w
), stay AS (
  SELECT words.r, string_agg(word, ' ' ORDER BY words.p) AS kept
  FROM words ANTI JOIN (SELECT r, unnest(ps) AS p FROM gone) g USING (r, p) GROUP BY words.r
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN gone USING (r) LEFT JOIN stay USING (r)
"""
