"""N-gram Jaccard join by rare-first prefix filtering.

Two documents link when 100 * |common shingles| >= 75 * |all shingles|. The
shingles of a document are put in one global order, rare ones first. Two sets
of that similarity share a shingle among the first ``n - ceil(0.75 n) + 1`` of
each, whatever the order; so only these prefixes are joined. The order comes
from counts of all shingles of all documents in a table of fixed size (it is a
hashed count, so its size doesn't grow and it can be broadcast); being rare
makes the join cheap, and being an order makes it exact.

Steps, each a Spark job over the whole table:

1. Every document gets its set's size and signature; equal sets are one node
   from here on, however many copies there are.
2. Prefix entries ``(shingle, node, size, place)`` meet on the shingle. A
   shingle with one node is dropped. Hot shingles are salted.
3. Pairs: first all nodes of a shingle are paired with one pivot node, which
   costs as many pairs as rows, and what is verified is merged; then, of
   shingles with three nodes or more, all pairs that still lie in different
   components are tried. Pairs inside a component needn't be tried, so a large
   group of copies never expands into all its pairs, and no link between
   components is lost.
4. Length and positional filters prune a pair when it is made. The suffix
   filter bounds from below how many shingles are in one set only: each node
   has the parities of its members in 1024 ranges of hashes, and wherever two
   nodes' parities differ there is such a shingle. What is left is verified
   once per pair, by the exact size of the intersection; the sets are made
   again from the texts of just these nodes.

Defined results: words are split at ASCII white space and A-Z lower-cased;
fewer than five words are one shingle; null, empty or blank texts have no
shingle and are linked with nothing; repeated ids and rows are copies; a null
id takes part but names no component; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import DOCUMENT_COLUMNS, stored, table
from .components import components
from .shingles import TOGETHER, shingle_sets, signed

PERCENT = 75
#: Counters of the shingle counts; 4 bytes each are broadcast.
COUNTERS = 1 << 19
#: A shingle whose counter is beyond this is dealt out over SALTS groups.
HOT, SALTS = 200_000, 64
#: Ranges of hashes whose parities are kept of each set.
PARITIES = 1024
#: Rows of ids up to which a set of them is broadcast: at most four numbers a
#: row, so 32 MB.
BROADCAST_IDS = 1_000_000


def _shift() -> np.uint64:
    return np.uint64(64 - (COUNTERS - 1).bit_length())


def signature(shingles: np.ndarray) -> int:
    """Names a set by all its members."""
    a = np.sum(shingles, dtype=np.uint64, keepdims=True)
    b = np.sum(shingles * (shingles >> np.uint64(32)), dtype=np.uint64, keepdims=True)
    both = (a ^ (b >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + b + np.uint64(len(shingles))
    return int(signed(both ^ (both >> np.uint64(29)))[0])


def parities(shingles: np.ndarray) -> np.ndarray:
    """Whether each range of hashes holds an odd number of members, packed."""
    odd = np.bincount((shingles & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _slices(batches: Iterator[pa.RecordBatch], rows: int = TOGETHER) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


SURVEY = "doc_id long, text_key long, node long, n int, odd array<long>, chunk int, counts array<int>"
CHUNK = 1 << 12


def survey(docs: DataFrame) -> DataFrame:
    """One row per document (node null without shingles) and, once per task,
    its share of the shingle counts in chunks."""
    arrow = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("text_key", pa.int64()),
            ("node", pa.int64()),
            ("n", pa.int32()),
            ("odd", pa.list_(pa.int64())),
            ("chunk", pa.int32()),
            ("counts", pa.list_(pa.int32())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            nodes, sizes, odd = [], [], []
            for part in _slices(iter([batch])):
                for s in shingle_sets(part.column(1).to_pylist()):
                    nodes.append(signature(s) if len(s) else None)
                    sizes.append(len(s))
                    odd.append(parities(s))
                    np.add.at(counts, (s >> _shift()).astype(np.int64), 1)
            k = batch.num_rows
            if k:
                lists = pa.ListArray.from_arrays(np.arange(k + 1, dtype=np.int32) * (PARITIES // 64), pa.array(np.concatenate(odd)))
                columns = [batch.column(0), batch.column(2), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()), lists]
                yield pa.RecordBatch.from_arrays([*columns, pa.nulls(k, pa.int32()), pa.nulls(k, arrow.field("counts").type)], schema=arrow)
        rows = [
            {"chunk": c, "counts": counts[c * CHUNK : (c + 1) * CHUNK].tolist()}
            for c in range(-(-COUNTERS // CHUNK))
            if counts[c * CHUNK : (c + 1) * CHUNK].any()
        ]
        yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return docs.mapInArrow(run, SURVEY)


def shingle_counts(surveyed: DataFrame) -> np.ndarray:
    """The counters summed over all tasks: at most COUNTERS rows are fetched,
    as Arrow columns of 12 bytes a row."""
    one = surveyed.where("chunk is not null").select("chunk", F.posexplode("counts").alias("k", "c")).where("c > 0")
    total = one.groupBy((F.col("chunk") * CHUNK + F.col("k")).alias("slot")).agg(F.sum("c").alias("c"))
    rows = total.toArrow()
    out = np.zeros(COUNTERS, np.int64)
    out[rows.column("slot").to_numpy()] = rows.column("c").to_numpy()
    return np.minimum(out, np.iinfo(np.int32).max).astype(np.int32)


ENTRY = "key long, node long, packed long"


def prefix_entries(docs: DataFrame, shared: Broadcast) -> DataFrame:
    """The rare-first prefix of each document's set, by the broadcast counts.
    ``packed`` holds size and place; it is negative for a hot shingle. A task
    gives equal sets once."""
    arrow = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("packed", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, seen = shared.value, set()
        for batch in _slices(batches):
            keys, nodes, packed = [], [], []
            for s in shingle_sets(batch.column(1).to_pylist()):
                n = len(s)
                if not n:
                    continue
                node = signature(s)
                if node in seen:
                    continue
                seen.add(node)
                often = common[(s >> _shift()).astype(np.int64)]
                first = np.lexsort((s, often))[: n - (PERCENT * n + 99) // 100 + 1]
                size_and_place = (np.int64(n) << 32) + np.arange(len(first)) + 1
                keys.append(signed(s[first]))
                nodes.append(np.full(len(first), node, np.int64))
                packed.append(np.where(often[first] > HOT, -size_and_place, size_and_place))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, nodes, packed)], schema=arrow)

    return docs.mapInArrow(run, ENTRY)


def shared_entries(entries: DataFrame) -> DataFrame:
    """Entries whose shingle has another entry of a fitting size: in order of
    size, the neighbour on one side must be near enough. One exchange and a
    sort. Of a hot shingle all entries stay.

    Each entry gets the shingle's ``pivot``, the one with the fewest rarer
    shingles, as the text that others were made from has none of its own, and
    ``more``, whether there are pairs without the pivot."""
    size = F.abs("packed")
    own = entries.select(
        "key",
        "node",
        F.shiftright(size, 32).cast("int").alias("n"),
        size.bitwiseAND((1 << 32) - 1).cast("int").alias("place"),
        (F.col("packed") < 0).alias("hot"),
    )
    salt = F.when(F.col("hot"), F.pmod("node", F.lit(SALTS))).otherwise(0)
    group = Window.partitionBy("key", salt)
    by = group.orderBy("n", "node")
    below = 100 * F.lag("n").over(by) >= PERCENT * F.col("n")
    above = 100 * F.col("n") >= PERCENT * F.lead("n").over(by)
    met = own.withColumns(
        {
            "fits": F.coalesce(below, F.lit(False)) | F.coalesce(above, F.lit(False)),
            # of plain columns, as anything made for a window is moved with the rows; ties fall alike
            "pivot": F.struct(
                F.min_by("node", "place").over(group).alias("node"),
                F.min_by("n", "place").over(group).alias("n"),
                F.min("place").over(group).alias("place"),
            ),
            "more": F.col("hot") | (F.count("*").over(group) > 2),
        }
    )
    return met.where("hot or fits").select("key", "node", "n", "place", "pivot", "more")


def may_link(a: str, b: str, first: bool) -> Column:
    """Length and positional filter of two entries of one shingle. ``first``:
    it is taken as the first common one, as for each pair one is, so nothing
    common stands before it; else anything may."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    pa_, pb = F.col(f"{a}.place"), F.col(f"{b}.place")  # from 1
    common = (F.lit(1) if first else F.least(pa_, pb)) + F.least(na - pa_, nb - pb)
    total = na.cast("long") + nb
    return (100 * F.least(na, nb).cast("long") >= PERCENT * F.greatest(na, nb)) & ((100 + PERCENT) * common.cast("long") >= PERCENT * total)


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(F.col(a), F.col(b)).alias("a"), F.greatest(F.col(a), F.col(b)).alias("b")]


def with_labels(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """Entries with the component of their node; shingles whose entries all
    lie in one component are done and dropped."""
    labelled = entries.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    open_ = labelled.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("key")
    return labelled.join(open_, "key", "left_semi")


def pivot_pairs(entries: DataFrame) -> DataFrame:
    """Each entry with the pivot of its shingle."""
    met = entries.select(F.struct("node", "n", "place").alias("x"), F.col("pivot").alias("y"))
    return met.where((F.col("x.node") != F.col("y.node")) & may_link("x", "y", False)).select(*_pair("x.node", "y.node"))


def all_pairs(entries: DataFrame) -> DataFrame:
    """All pairs of nodes that share a shingle and lie in different
    components. At the first common shingle the smaller set (or an equal one)
    has it in the shorter prefix that any set at least as large must meet."""
    short = F.col("place") <= F.col("n") - F.ceil(F.col("n") * (2 * PERCENT) / (100 + PERCENT)) + 1
    smaller = entries.where(short)
    both = entries.alias("x").join(
        smaller.alias("y"),
        (F.col("x.key") == F.col("y.key")) & (F.col("x.n") >= F.col("y.n")) & (F.col("x.label") != F.col("y.label")) & may_link("x", "y", True),
    )
    return both.select(*_pair("x.node", "y.node"))


def suffix_filtered(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs whose parities don't rule them out: to link, at most 25/175 of
    both sizes together may be in one set only."""
    met = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    known = by_ids(nodes, stored(met, "jaccard-met"), "left_semi", "node")
    x, y = (known.select(F.col("node").alias(k), F.col("n").alias(f"n{k}"), F.col("odd").alias(f"o{k}")) for k in "ab")
    apart = sum((F.bit_count(F.get("oa", F.lit(k)).bitwiseXOR(F.get("ob", F.lit(k)))) for k in range(PARITIES // 64)), F.lit(0))
    total = F.col("na").cast("long") + F.col("nb")
    near = pairs.join(x, "a").join(y, "b").where((100 + PERCENT) * apart <= (100 - PERCENT) * total)
    return near.select("a", "b")


def oriented(pairs: DataFrame) -> DataFrame:
    """Pairs as ``(hub, node)``: the hub is in more pairs. The node's set is
    sent to the hub's, so a hub's set is not sent around."""
    ends = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("node"))
    degree = ends.groupBy("node").agg(F.count("*").alias("d"))
    x, y = (degree.select(F.col("node").alias(k), F.col("d").alias(f"d{k}")) for k in "ab")
    first = F.col("da") >= F.col("db")
    hub, node = F.when(first, F.col("a")).otherwise(F.col("b")), F.when(first, F.col("b")).otherwise(F.col("a"))
    return pairs.join(x, "a").join(y, "b").select(hub.alias("hub"), node.alias("node"))


def verified(sent: DataFrame, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs ``(hub, node)`` that link, by the exact size of the
    intersection. Sets are made from the texts where these are read, and each
    pair moves one set."""
    one = nodes.select("node", F.col("doc_id").alias("_doc_id"), F.col("text_key").alias("_text_key"))
    hubs = one.join(sent.select(F.col("hub").alias("node")).distinct(), "node", "left_semi").withColumn("hubs", F.array("node"))
    each = one.join(sent.groupBy("node").agg(F.collect_list("hub").alias("hubs")), "node")
    few = sent.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS

    def sets(wanted: DataFrame, name: str) -> DataFrame:
        wanted = stored(wanted.drop("node"), f"jaccard-{name}")
        same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_key") == F.col("_text_key"))
        met = docs.join(F.broadcast(wanted) if few else wanted, same)
        return sets_of(met.select("text", "hubs"))

    own = sets(hubs, "hubs").select("hub", F.col("shingles").alias("x"))
    met = sets(each, "sent").withColumnRenamed("shingles", "y").join(own, "hub")
    common = F.size(F.array_intersect("x", "y")).cast("long")
    either = F.size("x").cast("long") + F.size("y") - common
    return met.where(100 * common >= PERCENT * either).select(F.col("hub").alias("a"), F.col("node").alias("b"))


def by_ids(docs: DataFrame, ids: DataFrame, how: str, *keys: str) -> DataFrame:
    """Semi or anti join with a set of ids, where null equals null: broadcast
    if its counted size allows, else shuffled."""
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    ids = ids.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return docs.join(F.broadcast(ids) if few else ids, same, how)


SETS = "hub long, node long, shingles array<long>"


def sets_of(texts: DataFrame) -> DataFrame:
    """Of ``(text, hubs)``: the text's set, once for each of the hubs."""
    arrow = pa.schema([("hub", pa.int64()), ("node", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            sets = shingle_sets(batch.column(0).to_pylist())
            for s, hubs in zip(sets, batch.column(1).to_pylist()):
                node, shingles = signature(s), signed(s)
                for k in range(0, len(hubs), TOGETHER):
                    to = hubs[k : k + TOGETHER]
                    lists = pa.array([shingles] * len(to), pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([pa.array(to, pa.int64()), pa.array([node] * len(to), pa.int64()), lists], schema=arrow)

    return texts.mapInArrow(run, SETS)


def classes(docs: DataFrame, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its id, ``text_key`` (hash of the text), ``n`` shingles,
    ``label`` (names the component; null without shingles) and
    ``component_id``, the smallest id that links reach."""
    narrow = docs.select(F.col(row_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"), F.xxhash64(text).alias("text_key"))
    surveyed = stored(survey(narrow), "jaccard-survey")
    rows = surveyed.where("chunk is null").select("doc_id", "text_key", "node", "n")
    # one document stands for each node
    one = F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "text_key"))
    nodes = stored(
        surveyed.where("node is not null").groupBy("node").agg(one.alias("d"), F.min("n").alias("n"), F.min("odd").alias("odd")).select("node", "n", "odd", "d.doc_id", "d.text_key"),
        "jaccard-nodes",
    )
    stands = nodes.select("node", F.col("doc_id").alias("d"), F.col("text_key").alias("t"))
    other = ~(F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t")))
    copies = stored(rows.join(stands, "node").where(other).select("doc_id", "text_key").distinct(), "jaccard-copies")
    firsts = by_ids(narrow, copies, "left_anti", "doc_id", "text_key")
    counts = docs.sparkSession.sparkContext.broadcast(shingle_counts(surveyed))
    entries = stored(shared_entries(prefix_entries(firsts, counts)), "jaccard-entries")
    counts.destroy()  # what needed it is written

    def linked(pairs: DataFrame) -> DataFrame:
        near = stored(suffix_filtered(pairs, nodes), "jaccard-near")
        links = near if near.isEmpty() else verified(stored(oriented(near), "jaccard-sent"), narrow, nodes)
        return stored(links.distinct(), "jaccard-links")

    first = stored(pivot_pairs(entries).distinct(), "jaccard-pairs")
    links = linked(first)
    labels = components(links)
    open_ = stored(with_labels(entries.where("more").drop("pivot", "more"), labels), "jaccard-open")
    rest = stored(all_pairs(open_).distinct().join(first, ["a", "b"], "left_anti"), "jaccard-pairs")
    if not rest.isEmpty():
        # what is known goes on as links from each node to its component's label
        known = labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
        labels = components(linked(rest).unionAll(known))
    # copies count through their node; the smallest id of each component
    least = rows.groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    joined = least.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = joined.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    named = joined.join(smallest, "label").select("node", "label", "component_id")
    alone = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.join(named, "node", "left").select("doc_id", "text_key", "n", "label", alone.alias("component_id"))


def near_duplicates(docs: DataFrame, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    found = classes(docs, row_id, text)
    return found.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component one document stays, that of the
    smallest id (of its texts, where an id is repeated, the one of the smallest
    hash; of equal rows, one). Documents without a shingle stay."""
    found = stored(classes(docs).where("n > 0"), "jaccard-classes")
    order = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "text_key")
    kept = found.groupBy("label").agg(F.min(order).alias("k"))
    kept = kept.select("label", F.col("k.doc_id").alias("kept_id"), F.col("k.text_key").alias("kept_key"))
    goes = ~(F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("text_key") == F.col("kept_key")))
    gone = found.join(kept, "label").where(goes).select("doc_id", "text_key").distinct()
    keyed = docs.withColumn("text_key", F.xxhash64("text"))
    left = by_ids(keyed, stored(gone, "jaccard-gone"), "left_anti", "doc_id", "text_key")
    twice = stored(found.groupBy("doc_id", "text_key").count().where("count > 1").select("doc_id", "text_key"), "jaccard-twice")
    if not twice.isEmpty():
        one = by_ids(left, twice, "left_semi", "doc_id", "text_key").dropDuplicates(["doc_id", "text_key"])
        left = by_ids(left, twice, "left_anti", "doc_id", "text_key").unionByName(one)
    return left.select(*DOCUMENT_COLUMNS)
