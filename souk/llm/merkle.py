"""Merkle manifest of a dataset: a nested-struct rollup over rank digits.

Every row is a leaf, the digest of its columns. Leaves of one source ascend by
id; every 16 consecutive nodes become the digest of their joined digests until
one is left, the source's subroot; subroots, ordered by source, give the root
in the same way.

1. Leaves are written once (digests and ids, no texts), sorted by range over
   ``(source, id, leaf)`` and numbered where they lie; of each task only the
   first source can have begun before, so one offset a task completes the rank.
2. The rank falls into a block and three digits of base 16. After one exchange
   by ``(source, block)`` the digits are grouped away one after the other; each
   grouping nests the structs of its children, so a block of 4,096 leaves is
   one row. The blocks of a source are the leaves of the next table, 4,096
   times smaller, and so on until each source has one row; the same again over
   the subroots.
3. Proofs go down the same tables: the row of a block meets the row of its
   path in one grouping (a union, not a join), and ``transform`` and
   ``explode`` hand each child its path with the siblings beside it. No row
   holds more than a block.

A group that isn't the first of its tree, or has two children or more, is
hashed; the first one with a single child is that child, as no other node is
left then. That rule is local, so no count of a tree is needed.

Defined results: ids sort with null first, equal ids by their leaf (equal rows
have equal leaves, so any order of theirs gives the same digests); a null
source is a source of its own; a null column is ``-``; a row without id isn't
tampered with; a lone leaf of a lone source is the root and its proof is the
digest of nothing; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import parts_for, stored, table

FANOUT_BITS = 4
FANOUT = 1 << FANOUT_BITS
#: Digits of the rank that one table groups away: a block has 16 ** 3 nodes.
DIGITS = 3
BLOCK = FANOUT**DIGITS
#: Leaves that a task sorts, nests or proves.
ROWS_PER_TASK = 1 << 20
HEX = 64

LEAF_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def framed(value: Column) -> Column:
    """A value with its length in UTF-8 bytes in front; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame, columns: list[str] = LEAF_COLUMNS, row_id: str = "doc_id", tree: str = "source", text: str = "text") -> DataFrame:
    """``(tree, row_id, leaf, tampered)``: ``tampered`` is the leaf of the row
    with the A-Z of its text lower-cased, for the rows chosen by the checksum
    of their id, else null."""
    upper = "".join(map(chr, range(65, 91)))
    changed = {text: F.translate(F.col(text), upper, upper.lower())}
    other = digest(*[framed(changed.get(c, F.col(c))) for c in columns])
    chosen = F.crc32(F.col(row_id).cast("string")) % 5 == 0
    return docs.select(
        F.col(tree).alias("tree"),
        F.col(row_id).alias("row_id"),
        digest(*[framed(F.col(c)) for c in columns]).alias("leaf"),
        F.when(chosen, other).alias("tampered"),
    )


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers sorted rows within each tree (the first column): the task, the
    place among the task's rows of the tree, and whether it is the task's first tree."""
    part, last, place, first = TaskContext.get().partitionId(), None, -1, True
    started = False
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        keys = pc.dictionary_encode(batch.column(0), null_encoding="encode")
        codes = keys.indices.to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.flatnonzero(np.diff(codes)) + 1])
        here = batch.column(0)[0].as_py()
        goes_on = started and here == last
        begun = np.zeros(n, np.int64)
        begun[starts] = starts
        places = np.arange(n) - np.maximum.accumulate(begun)
        end = starts[1] if len(starts) > 1 else n
        if goes_on:
            places[:end] += place + 1
        opening = np.zeros(n, bool)
        first = first and (goes_on or not started)
        opening[:end] = first
        first = first and len(starts) == 1
        started, last, place = True, batch.column(0)[n - 1].as_py(), int(places[-1])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(places), pa.array(opening)],
            names=[*batch.schema.names, "part", "place", "opening"],
        )


def ranked(rows: DataFrame, order: list[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``rows`` with ``rank``, from 0 in each ``tree`` in the given order.
    ``rows`` is read three times: give it written. No tree is held in one task,
    and equal rows can be dealt to several."""
    tied = rows.withColumn("_row", F.monotonically_increasing_id())
    by = ["tree", *order, "_row"]
    parts = parts_for(rows, rows.count(), rows_per_task)
    placed = tied.select("tree", *[c for c in rows.columns if c != "tree"], "_row").repartitionByRange(parts, *by).sortWithinPartitions(*by).drop("_row")
    added = [T.StructField("part", T.IntegerType()), T.StructField("place", T.LongType()), T.StructField("opening", T.BooleanType())]
    numbered = stored(placed.mapInArrow(_number, T.StructType([*placed.schema.fields, *added])), "merkle-ranked")
    counts = numbered.groupBy("part", "tree").agg(F.count("*").alias("n"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # only a task's first tree has rows in earlier tasks: at most one row a task
    offsets = counts.withColumn("offset", F.sum("n").over(before)).where("offset > 0").select("part", "offset")
    at = F.col("place") + F.when(F.col("opening"), F.coalesce("offset", F.lit(0))).otherwise(0)
    return numbered.join(F.broadcast(offsets), "part", "left").withColumn("rank", at).select(*rows.columns, "rank")


def _joined(kids: Column) -> Column:
    return F.array_join(F.transform(kids, lambda k: k["hash"]), "")


def nested(nodes: DataFrame, parts: int) -> DataFrame:
    """Blocks of ``(tree, rank, hash, data)``: rows ``(tree, rank, hash, kids)``,
    one a block, ``rank`` its number, with all nodes of the block nested.
    One exchange; each digit is grouped away within it."""
    rank = F.col("rank")
    digits = [F.shiftright(rank, FANOUT_BITS * k).bitwiseAND(FANOUT - 1).cast("int").alias(f"d{k}") for k in range(DIGITS)]
    level = (
        nodes.select("tree", F.shiftright(rank, FANOUT_BITS * DIGITS).alias("block"), *digits, "hash", "data")
        .repartition(parts, "tree", "block")
        .withColumn("kid", F.struct(F.col("d0").alias("digit"), "hash", "data"))
    )
    for k in range(1, DIGITS + 1):
        left = [f"d{j}" for j in range(DIGITS - 1, k - 1, -1)]
        level = level.groupBy("tree", "block", *left).agg(F.sort_array(F.collect_list("kid")).alias("kids"))
        first = F.col("block") == 0
        for d in left:
            first = first & (F.col(d) == 0)
        alone = first & (F.size("kids") == 1)
        node = F.when(alone, F.col("kids")[0]["hash"]).otherwise(digest(_joined(F.col("kids"))))
        if left:
            level = level.select("tree", "block", *left, node.alias("hash"), "kids")
            level = level.withColumn("kid", F.struct(F.col(left[-1]).alias("digit"), "hash", "kids"))
        else:
            level = level.select("tree", F.col("block").alias("rank"), node.alias("hash"), "kids")
    return level


def tables(nodes: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> list[DataFrame]:
    """The block tables over ``nodes``, each over the blocks of the one
    before, up to one block a tree."""
    out, rows = [], nodes.count()
    while True:
        out.append(stored(nested(nodes, parts_for(nodes, rows, rows_per_task)), "merkle-blocks"))
        if out[-1].where("rank > 0").isEmpty():
            return out
        rows = out[-1].count()
        nodes = out[-1].select("tree", "rank", "hash", F.lit(None).cast("int").alias("data"))


PATH = "array<struct<before: string, after: string>>"


def handed_down(blocks: DataFrame, above: DataFrame, parts: int) -> DataFrame:
    """One row per node of the blocks: ``(tree, rank, hash, data, path, top)``.
    ``above`` has ``(tree, rank, path, top)`` of each block; its ``path`` holds,
    from the node upwards, the digests before and after it in its group."""
    top = above.schema["top"].dataType
    kids = blocks.schema["kids"].dataType
    own = blocks.select("tree", "rank", "kids", F.lit(None).cast(PATH).alias("path"), F.lit(None).cast(top).alias("top"))
    met = own.unionAll(above.select("tree", "rank", F.lit(None).cast(kids).alias("kids"), F.col("path").cast(PATH).alias("path"), "top"))
    once = [F.first(c, ignorenulls=True).alias(c) for c in ("kids", "path", "top")]
    level = met.repartition(parts, "tree", "rank").groupBy("tree", "rank").agg(*once)
    for k in range(DIGITS):
        alone = (F.col("rank") == 0) & (F.size("kids") == 1)
        opened = level.select("tree", "rank", "path", "top", alone.alias("alone"), _joined(F.col("kids")).alias("all"), F.posexplode("kids").alias("at", "kid"))
        before = F.substr(F.col("all"), F.lit(1), F.col("at") * HEX)
        after = F.substr(F.col("all"), (F.col("at") + 1) * HEX + 1)
        beside = F.array(F.struct(before.alias("before"), after.alias("after")))
        path = F.when(F.col("alone"), F.col("path")).otherwise(F.concat(beside, F.col("path")))
        inner = ["kid.kids"] if k + 1 < DIGITS else ["kid.hash", "kid.data"]
        level = opened.select("tree", (F.col("rank") * FANOUT + F.col("at")).alias("rank"), *inner, path.alias("path"), "top")
    return level


def proofs(levels: list[DataFrame], above: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Paths of the nodes below the first of ``levels``, from those above the last."""
    for blocks in reversed(levels):
        parts = parts_for(blocks, blocks.count() * BLOCK, rows_per_task)
        below = handed_down(blocks, above, parts)
        above = below.select("tree", "rank", "path", "top")
    return below


def manifest(docs: DataFrame, columns: list[str] = LEAF_COLUMNS, row_id: str = "doc_id", tree: str = "source", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``row_id``, ``leaf``, ``tampered``, ``subroot``,
    ``root`` and ``path``, the siblings from the leaf up to the root."""
    own = stored(leaves(docs, columns, row_id, tree, text), "merkle-leaves")
    data = F.struct("row_id", "tampered").alias("data")
    forest = tables(ranked(own, ["row_id", "leaf"]).select("tree", "rank", F.col("leaf").alias("hash"), data))
    subroots = stored(forest[-1].select(F.lit(0).alias("tree"), F.col("hash"), F.col("tree").alias("name")), "merkle-subroots")
    crown = tables(ranked(subroots, ["name"]).select("tree", "rank", "hash", F.struct("name").alias("data")))
    empty = F.array().cast(PATH).alias("path")
    named = proofs(crown, crown[-1].select("tree", "rank", empty, F.struct(F.col("hash").alias("root")).alias("top")))
    tops = F.struct(F.col("hash").alias("subroot"), F.col("top.root").alias("root")).alias("top")
    above = named.select(F.col("data.name").alias("tree"), F.lit(0).cast("long").alias("rank"), "path", tops)
    return proofs(forest, above).select(
        F.col("data.row_id").alias("row_id"), F.col("hash").alias("leaf"), "data.tampered", "top.subroot", "top.root", "path"
    )


def folded(start: Column, path: str | Column = "path") -> Column:
    """The root that a leaf leads to along a path."""
    return F.aggregate(path, start, lambda node, at: digest(at["before"], node, at["after"]))


def proof_digest(path: str | Column = "path") -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda at: F.concat(at["before"], at["after"])), ""), 256)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    proven = manifest(table(spark, sf_dir, "documents")).withColumn("folded_root", folded(F.coalesce("tampered", "leaf")))
    return proven.select(
        F.col("row_id").cast("long").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        proof_digest().alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


OP13_SQL = """
WITH RECURSIVE own AS (
    SELECT *, doc_id::VARCHAR AS d, row_number() OVER () AS nr, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree
    FROM documents
), framed AS (
    SELECT nr, tree, doc_id, text,
        coalesce(strlen(d) || ':' || d, '-') || coalesce(strlen(source) || ':' || source, '-')
        || coalesce(strlen(lang) || ':' || lang, '-')
        || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') AS head,
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
        xor(list_reduce(
            list_prepend(4294967295::BIGINT, list_transform(range(1, strlen(d) + 1), lambda i: ord(substr(d, i::INTEGER, 1))::BIGINT)),
            lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384))
        ), 4294967295) AS crc
    FROM own
), leaves AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
    FROM (
        SELECT nr, tree, doc_id,
            sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
            CASE WHEN crc % 5 = 0 THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) END AS tampered
        FROM framed
    )
), nodes AS (
    SELECT tree, 0 AS lvl, pos, leaf AS hash FROM leaves
    UNION ALL
    SELECT tree, lvl + 1, pos // 16, sha256(string_agg(hash, '' ORDER BY pos))
    FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS c FROM nodes)
    WHERE c > 1
    GROUP BY tree, lvl, pos // 16
), tops AS (
    SELECT tree, max(lvl) AS height, max_by(hash, lvl) AS subroot FROM nodes GROUP BY tree
), crown AS (
    SELECT 0 AS lvl, tree AS pos, subroot AS hash FROM tops
    UNION ALL
    SELECT lvl + 1, pos // 16, sha256(string_agg(hash, '' ORDER BY pos))
    FROM (SELECT *, count(*) OVER () AS c FROM crown)
    WHERE c > 1
    GROUP BY lvl, pos // 16
), every AS (
    SELECT tree, lvl, pos, hash FROM nodes
    UNION ALL
    SELECT -1, lvl, pos, hash FROM crown
), beside AS (
    SELECT tree, lvl, pos,
        coalesce(string_agg(hash, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
        coalesce(string_agg(hash, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
    FROM (SELECT *, max(lvl) OVER (PARTITION BY tree) AS height FROM every)
    WHERE lvl < height
    WINDOW w AS (PARTITION BY tree, lvl, pos // 16 ORDER BY pos)
), folds AS (
    SELECT nr, tree, 0 AS lvl, pos, coalesce(tampered, leaf) AS node, '' AS proof FROM leaves
    UNION ALL
    SELECT nr, f.tree, f.lvl + 1, f.pos // 16, sha256(before || node || after), proof || before || after
    FROM folds f JOIN beside USING (tree, lvl, pos)
), risen AS (
    SELECT nr, 0 AS lvl, f.tree AS pos, node, proof FROM folds f JOIN tops t ON f.tree = t.tree AND f.lvl = t.height
    UNION ALL
    SELECT nr, r.lvl + 1, r.pos // 16, sha256(before || node || after), proof || before || after
    FROM risen r JOIN beside b ON b.tree = -1 AND b.lvl = r.lvl AND b.pos = r.pos
), root AS (
    SELECT max_by(hash, lvl) AS root, max(lvl) AS height FROM crown
)
SELECT l.doc_id, l.leaf, t.subroot, root.root, sha256(r.proof) AS proof_sha256, r.node AS folded_root, r.node = root.root AS verified
FROM leaves l JOIN tops t USING (tree) CROSS JOIN root JOIN risen r ON r.nr = l.nr AND r.lvl = root.height
"""
