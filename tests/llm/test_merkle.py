import random

import pytest
from .samples import ODD

from .brute import merkle
from souk.llm import merkle as M

COLUMNS = "doc_id long, source string, lang string, n_chars long, text string"


def rows_of(spark, rows, tmp, **extra):
    df = spark.createDataFrame(rows, COLUMNS).selectExpr("*", "'x' as leaf", "1 as rank", "2 as tree", "'y' as root")
    df.write.mode("overwrite").parquet(f"{tmp}/documents.parquet")
    return sorted((tuple(r) for r in M.op13_merkle_manifest(spark, str(tmp)).collect()), key=repr)


def expected(rows):
    return sorted(merkle(rows), key=repr)


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()
    got = [tuple(r) for r in M.op13_merkle_manifest(spark, sf_dir).collect()]
    assert sorted(got) == sorted(merkle(map(tuple, docs)))
    assert {r[-1] for r in got} == {True, False}


def test_sizes_around_every_power(spark, tmp_path):
    """Trees of 1, 15, 16, 17, ... leaves, beyond a block, and many sources."""
    sizes = {"a": 1, "b": 2, "é": 15, "c": 16, None: 17, "Z": 255, "d": 256, "e": 257, "f": 4095, "g": 4096, "h": 4097, "": 9000}
    rows, at = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((at, source, "en" if at % 3 else None, at % 7, f"Text {at}"))
            at += 1
    random.Random(1).shuffle(rows)
    assert rows_of(spark, rows, tmp_path) == expected(rows)


def test_many_sources(spark, tmp_path):
    """More sources than a block of the tree over the subroots holds."""
    rows = [(i, f"s{i % 5000}", None, None, None) for i in range(6000)]
    assert rows_of(spark, rows, tmp_path) == expected(rows)


@pytest.mark.parametrize("rows", [[], [(5, None, None, None, None)], [(5, "s", "en", 3, "ABC")] * 40])
def test_few_rows(spark, tmp_path, rows):
    assert rows_of(spark, rows, tmp_path) == expected(rows)


def test_odd_rows_and_ties(spark, tmp_path):
    rows = [(i, "s", "en", None if t is None else len(t), t) for i, t in ODD] * 3
    rows += [(7, "s", "en", 1, f"Tie {k % 3}") for k in range(30)] + [(None, None, None, None, "Q")] * 20 + [(-4, "x", "", 0, "A" * 300_000)]
    assert rows_of(spark, rows, tmp_path) == expected(rows)


def test_rank_over_many_tasks(spark):
    """A source over many tasks, and many sources in one, are numbered alike."""
    rows = [("hot", i) for i in range(3000)] + [(None, i) for i in range(50)] + [(f"s{i % 40}", i) for i in range(400)] + [("hot", 7)] * 500
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "tree string, v long").repartition(5)
    got = M.ranked(df, ["v"], rows_per_task=40).collect()
    for tree in {t for t, _ in rows}:
        own = sorted((r["rank"], r["v"]) for r in got if r["tree"] == tree)
        assert [k for k, _ in own] == list(range(len(own)))
        assert [v for _, v in own] == sorted(v for t, v in rows if t == tree)


def test_no_join_but_the_bounded_one(spark, sf_dir):
    """Proofs are handed down without a join; what's left joins one offset a task."""
    plan = M.op13_merkle_manifest(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
