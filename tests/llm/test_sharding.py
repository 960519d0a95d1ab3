import pytest
from .samples import ODD
from pyspark.sql import functions as F

from .brute import crc
from souk.llm import sharding as S


def check(rows, texts, shards=S.SHARDS):
    assert len(rows) == len(texts)
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    for shard, own in by.items():
        assert 0 <= shard < shards
        assert sorted(r.slot for r in own) == list(range(len(own)))
    return {k: sum(r.size for r in own) for k, own in by.items()}


def test_query(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = S.op10_sharding(spark, sf_dir).collect()
    total = check(rows, docs)
    for r in rows:
        assert r["size"] == len((docs[r.doc_id] or "").encode()) + 1
        assert r.text_crc32 == crc(docs[r.doc_id])
        assert r.law == "bytes" and r.grown_shard is None
    ideal, largest = sum(total.values()) / 16, max(r["size"] for r in rows)
    assert all(abs(b - ideal) <= largest + 2 * S.TOLERANCE * ideal for b in total.values())
    assert {(r.doc_id, r.shard, r.slot) for r in rows} == {(r.doc_id, r.shard, r.slot) for r in S.op10_sharding(spark, sf_dir).collect()}


def test_sizes_are_near_equal_with_a_hot_text(make_docs):
    texts = ["the same text over and over"] * 2000 + [f"text number {i} " + "x" * (i % 50) for i in range(4000)]
    df = S.shard_documents(make_docs(list(enumerate(texts))))
    total = check(df.collect(), texts)
    ideal = sum(total.values()) / 16
    assert all(abs(b - ideal) <= 0.02 * ideal for b in total.values())


def test_equal_texts_stay_together_unless_too_large(make_docs):
    texts = [f"text {i % 1500} " + "y" * 40 for i in range(6000)]
    rows = S.shard_documents(make_docs(list(enumerate(texts)))).collect()
    where = {}
    for r in rows:
        where.setdefault(texts[r.doc_id], set()).add(r.shard)
    assert sum(len(s) > 1 for s in where.values()) <= 15


def test_odd_rows(make_docs):
    rows = ODD + ODD + [(None, None)] * 3
    got = S.shard_documents(make_docs(rows)).collect()
    check(got, rows)
    assert {r["size"] for r in got if r.text is None} == {1}
    assert S.shard_documents(make_docs(ODD).limit(0)).collect() == []


def test_many_small_buckets(make_docs, monkeypatch):
    monkeypatch.setattr(S, "ROWS_PER_BUCKET", 7)
    texts = [f"t{i}" for i in range(3000)]
    check(S.shard_documents(make_docs(list(enumerate(texts)))).collect(), texts)


def test_write(make_docs, tmp_path, spark):
    df = S.shard_documents(make_docs([(i, f"t{i}") for i in range(500)], extra=False))
    S.write_shards(df, str(tmp_path / "out"), rows_per_file=20)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 500 and set(back.columns) == set(df.columns)


def test_plan_is_native(spark, sf_dir):
    plan = S.op10_sharding(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
