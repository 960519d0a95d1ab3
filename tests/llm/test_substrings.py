import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from souk.llm import substrings as S
from souk.llm.fm_index import FMIndex
from souk.llm.shingles import word_hashes

from .brute import without_repeats
from .samples import ODD


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(7)
    word = lambda: f"w{draw.randint(0, 3000)}"
    passage = [word() for _ in range(60)]
    short = [word() for _ in range(35)]
    out = [" ".join([word() for _ in range(draw.randint(0, 60))] + passage + [word() for _ in range(draw.randint(0, 60))]) for _ in range(40)]
    out += [" ".join([word()] + short[: draw.choice([34, 35])] + [word()]) for _ in range(10)]
    out += [" ".join(word() for _ in range(draw.randint(0, 120))) for _ in range(40)]
    out += [out[0], out[0], "de " * 40, "de la " * 40, "ab " * 36, "p q r " * 12 + "p q", "lone words " * 19, "x y z " * 11 + "x y", " ".join(f"u{i}" for i in range(35))]
    out.append("\t".join(passage[10:50]) + "\n\n" + " ".join(passage[:40]))
    out.append(" ".join(map(str, range(3000))) + " " + " ".join(map(str, range(100, 200))))
    return list(enumerate(out)) + ODD


def result(df, **kw):
    got = S.remove_repeats(df, **kw).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("k")).collect()
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.k) for r in got)


def expected(rows):
    return sorted((-1 if i is None else i, *x) for (i, _), x in zip(rows, without_repeats(rows)))


@pytest.mark.parametrize("kw", [{}, {"hot": 2, "shard_words": 500}])
def test_against_plain_version(make_docs, rows, kw):
    assert result(make_docs(rows).repartition(4), **kw) == expected(rows)


def test_minimizers_met_often_in_one_task(make_docs, rows, monkeypatch):
    monkeypatch.setattr(S, "SURE", 1)
    assert result(make_docs(rows).repartition(3)) == expected(rows)


def test_shuffled_joins_give_the_same(make_docs, rows, monkeypatch):
    from souk.llm import jaccard

    monkeypatch.setattr(jaccard, "BROADCAST_IDS", 0)
    assert result(make_docs(rows)) == expected(rows)


def test_long_texts_are_handled_in_parts(make_docs, rows, monkeypatch):
    monkeypatch.setattr(S, "CHUNK_WORDS", 50)
    hashes = word_hashes([b" ".join(b"%d" % i for i in range(1000))])[0]
    anchors = S.anchors_of(hashes)
    windows = [w for _, start, n, _ in anchors for w in range(start, start + n)]
    assert windows == list(range(1000 - S.WINDOW + 1))


def test_equal_windows_share_their_minimizer():
    draw = np.random.default_rng(1)
    words = draw.integers(0, 50, 400).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    words[200:260] = words[20:80]
    by = {}
    for m, start, n, _ in S.anchors_of(words):
        for w in range(start, start + n):
            by[w] = m
    assert all(by[20 + k] == by[200 + k] for k in range(60 - S.WINDOW + 1))


def test_repeated_words_make_few_anchors():
    hashes = word_hashes([b"x y " * 1000])[0]
    anchors = S.anchors_of(hashes)
    assert [w for _, start, n, _ in anchors for w in range(start, start + n)] == list(range(2000 - S.WINDOW + 1))
    assert len(anchors) <= 2000 // S.REACH + 2 and max(n for _, _, n, _ in anchors) == S.REACH


def test_fm_index_against_counting():
    from collections import Counter

    draw = np.random.default_rng(0)
    for _ in range(150):
        length = 5
        segments = [draw.integers(0, draw.integers(2, 5), draw.integers(length, length + 6)).astype(np.uint64) for _ in range(draw.integers(1, 12))]
        windows = np.array([len(s) - length + 1 for s in segments])
        seen = Counter(tuple(s[k : k + length]) for s, n in zip(segments, windows) for k in range(n))
        first, last = FMIndex(segments).covered(np.arange(len(segments)), windows, length)
        for s, a, b, n in zip(segments, first, last, windows):
            again = [k for k in range(n) if seen[tuple(s[k : k + length])] > 1]
            assert (a, b) == ((again[0], again[-1]) if again else (-1, -1))


def test_query_and_its_sql(spark, sf_dir):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in S.op8_substring_dedup(spark, sf_dir).collect())
    assert got == expected(texts)
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    assert sorted(con.sql(S.OP8_SQL).fetchall()) == got


def test_empty(make_docs):
    assert result(make_docs(ODD).limit(0)) == []
