import math
import random
import time

import numpy as np
import pytest

from souk.llm import decontaminate as D

from .brute import shingles, words
from .samples import ODD


def alike(text, item):
    """Best similarity of an item-sized window, items weighing alike."""
    w, n = words(text.lower()), len(words(item))
    want = shingles(item)
    best = 0.0
    for k in range(len(w) - n + 1):
        got = shingles(" ".join(w[k : k + n]))
        best = max(best, len(got & want) / len(got | want))
    return best


def test_query_against_all_windows(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id): r for r in D.op5_decontamination(spark, sf_dir).collect()}
    sets = {d: shingles(t) for d, t in docs.items()}
    want = {(d, i) for d, t in docs.items() for i, x in items.items() if sets[d] & shingles(x) and alike(t, x) >= 0.75}
    assert set(got) == want and want
    for (d, i), r in got.items():
        assert r.n_words == len(words(items[i])) and r.similarity >= 0.75 and r.distance <= D.RADIUS


ITEM = "Where did the old mill by the river stand before the flood of that winter took it and all of its wheels down to the sea?"


def test_copies_near_copies_and_clean_texts(spark, make_docs):
    w = ITEM.split()
    noise = "some other words that say nothing of it at all".split()
    changed = w[:12] + ["bridge"] + w[13:]
    edge = w[:-1] + ["lake?"]
    texts = {
        1: " ".join(noise + w + noise),
        2: ITEM.upper(),
        3: "\t\n".join(noise * 50 + w),
        4: " ".join(noise + edge + noise),
        5: " ".join(noise * 20),
        6: " ".join(w[: len(w) // 2]),
        7: " ".join(changed),
        8: " ".join([*w, *noise, *w]),
    }
    items = spark.createDataFrame([(1, ITEM), (2, ITEM), (3, None), (4, ""), (5, "far away question that nobody ever asked here")], "item_id long, text string")
    rows = D.find_leaks(make_docs([*texts.items(), *ODD]), items).collect()
    by = {}
    for r in rows:
        by.setdefault((r.doc_id, r.item_id), []).append(r)
    hit = {d for d in texts if alike(texts[d], ITEM.lower()) >= 0.75}
    assert {d for d, _ in by} == hit and {1, 2, 3, 4, 8} <= hit and not {5, 6} & hit
    assert all((d, 2) in by for d in hit)
    assert len(by[8, 1]) == 2 and by[1, 1][0].start == len(noise)


def test_short_items(spark, make_docs):
    items = spark.createDataFrame([(1, "yes"), (2, "one two three")], "item_id long, text string")
    rows = D.find_leaks(make_docs([(1, "well YES indeed"), (2, "zero one two three four"), (3, "one two"), *ODD]), items).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(1, 1), (2, 2)}


def test_blocks_of_items_give_the_same(spark, sf_dir):
    docs, items = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    whole = {(r.doc_id, r.item_id, r.start) for r in D.find_leaks(docs, items).collect()}
    parts = {(r.doc_id, r.item_id, r.start) for r in D.find_leaks(docs, items, per_block=1500).collect()}
    assert whole == parts


def test_blocks_of_bits_miss_nothing_within_the_radius():
    draw = random.Random(1)
    index = D.Index([(k, " ".join(f"w{draw.randint(0, 9999)}" for _ in range(30)).encode()) for k in range(50)])
    ids, own, _ = index.by_length[30]
    prints = []
    for _ in range(300):
        x = int(own[draw.randrange(len(own))])
        for bit in draw.sample(range(64), draw.randint(0, D.RADIUS + 4)):
            x ^= 1 << bit
        prints.append(x)
    prints = np.array(prints, np.uint64)
    apart = np.bitwise_count(prints[:, None] ^ own[None, :])
    want = {(i, int(ids[j]), int(apart[i, j])) for i, j in zip(*np.nonzero(apart <= D.RADIUS))}
    assert set(index.near(30, prints)) == want


def test_stage_and_empty_tables(spark, make_docs, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    leaking = {r.doc_id for r in D.op5_decontamination(spark, sf_dir).collect()}
    kept = [r.doc_id for r in D.stage(spark, docs, sf_dir).collect()]
    assert sorted(kept) == sorted(r.doc_id for r in docs.collect() if r.doc_id not in leaking)
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.find_leaks(make_docs(ODD), none).collect() == []
    assert D.without_leaks(make_docs(ODD), none).count() == len(ODD)
    assert D.find_leaks(make_docs(ODD).limit(0), none).collect() == []


def plain(text, items, k):
    """Best similarity of item ``k`` in a text, by weights over all items; a
    shorter text is its one window."""
    w, n, sets = words(text.lower()), len(words(items[k])), [shingles(x) for x in items]
    weight = lambda s: math.fsum(math.log1p(len(items) / max(1, sum(g in x for x in sets))) for g in s)
    windows = [shingles(" ".join(w[j : j + n])) for j in range(max(1, len(w) - n + 1))]
    return max((weight(x & sets[k]) / weight(x | sets[k]) for x in windows if x), default=0.0)


def found_in(spark, make_docs, texts, items, **kw):
    table = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in D.find_leaks(make_docs(list(enumerate(texts))), table, **kw).collect()}


def test_documents_shorter_than_the_item(spark, make_docs):
    w = ITEM.split()
    texts = [" ".join(x) for x in (w[1:], w[:-1], w[:-5], w[:-6], w[:2] + w[3:], w[:12] + w[13:], w[:4])]
    got = found_in(spark, make_docs, texts, [ITEM])
    assert {d for d, _ in got} == {d for d, t in enumerate(texts) if plain(t, [ITEM], 0) >= 0.75 - 1e-9}
    assert got[0, 0].n_words == len(w) - 1 and got[0, 0].start == 0 and {0, 1, 2, 4} == {d for d, _ in got}


def test_near_copies_beyond_the_radius(spark, make_docs):
    draw = random.Random(7)
    made = lambda n: [f"w{draw.randint(0, 999999)}" for _ in range(n)]
    items, texts = [], []
    for n, changed in [(11, 1), (18, 2), (25, 3), (39, 5), (60, 8), (200, 28)] * 12:
        item = made(n)
        items.append(" ".join(item))
        texts.append(" ".join(made(30) + item[:-changed] + made(changed + 30)))
    got = found_in(spark, make_docs, texts, items)
    assert set(got) == {(k, k) for k in range(len(items))}
    assert any(r.distance > D.RADIUS for r in got.values())
    assert all(r.similarity >= 0.75 for r in got.values())


def test_weights_come_from_all_items(spark, make_docs):
    head = "which of the following statements about the topic is the right one here".split()
    items = [" ".join(head + [f"a{k}x{j}" for j in range(5)]) for k in range(40)]
    texts = [" ".join(x.split()[:-1] + ["other"]) for x in items[:10]] + [" ".join(x.split()[1:] + ["more"]) for x in items[10:20]]
    whole = found_in(spark, make_docs, texts, items)
    parts = found_in(spark, make_docs, texts, items, per_block=400)
    size = sum(map(len, items))
    assert size / 2 / 400 > 3
    values = lambda got: {k: (r.start, r.similarity) for k, r in got.items()}
    assert values(whole) == values(parts)
    assert set(whole) == {(d, i) for d, t in enumerate(texts) for i in range(len(items)) if plain(t, items, i) >= 0.75 - 1e-9}


def test_ties_are_alike(spark, make_docs):
    for n in (17, 33, 38, 40):
        items = [" ".join(f"i{k}w{j}" for j in range(11)) for k in range(n)]
        texts = [" ".join(x.split()[:-1] + ["other"]) for x in items]
        got = found_in(spark, make_docs, texts, items)
        assert set(got) == {(k, k) for k in range(n)}
        assert all(r.similarity == 0.75 for r in got.values())


def test_long_items_take_room_in_proportion():
    """An item of 50,000 words and a text that holds it: the table of its
    windows grows with the text, not with the text times the item."""
    import tracemalloc

    draw = random.Random(21)
    words = ["".join(draw.choices("abcdefghij", k=6)) for _ in range(50_000)]
    index = D.Index([(1, " ".join(words).encode()), (2, " ".join(words[:7]).encode())])
    text = " ".join(["before", *words[:-40], "changed", *words[-39:], "after"]).encode()
    tracemalloc.start()
    begin = time.perf_counter()
    (found,) = index.matches([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {(i, start) for i, start, *_ in found} == {(1, 1), (2, 1)}
    assert peak < 200 << 20 and time.perf_counter() - begin < 60
