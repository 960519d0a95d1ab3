import random

import pytest
from .samples import ODD

from . import brute
from souk.llm import repeats as R


def drawn(seed):
    d = random.Random(seed)
    n, letters = d.randint(0, 110), d.choice([1, 2, 2, 3, 5])
    w = [d.randrange(letters) for _ in range(n)]
    for _ in range(d.randint(0, 3)):
        if n > 10:
            a, p = d.randrange(n - 5), d.randint(1, 12)
            for i in range(a, min(n, a + d.randint(1, 60))):
                w[i] = w[a + (i - a) % p]
    return d, w


@pytest.mark.parametrize("seed", range(8))
def test_runs_and_any_appends(seed):
    """Equal to all maximal stretches, however the words are appended."""
    for k in range(150):
        d, w = drawn(1000 * seed + k)
        want = brute.runs(w)
        assert R.runs_of(w) == want, w
        catcher, words, at = R.SquareCatcher(), R.numbered(w), 0
        while at < len(w):
            step = d.choice([1, 1, 2, 3, 7, 20])
            catcher.append(words[at : at + step])
            at += step
            if d.random() < 0.05:
                assert catcher.runs() == brute.runs(w[:at])
        assert catcher.runs() == want, w


def test_exhaustive_short_words():
    for n in range(13):
        for bits in range(1 << n):
            w = [bits >> k & 1 for k in range(n)]
            assert R.runs_of(w) == brute.runs(w)


def test_edges_of_the_definition():
    assert R.runs_of("aaaaa") == [] and R.runs_of("aaaaaa") == [(0, 6, 1)]
    assert R.runs_of("abababa") == [] and R.runs_of("abababab") == [(0, 8, 2)]
    assert R.runs_of("aaaabaaaabaaaabaaaab") == [(0, 20, 5)]
    assert R.greatest([(0, 8, 2), (1, 13, 3)]) == (1, 13, 3)
    assert R.greatest([(2, 8, 2), (5, 4, 1)]) == (2, 8, 2)


def test_long_texts():
    """Long runs, nested ones and words rich in squares, in seconds."""
    assert R.runs_of([0] * 500_000) == [(0, 500_000, 1)]
    draw = random.Random(3)
    period = [draw.randrange(50) for _ in range(30_011)]
    assert R.runs_of(period * 4) == [(0, 4 * 30_011, 30_011)]
    a, b = [0], [0, 1]
    while len(b) < 200_000:
        a, b = b, b + a
    assert R.runs_of(b) == []  # no fourth power
    assert R.runs_of([x for k in range(60_000) for x in ("a", "b", k)]) == []


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = {r.doc_id: tuple(r) for r in R.op12_periodic_runs(spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for r in docs:
        if len(r.text or "") < 6000:
            assert got[r.doc_id] == brute.run_row(r.doc_id, r.text)


def test_odd_rows(make_docs):
    rows = ODD + ODD + [(8, "x " * 50), (8, "x " * 50), (20, "a b " * 30 + "é\x85 " * 7)]
    got = sorted(map(tuple, R.run_report(make_docs(rows)).collect()), key=repr)
    assert got == sorted((brute.run_row(i, t) for i, t in rows), key=repr)
    assert R.run_report(make_docs(ODD).limit(0)).collect() == []


def test_runs_and_collapsed_text(make_docs):
    (row,) = R.periodic_runs(make_docs([(1, "one  two one two one two one two\tend")])).collect()
    assert [tuple(x) for x in row.runs] == [(0, 8, 2)] and row.collapsed == "one two end"
