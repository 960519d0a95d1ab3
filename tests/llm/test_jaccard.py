import random

import pytest
from .samples import ODD

from .brute import components
from souk.llm import jaccard as J


def text(draw, n):
    return [f"w{draw.randint(0, 400)}" for _ in range(n)]


def near(draw, words, changes):
    out = list(words)
    for _ in range(changes):
        out[draw.randrange(len(out))] = f"v{draw.randint(0, 10**9)}"
    return out


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(11)
    out = []
    for g in range(6):  # groups made from one text, few and many changes
        base = text(draw, draw.randint(30, 120))
        out += [" ".join(near(draw, base, draw.choice([0, 0, 1, 1, 2, 3, 6]))) for _ in range(25)]
        out += [" ".join(base[: draw.randint(len(base) // 2, len(base))]) for _ in range(8)]
    passage = " ".join(text(draw, 60))  # one passage in many texts
    out += [" ".join(text(draw, draw.randint(5, 25))) + " " + passage for _ in range(40)]
    out += [" ".join(text(draw, draw.randint(1, 40))).upper() for _ in range(40)] + ["one two", "One  TWO\n", "a b c d e", "a b c d"]
    draw.shuffle(out)
    ids = list(range(len(out)))
    draw.shuffle(ids)
    return list(zip(ids, out)) + ODD


def key(x):
    return [(a, -1 if b is None else b, c, -1 if d is None else d) for a, b, c, d in x]


def test_against_all_pairs(make_docs, rows):
    got = J.near_duplicates(make_docs(rows).repartition(5)).collect()
    got = [(r.doc_id is None, r.doc_id, r.n_shingles, r.component_id) for r in got]
    assert sorted(key(got)) == sorted(key(expected_list(rows)))


def expected_list(rows):
    named, sizes = components(rows)
    return [(i is None, i, sizes[k], named[k] if sizes[k] else i) for k, (i, _) in enumerate(rows)]


def test_hot_shingles(make_docs, rows, monkeypatch):
    """Salting and shuffled joins give the same."""
    monkeypatch.setattr(J, "HOT", 3)
    monkeypatch.setattr(J, "SALTS", 4)
    monkeypatch.setattr(J, "BROADCAST_IDS", 0)
    got = J.near_duplicates(make_docs(rows)).collect()
    got = [(r.doc_id is None, r.doc_id, r.n_shingles, r.component_id) for r in got]
    assert sorted(key(got)) == sorted(key(expected_list(rows)))


def test_repeated_ids_and_rows(make_docs):
    base = "the quick brown fox jumps over the lazy dog again and again until it is quite late in the day"
    rows = [(7, base), (7, base), (7, "something else that is not at all like it in any way"), (3, base + " x"), (None, base), (9, None), (9, "")]
    got = J.near_duplicates(make_docs(rows)).collect()
    got = [(r.doc_id is None, r.doc_id, r.n_shingles, r.component_id) for r in got]
    # a node is one text: equal ids don't join texts that aren't alike
    assert sorted(key(got)) == sorted(key(expected_list(rows)))


def test_stage_keeps_one_of_each(spark, make_docs, rows):
    twice = rows + [rows[0], rows[0], (rows[1][0], "quite another text with the id of one before it, long enough")]
    kept = J.stage(spark, make_docs(twice), "").collect()
    named, sizes = components(twice)
    assert len(kept) == len({named[k] for k in named if sizes[k]}) + sum(not s for s in sizes)
    assert len({(r.doc_id, r.text) for r in kept if r.text and r.text.strip()}) == len([r for r in kept if r.text and r.text.strip()])


def test_documents_without_id(make_docs):
    base = "the quick brown fox jumps over the lazy dog again and again until it is quite late in the day"
    other = "an entirely different text that stands alone among all of these and has no id of its own either"
    rows = [(None, base), (5, base + " x"), (None, other), (None, other + " y"), (None, "lonely words that nobody else has written down")]
    got = J.near_duplicates(make_docs(rows)).collect()
    got = [(r.doc_id is None, r.doc_id, r.n_shingles, r.component_id) for r in got]
    assert sorted(key(got)) == sorted(key(expected_list(rows)))
    assert len(J.stage(None, make_docs(rows), "").collect()) == 3


def test_empty(make_docs):
    assert J.near_duplicates(make_docs(ODD).limit(0)).collect() == []


def test_order_makes_prefixes_of_the_right_length():
    for n in range(1, 200):
        keep = n - (J.PERCENT * n + 99) // 100 + 1
        assert 1 <= keep <= n and 100 * (n - keep) < J.PERCENT * n
