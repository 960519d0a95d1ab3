import random

import pytest
import tiktoken
from .samples import ODD

from .brute import sha
from souk.llm import bpe as B


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=B.PATTERN, mergeable_ranks=B.read_ranks(B.vocabulary_path()), special_tokens={})


BITS = ["a", "b", " ", "  ", "\n", "'s", "'", "re", "ll", " '", "1", "23", "!", "?", "é", "\t", " \n ", "日", "本", "　", "\x1c", "\x85", " ", "🙂", "<|endoftext|>", "d", "v", "m"]


@pytest.mark.parametrize("leaf", [1, 2, 3, 7, 50])
def test_any_cut_gives_the_library_ids(library, leaf):
    draw, codec = random.Random(leaf), B.codec(B.vocabulary_path())
    for _ in range(4000):
        text = "".join(draw.choice(BITS) for _ in range(draw.randint(0, 40)))
        ids = codec.encode(text, leaf)
        assert ids == library.encode_ordinary(text), text
        assert codec.decode(ids, 3) == text.encode()


@pytest.mark.parametrize("text", ["a" * 5000, " " * 3000, "ab " * 2000 + " " * 50, "é" * 3000 + "'re", "\n" * 999 + "x", "x" + "\x1c!" * 500])
def test_long_pieces(library, text):
    codec = B.codec(B.vocabulary_path())
    for leaf in (5, 64, 1000):
        assert codec.encode(text, leaf) == library.encode_ordinary(text)


def test_join_is_associative(library):
    codec, draw = B.codec(B.vocabulary_path()), random.Random(1)
    for _ in range(500):
        a, b, c = (("".join(draw.choice(BITS) for _ in range(draw.randint(0, 12)))) for _ in range(3))
        parts = [(t, codec.leaf_ids(t)) for t in (a, b, c)]
        left = codec.join(codec.join(parts[0], parts[1]), parts[2])
        assert left == codec.join(parts[0], codec.join(parts[1], parts[2])) == (a + b + c, library.encode_ordinary(a + b + c))


def test_merges_by_rank(library):
    """Against a plain merge loop over the ranks."""
    ranks = B.read_ranks(B.vocabulary_path())
    codec = B.codec(B.vocabulary_path())
    for word in [" The", "tokenisation", "日本語", "🙂🙂", "aaaaaaaaaaaaaaaa", "$$$###"]:
        parts = [bytes([c]) for c in word.encode()]
        while True:
            pairs = [(ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
            if not pairs:
                break
            k = min(pairs)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        assert codec.encode(word) == [ranks[p] for p in parts]


def test_query(spark, sf_dir, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = B.op9_byte_bpe(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = library.encode_ordinary(docs[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids)).encode()), sha((docs[r.doc_id] or "").encode()))


def test_odd_rows(make_docs):
    got = B.with_digests(make_docs(ODD + ODD)).collect()
    assert len(got) == 2 * len(ODD)
    by = {r.doc_id: r for r in got}
    for i, t in ODD:
        assert by[i].decoded_sha256 == sha((t or "").encode())
    assert by[900].n_tokens == 0 and by[900].ids_sha256 == sha(b"")
    assert B.with_digests(make_docs(ODD).limit(0)).collect() == []


def test_decode_alone(make_docs):
    for r in B.decode(B.encode(make_docs(ODD))).collect():
        assert bytes(r.decoded) == (r.text or "").encode()
