import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer
from .samples import ODD

from souk.llm import sequences as Q
from souk.llm.bpe import vocabulary_path


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(vocabulary_path(Q.VOCABULARY))
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, Q.END]


def expected(rows, library):
    out, start = [], 0
    for doc_id, text in rows:
        ids = library(text)
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def in_order(got):
    return sorted((tuple(r) for r in got), key=lambda r: r[1])


def test_query(spark, sf_dir, library):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    assert in_order(Q.op11_token_files(spark, sf_dir).collect()) == expected(docs, library)


@pytest.mark.parametrize("length,tokens,rows", [(8, 50, 40), (16, 1 << 20, 1000), (3, 1, 7)])
def test_any_cut_into_files(spark, make_docs, tmp_path, library, length, tokens, rows):
    """Small files, many tasks, documents over many sequences and batches."""
    draw = random.Random(length)
    docs = [(i, None if i % 17 == 0 else " ".join(draw.choice(["a", "word", "!", "日本"]) for _ in range(draw.randint(0, 60)))) for i in range(200)]
    docs[50] = (50, "long " * 6000)
    shuffled = draw.sample(docs, len(docs))
    manifest = Q.write_sequences(make_docs(shuffled), str(tmp_path), length=length, file_tokens=tokens, rows_per_task=rows)
    assert in_order(Q.read_documents(manifest).collect()) == expected(docs, library)
    files = manifest.collect()
    assert sum(f.n_docs for f in files) == 200
    assert sum(f.n_tokens for f in files) == sum(len(library(t)) for _, t in docs)
    for f in files:
        file = Q.SequenceFile(f.path)
        assert len(file) == f.n_sequences == -(-f.n_tokens // length)


def test_random_access_copies_nothing(spark, make_docs, tmp_path, library):
    docs = [(i, f"text number {i} " * (i % 9)) for i in range(300)]
    (one,) = Q.write_sequences(make_docs(docs).coalesce(1), str(tmp_path), length=16, rows_per_task=1 << 20).orderBy("part").collect()[:1]
    file = Q.SequenceFile(one.path)
    flat = np.concatenate([x[0][np.array(x[1])] for x in (file[i] for i in range(len(file)))])
    assert len(flat) == one.n_tokens
    before = pa.total_allocated_bytes()
    kept = [file[i] for i in (0, len(file) // 2, len(file) - 1)]
    assert pa.total_allocated_bytes() == before  # slices of the mapped file
    for ids, mask in kept:
        assert not ids.flags.owndata and not ids.flags.writeable and len(ids) == len(mask) == 16
    assert all(file[len(file) - 1][0][~np.array(file[len(file) - 1][1])] == Q.END)
    with pytest.raises(IndexError):
        file[len(file)]


def test_odd_rows_and_ties(make_docs, tmp_path, library):
    rows = ODD + ODD + [(3, "twice"), (3, "twice"), (3, "other")]
    got = in_order(Q.read_documents(Q.write_sequences(make_docs(rows), str(tmp_path), length=8)).collect())
    assert [r[0] for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    assert [r[1] for r in got] == [0, *np.cumsum([r[2] for r in got])[:-1].tolist()]
    ids = lambda t: library(t)
    want = sorted(((i, len(ids(t)), zlib.crc32(np.array(ids(t), "<u4").tobytes())) for i, t in rows), key=repr)
    assert sorted(((r[0], r[2], r[3]) for r in got), key=repr) == want
    empty = Q.write_sequences(make_docs(ODD).limit(0), str(tmp_path))
    assert empty.collect() == [] and Q.read_documents(empty).collect() == []


@pytest.fixture(scope="module")
def vocabulary():
    with open(vocabulary_path(Q.VOCABULARY), encoding="utf-8") as file:
        return file.read()


def test_chunks_encode_like_the_whole(library, vocabulary):
    draw, encode = random.Random(4), Q.Encoder(vocabulary, "uint16", known=100)
    signs = ["a", "b", "b ", " ", "  ", "\n", "'s", "1", "!", "é", "\t", "日", "\x85", "\x1c", "\u3000", "\r", "\x0b", "🙂", "'", "re", ".", ",", "_", "²", "ß", "м", "\u0301", "-"]
    texts = ["".join(draw.choice(signs) for _ in range(draw.randint(0, 60))) for _ in range(4000)]
    assert all("".join(Q.CHUNK.findall(t)) == t for t in texts)
    assert [encode.ids(t).tolist() for t in texts] == [library(t) for t in texts]
    assert len(encode) <= 100


def test_long_texts(library, vocabulary):
    encode = Q.Encoder(vocabulary, "uint32")
    for text in ("x" * 5000, " " * 5000, "ab\n" * 5000, "日本" * 3000):
        assert encode.ids(text).tolist() == library(text)


def test_markers_in_a_text_are_text(vocabulary):
    assert 50256 not in Q.Encoder(vocabulary, "uint16").ids("a <|endoftext|> b")


def test_wide_vocabulary(tmp_path):
    writer = Q.SequenceWriter(str(tmp_path), "wide.arrow", pa.uint32(), length=4)
    writer.add(1, np.array([70_000, 5, 0], np.uint32))
    writer.add(2, np.array([99_999, 0], np.uint32))
    writer.close()
    file = Q.SequenceFile(f"{tmp_path}/wide.arrow")
    assert file[0][0].tolist() == [70_000, 5, 0, 99_999] and file[1][0].tolist() == [0, 0, 0, 0]
    assert file[1][1].to_pylist() == [True, False, False, False]
    assert [(d, p.tolist()) for _, d, p in file.parts()] == [([1, 2], [3, 5])]
