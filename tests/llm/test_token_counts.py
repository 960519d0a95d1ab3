import random

import numpy as np
import pytest

from souk.llm import token_counts as T
from souk.llm.bpe import vocabulary_path

from .samples import ODD


@pytest.fixture(scope="module")
def encode():
    return T._encoding(vocabulary_path()).encode_ordinary


def test_query(spark, sf_dir, encode):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: r.n_tokens for r in T.op3_token_counts(spark, sf_dir).collect()}
    assert got == {i: len(encode(t or "")) for i, t in docs.items()}


def lengths(spark, files, block, group, folder):
    for name, tokens in files.items():
        np.array(tokens, "<u2").tofile(folder / name)
    scanned = T.scan_ranges(T.ranges(T.files_in(spark, str(folder)), block, tasks=3))
    out = {}
    for r in T.document_lengths(scanned, group).collect():
        out.setdefault(r.file.rsplit("/", 1)[1], {})[r.number] = r.n_tokens
    return {f: [x[k] for k in range(len(x))] for f, x in out.items()}


@pytest.mark.parametrize("block,group", [(1, 2), (3, 4), (7, 1), (64, 1024)])
def test_stitching(spark, block, group, tmp_path):
    draw = random.Random(block)
    files, want = {}, {}
    for f in range(8):
        docs = [draw.choice([0, 0, 1, 2, 5, 40]) for _ in range(draw.randint(0, 12))]
        tokens = [t for n in docs for t in [draw.randrange(T.END) for _ in range(n)] + [T.END]]
        rest = draw.choice([0, 0, 3, 30])
        tokens += [5] * rest
        files[f"f{f}"] = tokens
        if tokens:
            want[f"f{f}"] = docs + ([rest] if rest else [])
    assert lengths(spark, files, block, group, tmp_path) == want


def test_flat_files(spark, tmp_path):
    np.array([1, 2, T.END, T.END, 3, 4, 5, T.END, 9], "<u2").tofile(tmp_path / "a.bin")
    np.array([7] * 10, "<u2").tofile(tmp_path / "b.bin")
    (tmp_path / "c.bin").write_bytes(b"")
    (tmp_path / "d.bin").write_bytes(np.array([3, T.END], "<u2").tobytes() + b"x")
    rows = T.document_lengths(T.scan_ranges(T.ranges(T.files_in(spark, str(tmp_path)), block=4))).collect()
    got = sorted((r.file.rsplit("/", 1)[1], r.number, r.n_tokens) for r in rows)
    assert got == [("a.bin", 0, 2), ("a.bin", 1, 0), ("a.bin", 2, 3), ("a.bin", 3, 1), ("b.bin", 0, 10), ("d.bin", 0, 1)]


def test_odd_rows_across_small_blocks(spark, make_docs, encode, tmp_path):
    rows = [*ODD, *ODD, (7, "many words " * 500)]
    T.write_files(make_docs(rows).repartition(3), f"file:{tmp_path}/tokens").write.parquet(str(tmp_path / "written"))
    written = spark.read.parquet(str(tmp_path / "written"))
    files, order = written.where("size is not null"), written.where("size is null").select("file", "number", "doc_id")
    assert {r.file.rsplit("/", 1)[1]: r.size for r in files.collect()} == {p.name: p.stat().st_size for p in (tmp_path / "tokens").iterdir()}
    scanned = T.scan_ranges(T.ranges(files.select("file", "size"), block=11))
    met = order.join(T.document_lengths(scanned, group=3), ["file", "number"], "full").collect()
    text = dict(rows)
    assert len(met) == len(rows) and all(r.n_tokens == len(encode(text[r.doc_id] or "")) for r in met)
    assert T.write_files(make_docs(ODD).limit(0), str(tmp_path / "none")).collect() == []
