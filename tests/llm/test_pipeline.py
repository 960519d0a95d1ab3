"""Each stage against a plain version, on its own input."""

import pytest

import corpus_pipeline as P
from souk.llm import quality
from souk.llm.common import DOCUMENT_COLUMNS, stored, table

from .brute import base_failed, components, secret_spans, statistics
from .samples import ODD


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = [docs]
    for name, stage in P.STAGES:
        out.append(stored(stage(spark, out[-1], sf_dir), name))
    return [[r.asDict() for r in df.collect()] for df in out], out


def test_names_and_columns(steps):
    assert [n for n, _ in P.STAGES] == ["quality_rules", "jaccard_join", "decontamination", "secret_scans", "byte_bpe"]
    for df in steps[1][1:-1]:
        assert df.columns == DOCUMENT_COLUMNS


def test_quality(steps, spark, sf_dir):
    rows, kept = steps[0][0], {r["doc_id"] for r in steps[0][1]}
    assert all((r["doc_id"] not in kept) or not base_failed(statistics(r["text"])) for r in rows)
    verdict = {r.doc_id: r.kept for r in quality.op1_quality_rules(spark, sf_dir).collect()}
    assert kept == {i for i, k in verdict.items() if k}


def test_one_of_each_group(steps):
    rows, kept = steps[0][1], {r["doc_id"] for r in steps[0][2]}
    named, _ = components([(r["doc_id"], r["text"]) for r in rows])
    assert kept == {r["doc_id"] for k, r in enumerate(rows) if named[k] == r["doc_id"]}


def test_no_benchmark_item_is_left(steps, spark, sf_dir):
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    before, after = steps[0][2], {r["doc_id"] for r in steps[0][3]}
    for r in before:
        text = " ".join(r["text"].lower().split())
        if any(i in text for i in items):
            assert r["doc_id"] not in after
    assert len(after) >= 0.9 * len(before)


def test_secrets_are_blanked(steps):
    before, after = {r["doc_id"]: r for r in steps[0][3]}, {r["doc_id"]: r for r in steps[0][4]}
    assert before.keys() == after.keys()
    for i, r in after.items():
        assert secret_spans(r["text"]) == []
        assert r["n_chars"] == len(r["text"]) or r["text"] == before[i]["text"]
        if not secret_spans(before[i]["text"]):
            assert r["text"] == before[i]["text"] or "[secret]" in r["text"]


def test_tokens_decode(steps):
    assert {r["doc_id"] for r in steps[0][4]} == {r["doc_id"] for r in steps[0][5]}
    assert all(r["decodes"] and r["n_tokens"] == len(r["ids"]) for r in steps[0][5])


def test_run_gives_the_last_stage(steps, spark, sf_dir):
    assert sorted(r.doc_id for r in P.run(spark, sf_dir).collect()) == sorted(r["doc_id"] for r in steps[0][5])


def test_stages_take_odd_and_empty_documents(spark, make_docs, sf_dir):
    for docs in (make_docs(ODD + ODD), make_docs(ODD).limit(0)):
        for _, stage in P.STAGES:
            docs = stored(stage(spark, docs, sf_dir), "odd")
