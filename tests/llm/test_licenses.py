import random
from re import _parser as parser

from .samples import ODD

from .brute import license_base
from souk.llm import licenses as L

BASE_COLUMNS = ["n_words", "n_base", "first_word", "last_word", "base_labels"]


def scan(df):
    return {r.doc_id: r for r in L.scan(df).collect()}


def test_base_on_the_table(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = L.op4_license_scans(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert tuple(r[c] for c in BASE_COLUMNS) == license_base(docs[r.doc_id], L.BASE)
        assert 0 <= r.score <= 1
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))


def test_base_on_odd_and_random_texts(make_docs):
    draw = random.Random(5)
    bits = ["MIT", "license", "License.", "apache", "GENERAL", "public", "-", "mit license", "İ", "é", "9", "\n", "general-public_license", "K"]
    texts = [t for _, t in ODD] + ["mit license" * 3, "mit license mit license", "Mit\x00License", "MIT LİCENSE", "general public license " * 300]
    texts += [" ".join(draw.choice(bits) for _ in range(draw.randint(0, 25))) for _ in range(300)]
    got = scan(make_docs(list(enumerate(texts))))
    for i, t in enumerate(texts):
        assert tuple(got[i][c] for c in BASE_COLUMNS) == license_base(t, L.BASE), t


def test_signatures(make_docs):
    texts = {
        1: ("Permission is hereby granted, free of charge, to any person obtaining a copy", "mit"),
        2: ("Released under the MIT License.", "mit"),
        3: ("This work is licensed under the GNU General Public License, version 3.", "gpl"),
        4: ("SPDX-License-Identifier: Apache-2.0", "apache"),
        5: ("Creative Commons Attribution-NonCommercial-ShareAlike 4.0", "cc-by-nc-sa"),
        6: ("All rights reserved.", "proprietary"),
        7: ("Redistribution and use in source and binary forms, with or without", "bsd"),
        8: ("GNU Lesser General Public License", "gpl,lgpl"),
        9: ("nothing to see here under the sun", ""),
        10: ("distributed under Mozilla Public", "mpl"),
    }
    got = scan(make_docs([(i, t) for i, (t, _) in texts.items()]))
    assert {i: got[i].labels for i in texts} == {i: label for i, (_, label) in texts.items()}
    assert got[9].score == 0 and got[2].score > got[6].score


def test_containment_and_priority(make_docs):
    got = scan(make_docs([(1, "creative commons attribution share alike and all rights reserved")]))[1]
    assert {d["label"] for d in got.detections} == {"cc-by-sa", "proprietary"}
    assert len(got.hits) > len(got.detections)
    spans = [(d["start"], 1 - d["back"], -d["down"]) for d in got.detections]
    for a in got.hits:  # each dropped hit lies in a kept one of the same or a higher priority
        assert any(s <= a["start"] and -a["back"] <= -d["back"] and -d["down"] >= -a["down"] for d in got.detections for s in [d["start"]])
    assert len(spans) == len(set(spans))


def test_gate_loses_no_rule(make_docs, monkeypatch):
    texts = [t for _, t in ODD] + ["under mit", "provided by the zlib", "cc-by 4.0", "for personal use only", "Q Public Licence", "may not be copied without permission"]
    docs = make_docs(list(enumerate(texts)))
    gated = {i: r.labels for i, r in scan(docs).items()}
    monkeypatch.setattr(L, "GATE", "")
    assert gated == {i: r.labels for i, r in scan(docs).items()}


def test_empty_table_and_plan(spark, sf_dir, make_docs):
    assert scan(make_docs(ODD).limit(0)) == {}
    assert len(L.signatures()) >= 300
    plan = L.op4_license_scans(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def phrase(tree, most):
    """A text that a parsed pattern matches: its shortest or a longer one."""
    out = ""
    for op, value in tree:
        kind = str(op)
        if kind == "LITERAL":
            out += chr(value)
        elif kind == "IN":
            what, first = value[0]
            out += "q" if str(what) == "NEGATE" else chr(first if str(what) == "LITERAL" else first[0])
        elif kind == "NOT_LITERAL":
            out += "q"
        elif kind == "MAX_REPEAT":
            out += phrase(value[2], most) * (max(value[0], 1) if most else value[0])
        elif kind == "SUBPATTERN":
            out += phrase(value[3], most)
        elif kind == "BRANCH":
            out += phrase(value[1][-1 if most else 0], most)
        else:
            raise ValueError(kind)
    return out


def test_gate_loses_no_rule_under_any_separator(make_docs, monkeypatch):
    phrases = {phrase(parser.parse(r.pattern), most): r.label for r in L.signatures() for most in (False, True)}
    texts = [p.replace(" ", sep) for p in phrases for sep in ("\n", "\n * ", " -- \r\n#\t ")]
    texts += ["released into the public\ndomain", "is in the public\n * domain", "Creative\nCommons Attribution", "CC ----- BY"]
    docs = make_docs(list(enumerate(texts)))
    gated = {i: (r.labels, r.score) for i, r in scan(docs).items()}
    assert all(labels for labels, _ in gated.values())
    monkeypatch.setattr(L, "GATE", "")
    assert gated == {i: (r.labels, r.score) for i, r in scan(docs).items()}
