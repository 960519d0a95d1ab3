import random

import pytest
from .samples import ODD
from pyspark.sql import functions as F

from .brute import base_failed, statistics
from souk.llm import quality as Q

COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def judged(df, rules=None):
    return Q.judge(df, rules or Q.DecisionList()).collect()


def test_statistics_on_odd_and_random_texts(make_docs):
    draw = random.Random(3)
    texts = [t for _, t in ODD] + ["a b c a b c", "a a a a", "a a a", "x y\nx y\n\n\nx y", "one two three four " * 40]
    texts += [" ".join(draw.choice("ab") for _ in range(draw.randint(0, 30))) + draw.choice(["", "\n", "\t|#"]) for _ in range(200)]
    texts.append(" ".join(draw.choice(["ab", "cd", "ef\n", "g|"]) for _ in range(30_000)))
    rows = judged(make_docs(list(enumerate(texts))))
    assert len(rows) == len(texts)
    for r in rows:
        want = statistics(texts[r.doc_id])
        assert {c: r[c] for c in COLUMNS} == want, texts[r.doc_id]
        assert r.base_failed == base_failed(want) and r.kept == (not r.base_failed)


def test_whole_table_matches_plain_version(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = Q.op1_quality_rules(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = statistics(texts[r.doc_id])
        assert {c: r[c] for c in COLUMNS} == want
        assert r.base_failed == base_failed(want)
        assert r.kept == (not r.base_failed and r.rule == 0)


def test_learned_rules_hold_out(spark):
    """Learned on one half of the labels, right on the other."""
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    rules = Q.learn_rules(docs, labels.where(half))
    assert rules.rules
    held = Q.judge(docs.join(labels.where(~half), "doc_id"), rules).where("not base_failed")
    got = {(r.quality, r.kept): r["count"] for r in held.groupBy("quality", "kept").count().collect()}
    right = got.get((0, False), 0) + got.get((1, True), 0)
    assert right >= 0.97 * sum(got.values())
    assert got.get((1, False), 0) <= 0.01 * got[(1, True)]


def test_no_labels_and_empty_tables(spark, make_docs):
    docs = make_docs([(1, "word " * 60), (2, "x")])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert Q.learn_rules(docs, labels).rules == []
    nulls = spark.createDataFrame([(None, 0, 0), (1, None, 0), (1, 1, 0), (1, 0, 1), (77, 0, 0)], labels.schema)
    assert Q.learn_rules(docs, nulls).rules == []
    assert judged(docs.limit(0)) == []
    assert Q.learn_rules(docs.limit(0), nulls).rules == []


def test_rule_is_pruned_and_ordered(spark):
    sample = spark.range(4000).select(
        (F.col("id") % 5 == 0).cast("int").alias("bad"),
        (F.col("id") % 3 > 0).alias("growing"),
        F.when(F.col("id") % 5 == 0, 2.0).otherwise(0.1).alias("symbol_rate"),
        *[(F.xxhash64("id", F.lit(f)) % 100 / 100.0).alias(f) for f in Q.FEATURES[1:]],
    )
    rules = Q.learn(sample).rules
    assert len(rules) == 1 and len(rules[0]) == 1
    c = rules[0][0]
    assert c.feature == "symbol_rate" and c.above and 0.1 < c.threshold <= 2.0


def test_plan_is_native(spark, sf_dir):
    plan = Q.op1_quality_rules(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
