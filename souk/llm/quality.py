"""Quality rules: a decision list learned from labelled statistics.

Every document gets text statistics by built-in expressions. From a bounded
sample of labelled documents, sequential covering grows one rule after the
other: a conjunction of thresholds on the statistics, each threshold chosen by
information gain over one distributed histogram, then pruned on held-out
labels. The learned list is emitted as one ordered ``CASE WHEN`` expression,
so applying it is a projection over the whole table.

Defined results: a null or empty text has no words and fails the base rule;
labels that are null, repeated (the worst counts) or without a document are
left out; without usable labels the list is empty and only the base rule
decides; columns of the input are kept unless a statistic has their name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import DOCUMENT_COLUMNS, let, stored, table, text_or_empty, words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50

#: Labelled documents used to learn; chosen by a hash of the id.
MAX_LABELLED = 20_000
#: Quantiles per class from which thresholds are taken.
QUANTILES = 32
MAX_RULES = 12
MAX_CONDITIONS = 3
#: A rule is kept if this share of the held-out documents it rejects are labelled bad,
MIN_PRECISION = 0.95
#: and if it covers so many bad documents of the growing sample at least.
MIN_COVER = 4

FEATURES = ["symbol_rate", "repeat_rate", "dup_line_rate", "upper_rate", "mark_rate", "digit_rate", "word_length", "n_words"]


# -- statistics ------------------------------------------------------------


def repeated_words(w: Column) -> Column:
    """Words of array ``w`` that lie in a 3-word window found twice or more.

    Windows are compared by a 64-bit hash and brought together by sorting, so
    a long text costs n log n; positions are only sorted if a window repeats."""

    def covered(at: Column) -> Column:
        reach = F.transform(at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1), p + 3) - p))
        return F.aggregate(reach, F.lit(0).cast("long"), lambda s, x: s + x)

    def repeats(pairs: Column) -> Column:
        same = F.filter(
            pairs,
            lambda x, k: F.coalesce(x["g"] == F.get(pairs, k + 1)["g"], F.lit(False))
            | F.coalesce((k > 0) & (x["g"] == F.get(pairs, F.greatest(k - 1, F.lit(0)))["g"]), F.lit(False)),
        )
        return let(F.array_sort(F.transform(same, lambda x: x["i"])), covered)

    def from_windows(grams: Column) -> Column:
        pairs = F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i")))
        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0).cast("long")).otherwise(
            let(F.sort_array(pairs), repeats)
        )

    grams = F.transform(
        F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    )
    return F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(let(grams, from_windows))


def _count(text: Column, others: str) -> Column:
    """Characters of a text outside the regular class ``others``."""
    return F.length(F.regexp_replace(text, others, "")).cast("long")


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def statistics(text: Column) -> Column:
    """All statistics of a text as one struct, each computed once."""
    with_word = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    counts = F.struct(
        let(
            words(text),
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                repeated_words(w).alias("n_repeat_words"),
            ),
        ).alias("w"),
        let(
            with_word,
            lambda x: F.struct(F.size(x).alias("lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")),
        ).alias("l"),
        _count(text, "[^#*$%&|<>]+").alias("symbols"),
        _count(text, "[^\\p{Lu}]+").alias("upper"),
        _count(text, "[^!?~^_=+]+").alias("marks"),
        _count(text, "[^0-9]+").alias("digits"),
    )

    def share(part: Column, of: Column) -> Column:
        return F.when(of > 0, part / of).otherwise(F.lit(0.0))

    def from_counts(c: Column) -> Column:
        w, lines = c["w"], c["l"]
        n, chars = w["n_words"], w["word_chars"]
        return F.struct(
            n.alias("n_words"),
            chars.alias("word_chars"),
            c["symbols"].alias("n_symbols"),
            lines["dup"].alias("n_dup_lines"),
            w["n_repeat_words"].alias("n_repeat_words"),
            share(c["symbols"], n).alias("symbol_rate"),
            share(w["n_repeat_words"], n).alias("repeat_rate"),
            share(lines["dup"], lines["lines"]).alias("dup_line_rate"),
            share(c["upper"], chars).alias("upper_rate"),
            share(c["marks"], n).alias("mark_rate"),
            share(c["digits"], chars).alias("digit_rate"),
            share(chars, n).alias("word_length"),
        )

    return let(counts, from_counts)


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    added = dict.fromkeys([*COUNTS, *FEATURES])
    out = docs.withColumn("_stats", statistics(text_or_empty(text)))
    return out.withColumns({x: F.col("_stats")[x] for x in added}).drop("_stats")


def base_failed(row: Column | None = None) -> Column:
    """The base rule over columns, or over a struct of statistics."""
    n, repeats = (F.col(x) if row is None else row[x] for x in ("n_words", "n_repeat_words"))
    return (n < MIN_WORDS) | (100 * repeats > 50 * n)


# -- learning --------------------------------------------------------------


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # value >= threshold, else value < threshold
    threshold: float

    def column(self, row: Column | None = None) -> Column:
        x = F.col(self.feature) if row is None else row[self.feature]
        return x >= F.lit(self.threshold) if self.above else x < F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:.6g}"


@dataclass
class DecisionList:
    """Ordered rules; the first that holds rejects the document."""

    rules: list[list[Condition]] = field(default_factory=list)

    def column(self, row: Column | None = None) -> Column:
        """Number of the first rule that holds (from 1), 0 if none does."""
        out = None
        for k, rule in enumerate(self.rules, 1):
            holds = _all(rule, row)
            out = F.when(holds, k) if out is None else out.when(holds, k)
        return F.lit(0) if out is None else out.otherwise(0)

    def __str__(self) -> str:
        return "\n".join(" and ".join(map(str, r)) + " -> reject" for r in self.rules)


def _all(rule: list[Condition], row: Column | None = None) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column(row)
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> DataFrame:
    """Statistics of at most ``limit`` labelled documents: ``bad`` 0/1,
    ``growing`` (two thirds) or held out, ``failed`` by the base rule, the
    features."""
    chosen = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg((F.min("quality") == 0).cast("int").alias("bad"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )
    few = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most `limit` rows of two numbers
    growing = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(3)) > 0
    return with_statistics(few).select("bad", growing.alias("growing"), base_failed().alias("failed"), *FEATURES)


def thresholds(sample: DataFrame) -> dict[str, list[float]]:
    """Candidate thresholds of each feature: midpoints between neighbouring
    quantiles of either class."""
    at = [i / QUANTILES for i in range(QUANTILES + 1)]
    rows = sample.groupBy("bad").agg(*[F.percentile_approx(f, at, 10_000).alias(f) for f in FEATURES]).collect()
    out = {}
    for f in FEATURES:
        values = sorted({float(v) for r in rows for v in r[f]})
        out[f] = [(a + b) / 2 for a, b in zip(values, values[1:])]
    return out


def _gain(bad: int, good: int, bad0: int, good0: int) -> float:
    """Information gained on the bad documents that stay covered."""
    if not bad:
        return -math.inf
    return bad * (math.log2(bad / (bad + good)) - math.log2(bad0 / (bad0 + good0)))


def _grow(rest: DataFrame, cuts: dict[str, list[float]]) -> list[Condition]:
    """Adds the condition with the most gain until no good document is
    covered. Each step is one histogram: documents of either class by feature
    and number of thresholds at or below the value."""
    rule: list[Condition] = []
    while len(rule) < MAX_CONDITIONS:
        bins = F.posexplode("bins").alias("f", "bin")
        table_ = rest.where(_all(rule)).select("bad", bins).groupBy("f", "bin")
        rows = table_.agg(F.sum("bad").alias("bad"), F.count("*").alias("n")).collect()
        at = {(r.f, r.bin): (r.bad, r.n - r.bad) for r in rows}
        bad0 = sum(b for (f, _), (b, _) in at.items() if f == 0)
        good0 = sum(g for (f, _), (_, g) in at.items() if f == 0)
        if bad0 < MIN_COVER or (good0 == 0 and rule):
            break
        best: tuple = (1e-9, None)
        for f, name in enumerate(FEATURES):
            bad = good = 0
            for k, cut in enumerate(cuts[name]):  # bins 0..k hold the values below cuts[k]
                b, g = at.get((f, k), (0, 0))
                bad, good = bad + b, good + g
                for above, x, y in ((False, bad, good), (True, bad0 - bad, good0 - good)):
                    if x >= MIN_COVER:
                        best = max(best, (_gain(x, y, bad0, good0), Condition(name, above, cut)), key=lambda t: t[0])
        if best[1] is None:
            break
        rule.append(best[1])
    return rule


def _prune(held_out: DataFrame, rule: list[Condition]) -> list[Condition]:
    """The shortest beginning of the rule with the best held-out worth; none
    if it isn't precise enough there."""
    tests = []
    for k in range(1, len(rule) + 1):
        hit = _all(rule[:k]).cast("int")
        tests += [F.sum(hit * F.col("bad")).alias(f"b{k}"), F.sum(hit).alias(f"n{k}")]
    row = held_out.agg(*tests).first()
    scored = [((row[f"b{k}"] or 0), (row[f"n{k}"] or 0), k) for k in range(1, len(rule) + 1)]
    worth = [((2 * b - n) / n, -k) for b, n, k in scored if n and b >= MIN_PRECISION * n]
    return rule[: -max(worth)[1]] if worth else []


def _bin(feature: str, cuts: list[float]) -> Column:
    """How many thresholds are at or below the value."""
    if not cuts:
        return F.lit(0)
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda t: t <= F.col(feature)))


def learn(sample: DataFrame) -> DecisionList:
    """Sequential covering over a stored labelled sample."""
    learned = DecisionList()
    cuts = thresholds(sample)
    if not any(cuts.values()):
        return learned
    bins = F.array(*[_bin(f, cuts[f]) for f in FEATURES])
    binned = stored(sample.select("*", bins.alias("bins")), "quality-bins")
    for _ in range(MAX_RULES):
        rest = binned.where(learned.column() == 0)
        rule = _grow(rest.where("growing"), cuts)
        rule = _prune(rest.where("not growing"), rule) if rule else rule
        if not rule:
            break
        learned.rules.append(rule)
    return learned


def learn_rules(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> DecisionList:
    return learn(stored(labelled_sample(docs, labels, limit), "quality-sample").where("not failed"))


def judge(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """``docs`` with statistics, ``base_failed``, ``rule`` and ``kept``."""
    judged = with_statistics(docs).withColumns({"base_failed": base_failed(), "rule": rules.column()})
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = learn_rules(docs, table(spark, sf_dir, "labels"))
    return judge(docs, rules).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "rule",
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the rules reject go."""
    rules = learn_rules(docs, table(spark, sf_dir, "labels"))
    passes = lambda row: ~base_failed(row) & (rules.column(row) == 0)
    # one predicate that takes its statistics once
    return docs.where(let(statistics(text_or_empty()), passes)).select(*DOCUMENT_COLUMNS)
