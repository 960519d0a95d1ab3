"""Licence scans: ordered signature rules.

Texts are brought to words of a-z, 0-9 and non-ASCII characters, joined by one
space. One regular expression over the raw text says whether any licence
keyword occurs at all; only then the signature rules are tried, and of them
only the groups whose own keyword occurs. Each match is an interval of words.
Overlaps are resolved by priority and interval containment: a match inside
another one of the same or a higher priority is dropped.

Everything runs inside a row by built-in expressions: no exchange, so a hot
source or a large group of copies costs what its own texts cost.

Defined results: a null or empty text has no words, no labels and score 0;
a phrase found twice counts twice; extra columns of the input are kept.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, table, text_or_empty

# The base phrases and their labels.
BASE = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Licence names as they read after normalisation (a regular
# expression over words), the label, the SPDX identifier in words, a keyword.
FAMILIES = [
    ("mit", "mit", "mit", "mit"),
    ("mit no attribution", "mit-0", "mit 0", "mit"),
    ("x11", "x11", "x11", "x11"),
    ("apache(?: software)?", "apache", "apache 2 0", "apache"),
    ("(?:the )?bsd(?: style)?", "bsd", "bsd", "bsd"),
    ("(?:2 clause|simplified|freebsd) bsd", "bsd-2-clause", "bsd 2 clause", "bsd"),
    ("(?:3 clause|new|revised|modified) bsd", "bsd-3-clause", "bsd 3 clause", "bsd"),
    ("(?:4 clause|original) bsd", "bsd-4-clause", "bsd 4 clause", "bsd"),
    ("(?:zero clause|0 ?clause) bsd", "0bsd", "0bsd", "bsd"),
    ("(?:gnu )?general public", "gpl", "gpl", "general public"),
    ("(?:gnu )?lesser general public", "lgpl", "lgpl", "lesser"),
    ("(?:gnu )?library general public", "lgpl", "lgpl 2 0", "library general"),
    ("(?:gnu )?affero general public", "agpl", "agpl", "affero"),
    ("gnu free documentation", "gfdl", "gfdl", "documentation"),
    ("gpl", "gpl", "gpl 3 0", "gpl"),
    ("lgpl", "lgpl", "lgpl 3 0", "lgpl"),
    ("agpl", "agpl", "agpl 3 0", "agpl"),
    ("mozilla public", "mpl", "mpl 2 0", "mozilla"),
    ("eclipse public", "epl", "epl 2 0", "eclipse"),
    ("eclipse distribution", "edl", "edl 1 0", "eclipse"),
    ("common development and distribution", "cddl", "cddl 1 0", "development and distribution"),
    ("common public", "cpl", "cpl 1 0", "common public"),
    ("common public attribution", "cpal", "cpal 1 0", "common public"),
    ("artistic", "artistic", "artistic 2 0", "artistic"),
    ("isc", "isc", "isc", "isc"),
    ("boost(?: software)?", "boost", "bsl 1 0", "boost"),
    ("business source", "busl", "busl 1 1", "business source"),
    ("zlib(?: libpng)?", "zlib", "zlib", "zlib"),
    ("libpng", "libpng", "libpng", "libpng"),
    ("python software foundation", "psf", "psf 2 0", "python"),
    ("ruby", "ruby", "ruby", "ruby"),
    ("php", "php", "php 3 01", "php"),
    ("perl", "perl", "perl", "perl"),
    ("openssl", "openssl", "openssl", "openssl"),
    ("curl", "curl", "curl", "curl"),
    ("postgresql", "postgresql", "postgresql", "postgresql"),
    ("vim", "vim", "vim", "vim"),
    ("unicode", "unicode", "unicode dfs 2016", "unicode"),
    ("sil open font", "ofl", "ofl 1 1", "open font"),
    ("open software", "osl", "osl 3 0", "open software"),
    ("academic free", "afl", "afl 3 0", "academic free"),
    ("educational community", "ecl", "ecl 2 0", "educational community"),
    ("european union public", "eupl", "eupl 1 2", "european union"),
    ("microsoft public", "ms-pl", "ms pl", "microsoft"),
    ("microsoft reciprocal", "ms-rl", "ms rl", "microsoft"),
    ("ibm public", "ipl", "ipl 1 0", "ibm"),
    ("netscape public", "npl", "npl 1 1", "netscape"),
    ("sun public", "spl", "spl 1 0", "sun public"),
    ("q public", "qpl", "qpl 1 0", "q public"),
    ("latex project public", "lppl", "lppl 1 3c", "latex"),
    ("w3c software(?: notice and)?", "w3c", "w3c", "w3c"),
    ("do what the f ?u?c?k? ?you want to public", "wtfpl", "wtfpl", "you want to public"),
    ("universal permissive", "upl", "upl 1 0", "universal permissive"),
    ("university of illinois ncsa open source", "ncsa", "ncsa", "ncsa"),
    ("mulan permissive software", "mulan", "mulanpsl 2 0", "mulan"),
    ("server side public", "sspl", "sspl 1 0", "server side public"),
    ("elastic", "elastic", "elastic 2 0", "elastic"),
    ("blue oak model", "blueoak", "blueoak 1 0 0", "blue oak"),
    ("open database", "odbl", "odbl 1 0", "open database"),
    ("open data commons(?: attribution)?", "odc", "odc by 1 0", "open data commons"),
    ("unlicense", "unlicense", "unlicense", "unlicense"),
]

# How a notice names a licence. N is the name, S the SPDX words.
TEMPLATES = [
    ("(?:released|licensed|distributed|available|provided|published|covered|governed|made available)"
     " (?:under|by) (?:the )?(?:terms (?:of|and conditions of) )?(?:the )?N(?: (?:public )?licen[cs]e)?(?: version [0-9]+(?: [0-9]+)?)?", 3),
    ("(?:is|are|be) (?:licensed|distributed) (?:under|by) (?:the )?N(?: licen[cs]e)?", 2),
    ("licen[cs]e N", 1),
    ("N licen[cs]e(?: version)? v?[0-9]+(?: [0-9]+)?(?: or (?:any )?later(?: version)?)?", 2),
    ("N licen[cs]e", 1),
    ("spdx licen[cs]e identifier S(?: or later| only)?", 3),
]

# Sentences of licence texts and notices without a family name.
CLAUSES = [
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", "hereby granted", 3),
    ("the software is provided as is without warranty of any kind", "mit", "without warranty", 1),
    ("permission to use copy modify and (?:or )?distribute this software", "isc", "permission to use", 3),
    ("redistribution and use in source and binary forms", "bsd", "redistribution", 3),
    ("redistributions of source code must retain the above copyright notice", "bsd", "redistributions", 2),
    ("redistributions in binary form must reproduce the above copyright notice", "bsd", "redistributions", 2),
    ("neither the name of (?:[^ ]+ ){1,12}nor the names of its contributors", "bsd-3-clause", "neither the name", 3),
    ("all advertising materials mentioning features or use of this software", "bsd-4-clause", "advertising materials", 3),
    ("you may not use this file except in compliance with the licen[cs]e", "apache", "in compliance with", 3),
    ("unless required by applicable law or agreed to in writing", "apache", "applicable law", 2),
    ("this program is free software you can redistribute it and or modify it", "gpl", "free software", 3),
    ("this library is free software you can redistribute it and or modify it", "lgpl", "free software", 3),
    ("but without any warranty without even the implied warranty of merchantability", "gpl", "merchantability", 2),
    ("this source code form is subject to the terms of the mozilla public licen[cs]e", "mpl", "mozilla", 3),
    ("this is free and unencumbered software released into the public domain", "unlicense", "unencumbered", 3),
    ("(?:released|dedicated|placed) (?:in|into|to) the public domain", "public-domain", "public domain", 3),
    ("(?:is|are) in the public domain", "public-domain", "public domain", 2),
    ("this work is in the public domain", "public-domain", "public domain", 3),
    ("creative commons(?: attribution)?(?: [0-9] [0-9])?", "cc", "creative commons", 1),
    ("creative commons (?:zero|cc0|public domain dedication)", "cc0", "creative commons", 3),
    ("creative commons attribution (?:[0-9] [0-9] )?(?:international |unported )?licen[cs]e", "cc-by", "creative commons", 2),
    ("creative commons attribution share ?alike", "cc-by-sa", "creative commons", 3),
    ("creative commons attribution no ?deriv(?:ative)?s?", "cc-by-nd", "creative commons", 3),
    ("creative commons attribution non ?commercial", "cc-by-nc", "creative commons", 3),
    ("creative commons attribution non ?commercial share ?alike", "cc-by-nc-sa", "creative commons", 3),
    ("creative commons attribution non ?commercial no ?deriv(?:ative)?s?", "cc-by-nc-nd", "creative commons", 3),
    ("cc by(?: [0-9] [0-9])?", "cc-by", "cc by", 1),
    ("cc by sa(?: [0-9] [0-9])?", "cc-by-sa", "cc by", 2),
    ("cc by nd(?: [0-9] [0-9])?", "cc-by-nd", "cc by", 2),
    ("cc by nc(?: [0-9] [0-9])?", "cc-by-nc", "cc by", 2),
    ("cc by nc sa(?: [0-9] [0-9])?", "cc-by-nc-sa", "cc by", 3),
    ("cc by nc nd(?: [0-9] [0-9])?", "cc-by-nc-nd", "cc by", 3),
    ("cc0(?: 1 0)?", "cc0", "cc0", 2),
    ("all rights reserved", "proprietary", "all rights", 1),
    ("(?:proprietary and confidential|confidential and proprietary)", "proprietary", "proprietary", 3),
    ("unauthori[sz]ed (?:copying|reproduction|use|distribution)(?: of)?", "proprietary", "unauthori", 2),
    ("may not be (?:copied|reproduced|distributed)(?: [^ ]+){0,6} without (?:the )?(?:prior |express )?(?:written )?permission", "proprietary", "may not be", 3),
    ("end user licen[cs]e agreement", "eula", "end user", 3),
    ("for non ?commercial use only", "non-commercial", "commercial", 2),
    ("for (?:personal|evaluation|educational) use only", "restricted-use", "use only", 2),
]

#: Raw texts without any of these have no match of any rule.
GATE = (
    "(?i)licen[cs]e|copyright|spdx|public[^a-z0-9]+domain|creative[^a-z0-9]+commons|cc[^a-z0-9]+by|cc0|all[^a-z0-9]+rights"
    "|redistribut|warranty|hereby|permission|proprietary|unauthori[sz]ed|commercial|use[^a-z0-9]+only"
    "|(released|distributed|available|provided|published|covered|governed)[^a-z0-9]+(under|by)"
    "|advertising[^a-z0-9]+materials|neither|compliance|applicable[^a-z0-9]+law|merchantab|unencumbered|free[^a-z0-9]+software"
)

#: Share of certainty that a match of each priority adds.
WEIGHT = {0: 0.5, 1: 0.5, 2: 0.8, 3: 0.95}

SEPARATOR = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Signature:
    label: str
    keyword: str
    pattern: str
    priority: int
    base: bool = False


def signatures() -> list[Signature]:
    """All rules in order: base phrases, families by template, clauses."""
    out = [Signature(label, phrase.split()[-1], phrase, 1, True) for phrase, label in BASE.items()]
    for name, label, spdx, keyword in FAMILIES:
        for template, priority in TEMPLATES:
            by_spdx = "S" in re.sub("[a-z]", "", template)
            pattern = re.sub(r"\bN\b", f"(?:{name})", re.sub(r"\bS\b", spdx, template))
            out.append(Signature(label, "spdx" if by_spdx else keyword, pattern, priority))
    out += [Signature(label, keyword, pattern, priority) for pattern, label, keyword, priority in CLAUSES]
    return out


def _literal(rules: list[Signature]) -> Column:
    """Rules grouped by keyword, as one literal array."""
    groups: dict[str, list[Signature]] = {}
    for r in rules:
        groups.setdefault(r.keyword, []).append(r)
    return F.array(
        *[
            F.struct(
                F.lit(keyword).alias("keyword"),
                F.array(
                    *[
                        F.struct(
                            F.lit(f"(?<= )(?:{r.pattern})(?= )").alias("pattern"),
                            F.lit(r.label).alias("label"),
                            F.lit(r.priority).alias("priority"),
                            F.lit(r.base).alias("base"),
                        )
                        for r in group
                    ]
                ).alias("rules"),
            )
            for keyword, group in groups.items()
        ]
    )


def _spaces(x: Column) -> Column:
    return F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))


HIT = "struct<start:int,back:int,down:int,label:string,base:boolean>"


def _places(norm: Column, rule: Column) -> Column:
    """All matches of one rule as word intervals. The pieces between the
    matches give each match its place: the spaces before it."""
    pieces = F.split(norm, rule["pattern"], -1)
    found = F.regexp_extract_all(norm, rule["pattern"], F.lit(0))

    def step(acc: Column, pair: Column) -> Column:
        start = acc["seen"] + _spaces(pair["piece"])
        end = start + _spaces(pair["hit"]) + 1
        hit = F.struct(
            (start - 1).alias("start"),
            (-(end - 1)).alias("back"),
            (-rule["priority"]).alias("down"),
            rule["label"].alias("label"),
            rule["base"].alias("base"),
        )
        return F.struct(
            (end - 1).alias("seen"),
            F.concat(acc["out"], F.array(hit.cast(HIT))).alias("out"),
        )

    def walk(pairs: Column) -> Column:
        start = F.struct(F.lit(0).alias("seen"), F.array().cast(f"array<{HIT}>").alias("out"))
        return F.aggregate(F.filter(pairs, lambda p: p["hit"].isNotNull()), start, step, lambda acc: acc["out"])

    return let(F.arrays_zip(pieces.alias("piece"), found.alias("hit")), walk)


def _uncontained(hits: Column) -> Column:
    """Hits in order of start, longest and highest first; one is dropped if an
    earlier one of the same or a higher priority reaches its end. One pass
    that carries the furthest end by priority."""

    def step(acc: Column, h: Column) -> Column:
        end, level = -h["back"], -h["down"]
        reach = F.greatest(*[F.when(F.lit(p) >= level, acc[f"e{p}"]).otherwise(F.lit(-1)) for p in (1, 2, 3)])
        out = F.when(reach >= end, acc["out"]).otherwise(F.concat(acc["out"], F.array(h)))
        ends = [F.when(level == p, F.greatest(acc[f"e{p}"], end)).otherwise(acc[f"e{p}"]).alias(f"e{p}") for p in (1, 2, 3)]
        return F.struct(*ends, out.alias("out"))

    zero = F.struct(*[F.lit(-1).alias(f"e{p}") for p in (1, 2, 3)], F.array().cast(f"array<{HIT}>").alias("out"))
    return F.aggregate(F.sort_array(hits), zero, step, lambda acc: acc["out"])


def scan(docs: DataFrame, rules: list[Signature] | None = None, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``hits`` (all word intervals), ``detections``
    (those left after suppression) and the digest columns of the scan."""
    groups = _literal(signatures() if rules is None else rules)
    body = text_or_empty(text)

    def hits(norm: Column) -> Column:
        tried = F.flatten(F.transform(F.filter(groups, lambda g: F.contains(norm, g["keyword"])), lambda g: g["rules"]))
        return F.flatten(F.transform(F.filter(tried, lambda r: F.rlike(norm, r["pattern"])), lambda r: _places(norm, r)))

    def from_words(spaced: Column) -> Column:
        none = F.array().cast(f"array<{HIT}>")
        lowered = F.concat(F.lit(" "), F.translate(spaced, UPPER, LOWER), F.lit(" "))
        return F.struct(
            F.when(spaced == "", 0).otherwise(_spaces(spaced) + 1).cast("long").alias("n_words"),
            F.when(body.rlike(GATE), let(lowered, hits)).otherwise(none).alias("hits"),
        )

    scanned = docs.withColumn("_scan", let(F.trim(F.regexp_replace(body, SEPARATOR, " ")), from_words))
    out = scanned.withColumns({"n_words": F.col("_scan.n_words"), "hits": F.col("_scan.hits")}).drop("_scan")
    out = out.withColumn("detections", F.when(F.size("hits") > 0, _uncontained(F.col("hits"))).otherwise(F.col("hits")))
    base = F.filter("hits", lambda h: h["base"])
    labels = F.concat(F.transform(base, lambda h: h["label"]), F.transform("detections", lambda h: h["label"]))
    doubt = F.aggregate(
        F.transform("detections", lambda h: F.lit(1.0) - _weight(-h["down"])), F.lit(1.0), lambda a, x: a * x
    )
    joined = lambda xs: F.array_join(F.array_sort(F.array_distinct(xs)), ",")
    return out.withColumns(
        {
            "n_base": F.size(base).cast("long"),
            "first_word": F.array_min(F.transform(base, lambda h: h["start"])).cast("long"),
            "last_word": F.array_max(F.transform(base, lambda h: h["start"])).cast("long"),
            "base_labels": joined(F.transform(base, lambda h: h["label"])),
            "labels": joined(labels),
            "score": F.round(F.lit(1.0) - doubt, 6),
        }
    )


def _weight(priority: Column) -> Column:
    out = F.lit(WEIGHT[0])
    for p, w in WEIGHT.items():
        out = F.when(priority == p, F.lit(w)).otherwise(out)
    return out


def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        "base_labels",
        "labels",
        "score",
    )
