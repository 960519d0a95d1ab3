"""A training corpus from ``documents``, stage by stage.

Every stage works on all documents that the one before kept, its decisions
take effect, and its result is written as Parquet and read again, so a lost
executor or a restart costs one stage. Each stage is one operator of
``souk.llm``:

1. quality rules: documents that the learned decision list rejects go;
2. n-gram Jaccard join: one document of each group of near duplicates stays;
3. benchmark decontamination: documents that hold a benchmark item go;
4. secret scans: secrets are blanked out of the texts;
5. byte-level BPE: the documents with their token ids, decoded as a check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from souk.llm import bpe, decontaminate, jaccard, quality, secrets
from souk.llm.common import prepare_session, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def prepared(stage: Stage) -> Stage:
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        prepare_session(spark)
        return stage(spark, docs, sf_dir)

    return run


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", prepared(quality.stage)),
    ("jaccard_join", prepared(jaccard.stage)),
    ("decontamination", prepared(decontaminate.stage)),
    ("secret_scans", prepared(secrets.stage)),
    ("byte_bpe", prepared(bpe.stage)),
]

#: Learned rules, a random field and token ids aren't SQL; tests/llm compares
#: each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
    return docs
