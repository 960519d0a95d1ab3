"""The queries of this subpackage and the DuckDB SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontaminate, extraction, jaccard, licenses, merkle, quality, repeats, secrets, sequences, sharding, substrings, token_counts
from .common import prepare_session

Query = Callable[[SparkSession, str], DataFrame]


def prepared(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare_session(spark)
        return query(spark, sf_dir)

    return run


# all in JVM expressions
NATIVE: dict[str, Query] = {
    "op1_quality_rules": quality.op1_quality_rules,
    "op4_license_scans": licenses.op4_license_scans,
    "op10_sharding": sharding.op10_sharding,
}

# these run Python in tasks as well
PYTHON: dict[str, Query] = {
    "op2_html_extraction": extraction.op2_html_extraction,
    "op3_token_counts": token_counts.op3_token_counts,
    "op5_decontamination": decontaminate.op5_decontamination,
    "op6_jaccard_join": jaccard.op6_jaccard_join,
    "op7_secret_scans": secrets.op7_secret_scans,
    "op8_substring_dedup": substrings.op8_substring_dedup,
    "op9_byte_bpe": bpe.op9_byte_bpe,
    "op11_token_files": sequences.op11_token_files,
    "op12_periodic_runs": repeats.op12_periodic_runs,
    "op13_merkle_manifest": merkle.op13_merkle_manifest,
}

QUERIES: dict[str, Query] = NATIVE | {name: prepared(q) for name, q in PYTHON.items()}

ORACLE: dict[str, str] = {"op8_substring_dedup": substrings.OP8_SQL, "op13_merkle_manifest": merkle.OP13_SQL}
