"""The operators' queries and their SQL, for ``__spark_entry__``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from strata.llm import ann, decontam, idfile, langid, licenses, lm, merkle, packing, pii, rtree, secrets, simhash, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pipeline": corpus_pipeline.run,
    "op1_pii": pii.op1_pii,
    "op10_language_id": langid.op10_language_id,
    "op2_licenses": licenses.op2_licenses,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_packing": packing.op4_packing,
    "op7_lm_scores": lm.op7_lm_scores,
    "op8_neighbours": ann.op8_neighbours,
    "op9_id_files": idfile.op9_id_files,
    "op5_simhash_dedup": simhash.op5_simhash_dedup,
    "op6_decontamination": decontam.op6_decontamination,
    "op11_hard_negatives": rtree.op11_hard_negatives,
    "op12_merkle_manifest": merkle.op12_merkle_manifest,
    "op13_secrets": secrets.op13_secrets,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {"op2_licenses": licenses.oracle(), "op11_hard_negatives": rtree.oracle(), "op12_merkle_manifest": merkle.oracle()}
