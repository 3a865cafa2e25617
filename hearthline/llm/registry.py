"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from hearthline.llm import (
    bpe,
    chat_format,
    cotraining,
    decontamination,
    fingerprints,
    language_id,
    license_scan,
    packing,
    periodic_runs,
    resampling,
    secret_scan,
    simhash,
    token_counts,
)
from hearthline.llm.common import ship_package

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    found = (
        fingerprints.op1_imatch,
        secret_scan.op2_secret_scan,
        chat_format.op3_chat_format,
        language_id.op4_language_id,
        token_counts.op5_token_counts,
        cotraining.op6_cotraining,
        simhash.op7_simhash,
        bpe.op8_bpe,
        decontamination.op9_decontamination,
        license_scan.op10_license_scan,
        resampling.op11_importance_resampling,
        packing.op12_best_fit_packing,
        periodic_runs.op13_periodic_runs,
    )
    named = {run.__name__: run for run in found} | {"pipeline": corpus_pipeline.run}
    return {name: _ready(run) for name, run in named.items()}


def _ready(run: Query) -> Query:
    @wraps(run)
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return run(spark, sf_dir)

    return query


def oracle_sql() -> dict[str, str]:
    """The others need hashes, tokenizers, alignments or learned models that SQL lacks."""
    return {
        "op3_chat_format": chat_format.OP3_SQL,
        "op10_license_scan": license_scan.OP10_SQL,
        "op11_importance_resampling": resampling.OP11_SQL,
    }
