"""The queries of this subpackage and the SQL that they must equal."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import strata
from strata.llm import (
    decontamination,
    filter_audit,
    jaccard,
    line_spread,
    mixing,
    periodic_runs,
    quality,
    secret_ledger,
    sharding,
    substrings,
    surrogates,
    top_k_search,
    toxicity,
)


def importable(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Python workers look for this package where the driver found it, besides their own path."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(strata.__file__).parents[1]))
        return query(spark, sf_dir)

    return run


QUERIES = {
    "op1_decontamination": decontamination.op1,
    "op2_surrogates": surrogates.op2,
    "op3_line_spread": line_spread.op3,
    "op4_jaccard_join": jaccard.op4,
    "op5_quality_rules": quality.op5,
    "op6_secret_ledger": secret_ledger.op6,
    "op7_mixing": mixing.op7,
    "op8_substrings": substrings.op8,
    "op9_toxicity": toxicity.op9,
    "op10_sharding": sharding.op10,
    "op11_top_k_search": top_k_search.op11,
    "op12_periodic_runs": periodic_runs.op12,
    "op13_filter_audit": filter_audit.op13,
}
QUERIES = {name: importable(query) for name, query in QUERIES.items()}

ORACLES = {
    "op1_decontamination": decontamination.ORACLE,
    "op3_line_spread": line_spread.ORACLE,
    "op4_jaccard_join": jaccard.ORACLE,
    "op6_secret_ledger": secret_ledger.ORACLE,
    "op8_substrings": substrings.ORACLE,
    "op11_top_k_search": top_k_search.ORACLE,
    "op13_filter_audit": filter_audit.ORACLE,
}
