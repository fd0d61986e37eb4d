"""Registered queries of the document operators and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from tessera.llm.decontamination import op7_query
from tessera.llm.exact_dedup import OP1_SQL, op1_query
from tessera.llm.langid import op2_query
from tessera.llm.minhash import OP13_SQL, op13_query
from tessera.llm.packing import op8_query
from tessera.llm.pii import op10_query
from tessera.llm.planes import op3_query
from tessera.llm.prefix_trie import OP12_SQL, op12_query
from tessera.llm.quality import op9_query
from tessera.llm.secrets import op6_incremental_query, op6_query
from tessera.llm.simhash import op4_query
from tessera.llm.toxicity import op5_query
from tessera.llm.variants import OP11_SQL, op11_query


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_dedup": op1_query,
        "op2_language_id": op2_query,
        "op3_bit_planes": op3_query,
        "op4_simhash_near_dedup": op4_query,
        "op5_toxicity": op5_query,
        "op6_secret_scan": op6_query,
        "secret_scan_incremental": op6_incremental_query,
        "op7_decontamination": op7_query,
        "op8_best_fit_packing": op8_query,
        "op9_quality": op9_query,
        "op10_personal_data": op10_query,
        "op11_spelling_variants": op11_query,
        "op12_prefix_trie": op12_query,
        "op13_minhash_near_dedup": op13_query,
        "pipeline": corpus_pipeline.run,
    }


def llm_oracle() -> dict[str, str]:
    found = {"op1_exact_dedup": OP1_SQL, "op11_spelling_variants": OP11_SQL, "op12_prefix_trie": OP12_SQL, "op13_minhash_near_dedup": OP13_SQL,
             "pipeline": corpus_pipeline.ORACLE_SQL}
    return {k: v for k, v in found.items() if v is not None}
