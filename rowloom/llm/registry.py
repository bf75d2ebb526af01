"""The queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Query name to module.
MODULES = {
    "op1_mixing": "mixing",
    "op2_chunk_dedup": "chunk_dedup",
    "op3_token_counts": "token_counts",
    "op4_simhash": "simhash",
    "op5_decontamination": "decontamination",
    "op6_quality_rules": "quality_rules",
    "op7_chat": "chat",
    "op8_pii": "pii",
    "op9_suffix_dedup": "suffix_dedup",
    "op10_quality_classifier": "quality_classifier",
    "op11_vector_codes": "vector_codes",
    "op12_phrases": "phrases",
    "op13_token_files": "token_files",
}


def _pipeline():
    import corpus_pipeline

    return corpus_pipeline


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: importlib.import_module(f"rowloom.llm.{module}").query for name, module in MODULES.items()}
    return {**found, "pipeline": _pipeline().run}


def oracle_sql() -> dict[str, str]:
    found = {name: importlib.import_module(f"rowloom.llm.{module}").ORACLE_SQL for name, module in MODULES.items()}
    return {name: sql for name, sql in {**found, "pipeline": _pipeline().ORACLE_SQL}.items() if sql}
