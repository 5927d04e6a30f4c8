"""Queries of this subpackage and the SQL of those that SQL can state."""

from __future__ import annotations

import importlib

#: query name -> module of this subpackage that holds it
MODULES = {
    "op7_language": "langid",
    "op8_nearest": "ann",
    "op9_byte_bpe": "bpe",
    "op10_top_documents": "bm25",
    "op1_toxicity": "toxicity",
    "op2_main_text": "template",
    "op3_language_model": "language_model",
    "op4_simhash": "simhash",
    "op5_url_rules": "url_rules",
    "op6_mix_sources": "mixing",
    "op11_pack": "packing",
    "op12_lexical": "lexical",
    "op13_resample": "resampling",
}


def _module(name: str):
    return importlib.import_module(f"ticketloom.llm.{MODULES[name]}")


def queries() -> dict:
    return {name: getattr(_module(name), name) for name in MODULES}


def oracle_sql() -> dict[str, str]:
    return {name: _module(name).ORACLE for name in MODULES if hasattr(_module(name), "ORACLE")}
