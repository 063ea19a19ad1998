"""The queries of the subpackage, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path
import importlib

from pyspark.sql import DataFrame, SparkSession

_MODULES = {
    "op8_mixing": "mixing",
    "op4_secrets": "secrets",
    "op7_html": "html",
    "op6_fingerprints": "fingerprints",
    "op3_quality": "quality",
    "op1_toxicity": "toxicity",
    "op2_simhash": "simhash",
    "op10_decontamination": "decontamination",
    "op5_wavelet": "wavelet",
    "op9_packing": "packing",
    "op11_runs": "runs",
    "op12_merkle": "merkle",
    "op13_chat": "chat",
}

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        name: getattr(importlib.import_module(f"claimstar.llm.{module}"), name)
        for name, module in _MODULES.items()
    }


def oracle_sql() -> dict[str, str]:
    return {}
