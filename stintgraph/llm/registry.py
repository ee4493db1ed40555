"""Queries of the training-data operators, with SQL where SQL expresses them."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from types import ModuleType

from pyspark.sql import DataFrame, SparkSession

#: Modules that register queries: each has QUERIES and ORACLE_SQL.
MODULES = ["url_filter", "warc", "packing", "sharding", "topk_search", "sentence_pieces", "suffix_dedup", "jaccard_join", "license_scan", "quality_rules"]


def _modules() -> list[ModuleType]:
    return [importlib.import_module(f"stintgraph.llm.{m}") for m in MODULES]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for m in _modules() for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in _modules() for k, s in m.ORACLE_SQL.items()}
