"""Queries of this subpackage and their SQL, for the driver's entry module."""

from __future__ import annotations

import importlib

# Modules in the order of their operators.
MODULES = ("pii", "packing", "near_dedup", "line_dedup", "mixing", "token_matrix", "sharding", "quality", "classifier", "fingerprints", "substrings", "merkle", "divergence")

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
for _name in MODULES:
    _module = importlib.import_module(f"helixframe.llm.{_name}")
    QUERIES |= _module.QUERIES
    ORACLE |= getattr(_module, "ORACLE", {})
