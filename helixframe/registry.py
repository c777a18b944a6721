"""All queries of the engine with their SQL counterparts."""

from __future__ import annotations

import importlib

# Modules of queries.
MODULES = ("relational", "biology", "domain", "annotations", "landing", "surface", "genomes", "storage", "evidence")

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
for _name in MODULES:
    _module = importlib.import_module(f"helixframe.plans.{_name}")
    QUERIES |= _module.QUERIES
    ORACLE |= _module.ORACLE
