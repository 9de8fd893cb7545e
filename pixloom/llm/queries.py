"""Queries of the training-data operators."""

from __future__ import annotations

import importlib

MODULES = ("canonical", "defects", "leak", "packing", "reservoir", "signature_tree", "subjects", "tokens")

QUERIES: dict = {}
ORACLES: dict = {}
for _name in MODULES:
    _part = importlib.import_module(f"pixloom.llm.{_name}")
    QUERIES.update(_part.QUERIES)
    ORACLES.update(_part.ORACLES)
