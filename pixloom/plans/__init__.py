"""Registry of named queries: each plan module offers ``QUERIES`` and, where SQL can say it, ``ORACLES``."""

from __future__ import annotations

import importlib

MODULES = ("corpus", "accuracy", "scoring", "neardups", "pipeline", "relational", "streams", "storage")


def collect(kind: str) -> dict:
    found: dict = {}
    for name in MODULES:
        part = getattr(importlib.import_module(f"pixloom.plans.{name}"), kind)
        clash = found.keys() & part.keys()
        if clash:
            raise ValueError(f"query names used twice: {sorted(clash)}")
        found.update(part)
    return found
