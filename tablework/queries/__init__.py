"""Registered queries: one per operator, each over whole tables."""

from __future__ import annotations

import importlib

from tablework.queries.registered import ORACLES, QUERIES

for _module in ("orders", "catalog", "registry", "nexus", "vectors"):
    importlib.import_module(f"tablework.queries.{_module}")

__all__ = ["ORACLES", "QUERIES"]
