"""Collects every query module into the registry."""

from __future__ import annotations

import importlib

from scoreloom.plans.registry import ORACLES, QUERIES

MODULES = ("q_features", "q_rollups", "q_state", "q_tables", "q_streaming")

for _module in MODULES:
    importlib.import_module(f"scoreloom.plans.{_module}")

__all__ = ["ORACLES", "QUERIES"]
