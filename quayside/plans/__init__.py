"""Registered queries and the load, publish and dictionary jobs."""

from __future__ import annotations

import importlib
from types import ModuleType

QUERY_MODULES = ("catalog_queries", "shape_queries", "delivery_queries", "job_queries", "intake_queries", "run_queries", "publish_queries")


def load_all() -> ModuleType:
    """The registry, with every query module imported."""
    for name in QUERY_MODULES:
        importlib.import_module(f"quayside.plans.{name}")
    return importlib.import_module("quayside.plans.registry")
