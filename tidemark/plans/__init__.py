"""Registered queries over the driver tables, one module per inventory section."""

from __future__ import annotations

import importlib
import pkgutil


def load_queries():
    """Import every query module and return the registry."""
    from tidemark.plans.registry import QUERIES

    for module in pkgutil.iter_modules(__path__):
        if module.name.endswith("_queries"):
            importlib.import_module(f"{__name__}.{module.name}")
    return QUERIES
