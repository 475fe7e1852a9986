"""Named queries over the test tables, with SQL oracles."""

from __future__ import annotations

from importlib import import_module

MODULES = ("features", "dimensions", "matrix", "scoring")


def load():
    """Import every query module and return the registry."""
    from ledgerlens.catalog.registry import REGISTRY
    for name in MODULES:
        import_module(f"ledgerlens.catalog.{name}")
    return REGISTRY
