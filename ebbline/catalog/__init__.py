"""All registered queries."""

from __future__ import annotations

from importlib import import_module

from ebbline.catalog.registry import ORACLES, QUERIES, Query

_MODULES = ["profile_queries", "prepare_queries", "table_queries", "evaluate_queries", "model_queries"]


def _load() -> None:
    for module in _MODULES:
        import_module(f"ebbline.catalog.{module}")


def all_queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    _load()
    return dict(ORACLES)
