"""Registered queries over the star-schema tables, each with an equivalent SQL text."""

from __future__ import annotations

from importlib import import_module

from .registry import CHECKS, Check

MODULES = ["analyses", "sources", "columns", "rows", "text", "deliveries", "publishing", "layout"]


def all_checks() -> dict[str, Check]:
    for name in MODULES:
        import_module(f"{__name__}.{name}")
    return dict(CHECKS)
