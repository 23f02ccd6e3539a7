"""Imports every module that registers queries."""

from __future__ import annotations

from importlib import import_module

MODULES = ("leads_queries", "profile_queries", "join_queries", "series_queries", "market_queries", "text_queries", "model_queries", "file_queries")


def load() -> None:
    for name in MODULES:
        import_module(f"{__package__}.{name}")
