"""Registered queries by topic, with the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

TOPICS = ("texts", "preferences", "encoding", "scores", "series", "stores", "streams", "callbacks", "turns", "provenance")


def _modules():
    return [import_module(f"alignlake.registry.{topic}") for topic in TOPICS]


def queries() -> dict[str, Callable]:
    return {name: run for module in _modules() for name, run in module.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for module in _modules() for name, sql in module.ORACLES.items()}
