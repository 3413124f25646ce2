"""Registered queries of the library's own operators, by module."""

from __future__ import annotations

from collections.abc import Callable

from docweave.plans import corpus, language, layout, places, rules, storage, streams

MODULES = (corpus, language, rules, layout, storage, places, streams)


def queries() -> dict[str, Callable]:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
