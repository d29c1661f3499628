"""Operators for preparing training text, each by a method of its own; nothing outside this package imports it.

``QUERIES`` and ``ORACLES`` are loaded when they are asked for, so that tasks import only the operator they run.
"""

from __future__ import annotations

__all__ = ["ORACLES", "QUERIES"]


def __getattr__(name: str):
    if name in __all__:
        from wheelhouse.llm import queries, registry, vector_queries  # noqa: F401  both register their queries

        return getattr(registry, name)
    raise AttributeError(name)
