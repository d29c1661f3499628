"""Named queries over the test tables, each with an equivalent SQL statement."""

from wheelhouse.catalog import changes, expressions, files, marts, relational, streams  # noqa: F401
from wheelhouse.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
