"""Property-graph files: two JSON-lines datasets that a graph loader reads."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wheelhouse.sinks.files import write_json


def write_graph(nodes: DataFrame, relationships: DataFrame, path: str) -> dict[str, str]:
    targets = {"nodes": f"{path}/nodes", "relationships": f"{path}/relationships"}
    write_json(nodes, targets["nodes"])
    write_json(relationships, targets["relationships"])
    return targets
