"""Nearest vectors by inner product, from a neighbour graph that NN-descent builds and greedy search walks.

**Graph.**  Equal vectors are one node.  Vectors are divided by the largest norm and get one more component that
brings all of them to length one, so that the largest inner product with a query is the least distance.  For the graph
and the walk, components are kept as bytes with one factor for each vector; results are scored on the original vectors.

The first neighbours come from blocks: hyperplanes through the medians of random projections cut the nodes into cells,
in several ways; a cell with more than :data:`BLOCK` nodes is dealt out over several blocks, and the nodes of a block are
compared with each other.  Then every round joins neighbours of neighbours: at each node, its neighbours and the nodes
that have it as a neighbour meet its neighbours.  Pairs that an earlier round has compared, as both edges are old, are
left out, and a pair is passed on only where it is better than the worst neighbour of one end.  A node that is a
neighbour of very many is met by them in several groups.  The rounds end when few edges are new, or after
:data:`ROUNDS`.  Each node then gets, besides its own neighbours, the best of those that have it as a neighbour.

**Search.**  A query walks from its own node, and from :data:`ENTRIES` nodes of the largest norms, to neighbours of the
best :data:`BEAM` nodes found so far, until all of those have been visited.  One round visits all open nodes of all
queries in one join.  The best :data:`RESCORED` are scored in double precision, correctly rounded.

The degree, the beam and the rounds are the parameters of an approximate index: every row is in it, and recall is
measured in tests and in the README.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows without a key.  Shorter
vectors go on with zeros.  Rows equal in key and vector are one; with several vectors under one key, each is a candidate
and a query of its own, and none of them a candidate for that key.  An empty table, or a single row, gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wheelhouse.llm.batches import slices, with_batches
from wheelhouse.llm.scratch import written
from wheelhouse.llm.shipping import ship
from wheelhouse.llm.vectors import binaries, dense, finite, lists, runs
from wheelhouse.operators.joins import sized

DEGREE = 20
BLOCK = 4096
CUTS = 4
ROUNDS = 3
NEW_SHARE = 0.02  # of all edges; with fewer new ones, the rounds end
BEAM = 256
ENTRIES = 32
RESCORED = 128
MEETING = 2000  # nodes that meet one node's neighbours in one group
BROADCAST_BYTES = 16 << 20  # of a round's open nodes; beyond, they are joined by a shuffle

_EDGE = "v bigint, w bigint, score float"


def pack(rows: np.ndarray) -> np.ndarray:
    """Each row as its factor (4 bytes) and one signed byte for each component."""
    top = np.abs(rows).max(axis=1, keepdims=True, initial=0.0)
    factor = np.where(top > 0, top / 127, 1.0)
    whole = np.rint(rows / factor).astype(np.int8)
    return np.hstack([factor.astype("<f4").view(np.uint8), whole.view(np.uint8)])


def unpack(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Components as whole floats, and factors; products of up to a thousand components are exact."""
    return np.ascontiguousarray(codes[:, 4:]).view(np.int8).astype(np.float32), np.ascontiguousarray(codes[:, :4]).view("<f4")[:, 0]


def _code_column(rows: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in pack(rows)], pa.binary())


def _unit(rows: np.ndarray, largest: float) -> np.ndarray:
    """Rows over the largest norm, with the component that brings them to length one."""
    rows = rows / largest
    rest = np.sqrt(np.maximum(0.0, 1.0 - (rows**2).sum(axis=1)))
    return np.hstack([rows, rest[:, None]])


def _top(edges: DataFrame, degree: int) -> DataFrame:
    """The best ``degree`` edges of every node; ``edges`` may repeat (v, w).  An edge is new if all its copies are."""
    one = edges.groupBy("v", "w").agg(F.max("score").alias("score"), F.min("new").alias("new"))
    place = F.row_number().over(Window.partitionBy("v").orderBy(F.desc("score"), "w"))
    return one.withColumn("place", place).where(F.col("place") <= degree).drop("place")


def nodes_of(points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, low, vector, norm), one for each different vector, and (node, id) of all points (id, vector)."""
    classes = points.groupBy("vector").agg(F.min("id").alias("low")).sortWithinPartitions("low", "vector")
    norm = F.sqrt(F.aggregate(F.transform("vector", lambda x: x * x), F.lit(0.0), lambda a, b: a + b))
    nodes = written(classes.select(F.monotonically_increasing_id().alias("node"), "low", "vector", norm.alias("norm")), "nodes")
    members = points.join(nodes.select("node", "vector"), "vector").select("node", "id")
    return nodes, written(members, "members")


def first_edges(codes: DataFrame, width: int, count: int, degree: int) -> DataFrame:
    """(v, w, score, new): neighbours within blocks of nodes on the same sides of random hyperplanes."""
    planes = max(0, math.ceil(math.log2(max(count, 1) / BLOCK)))
    cuts = CUTS if planes else 1
    directions = np.random.RandomState(11).randn(width, max(1, cuts * planes))

    def prepare():
        def work(column: pa.Array) -> list:
            own, factor = unpack(binaries(column, width + 4))
            return [lists(((own @ directions) * factor[:, None]).astype(np.float32), pa.float32())]

        return work

    spots = with_batches(codes, ["code"], "spots array<float>", prepare)
    if planes:
        spots = written(spots, "spots")
        halves = spots.agg(*[F.percentile_approx(F.col("spots")[i], 0.5, 1000).alias(f"h{i}") for i in range(cuts * planes)]).first()

    def cell(cut: int) -> Column:
        sides = [F.when(F.col("spots")[cut * planes + i] > F.lit(halves[cut * planes + i]), F.lit(1 << i)).otherwise(F.lit(0)) for i in range(planes)]
        return sum(sides, F.lit(0)).cast("long")

    placed = spots.select("node", "code", F.posexplode(F.array(*[cell(cut) for cut in range(cuts)])).alias("cut", "cell"))
    sizes = placed.groupBy("cut", "cell").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    (sizes,) = sized(sizes)
    # Which block of a crowded cell a node falls into depends on the cut as well.
    block = F.pmod(F.xxhash64("node", "cut"), F.col("blocks"))
    blocks = placed.join(sizes, ["cut", "cell"]).select("cut", "cell", block.alias("block"), "node", "code")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, ["cut", "cell", "block"]):
            nodes = np.asarray(run.column(3))
            own, factor = unpack(binaries(run.column(4), width + 4))
            own *= factor[:, None]
            size = min(degree, len(nodes) - 1)
            for start in range(0, len(nodes) if size else 0, 1024):
                rows = np.arange(start, min(start + 1024, len(nodes)))
                scores = own[rows] @ own.T
                scores[np.arange(len(rows)), rows] = -np.inf
                best = np.argpartition(-scores, size - 1, axis=1)[:, :size]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(nodes[rows], size)),
                        pa.array(nodes[best].reshape(-1)),
                        pa.array(np.take_along_axis(scores, best, axis=1).reshape(-1).astype(np.float32)),
                    ],
                    names=["v", "w", "score"],
                )

    keys = ["cut", "cell", "block"]
    edges = blocks.repartition(*keys).sortWithinPartitions(*keys, "node").mapInArrow(compare, _EDGE)
    return _top(edges.withColumn("new", F.lit(True)), degree)


def descend(graph: DataFrame, codes: DataFrame, width: int, degree: int) -> DataFrame:
    """The graph after one round: neighbours of neighbours that are better than what a node has."""
    worst = graph.groupBy(F.col("v").alias("node")).agg(F.min("score").alias("least"), F.count("*").alias("n"))
    bound = F.when(F.col("n") >= degree, F.col("least")).otherwise(F.lit(float("-inf")).cast("float"))
    known = codes.join(worst, "node", "left").select("node", "code", F.coalesce(bound, F.lit(float("-inf")).cast("float")).alias("bound"))
    (crowded,) = sized(
        graph.groupBy(F.col("w").alias("u")).agg(F.ceil(F.count("*") / MEETING).alias("groups")).where("groups > 1")
    )
    out = graph.select(F.col("v").alias("u"), F.col("w").alias("x"), "new", F.lit(True).alias("own"))
    back = graph.select(F.col("w").alias("u"), F.col("v").alias("x"), "new", F.lit(False).alias("own"))
    ends = out.union(back).join(crowded, "u", "left").withColumn("groups", F.coalesce("groups", F.lit(1).cast("long")))
    every = F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)
    ends = ends.withColumn("part", F.explode(F.when(F.col("own"), every).otherwise(F.array(F.pmod(F.xxhash64("x"), F.col("groups"))))))
    met = ends.drop("groups").join(known, F.col("x") == F.col("node")).select("u", "part", "own", "x", "new", "bound", "code")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        held = 0
        for run in runs(batches, ["u", "part"]):
            nodes, new, bound = (np.asarray(run.column(i).to_numpy(zero_copy_only=False)) for i in (3, 4, 5))
            near = int(run.column(2).to_numpy(zero_copy_only=False).sum())  # the node's own neighbours come first
            if not near or not (new[:near].any() or new.any()):
                continue
            whole, factor = unpack(binaries(run.column(6), width + 4))
            scores = (whole @ whole[:near].T) * (factor[:, None] * factor[None, :near])
            fresh = (new[:, None] | new[None, :near]) & (nodes[:, None] != nodes[None, :near])
            row, col = np.nonzero(fresh & (scores > bound[:, None]))
            made.append((nodes[row], nodes[col], scores[row, col]))
            row, col = np.nonzero(fresh[near:] & (scores[near:] > bound[None, :near]))
            made.append((nodes[col], nodes[near + row], scores[near + row, col]))
            held += len(made[-1][0]) + len(made[-2][0])
            if held > 100_000:
                yield _edges(made)
                made, held = [], 0
        if held:
            yield _edges(made)

    ship(graph.sparkSession)
    found = met.repartition("u", "part").sortWithinPartitions("u", "part", F.desc("own"), "x").mapInArrow(meet, _EDGE)
    return _top(graph.withColumn("new", F.lit(False)).unionByName(found.withColumn("new", F.lit(True))), degree)


def _edges(made: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    v, w, score = (np.concatenate(part) for part in zip(*made))
    # A pair that several nodes of this task have in common goes out once.
    order = np.lexsort((w, v))
    v, w, score = v[order], w[order], score[order]
    first = np.ones(len(v), bool)
    first[1:] = (v[1:] != v[:-1]) | (w[1:] != w[:-1])
    return pa.RecordBatch.from_arrays([pa.array(v[first]), pa.array(w[first]), pa.array(score[first].astype(np.float32))], names=["v", "w", "score"])


def neighbour_graph(codes: DataFrame, width: int, count: int, degree: int = DEGREE, rounds: int = ROUNDS) -> DataFrame:
    """(v, w, score, new): up to ``degree`` near nodes of every node (``node``, ``code``)."""
    graph = written(first_edges(codes, width, count, degree), "graph")
    if count <= BLOCK:
        return graph  # one block: all nodes were compared with each other
    for _ in range(rounds):
        graph = written(descend(graph, codes, width, degree), "graph")
        new, edges = graph.agg(F.count_if("new"), F.count("*")).first()
        if new <= NEW_SHARE * edges:
            break
    return graph


def walkable(graph: DataFrame, codes: DataFrame, degree: int = DEGREE) -> DataFrame:
    """(node, near): the ids and codes of a node's neighbours, and of the best that have it as a neighbour."""
    both = graph.select("v", "w", "score", F.lit(False).alias("new")).union(graph.select("w", "v", "score", F.lit(False)))
    chosen = _top(both, 2 * degree).select("v", "w")
    joined = chosen.join(codes.withColumnRenamed("node", "w"), "w")
    return joined.groupBy(F.col("v").alias("node")).agg(F.collect_list(F.struct("w", "code")).alias("near"))


_POOL = "scores array<float>, nodes array<bigint>, visited array<boolean>"


def _pool(scores: list, nodes: list, visited: list) -> list:
    return [pa.array(scores, pa.list_(pa.float32())), pa.array(nodes, pa.list_(pa.int64())), pa.array(visited, pa.list_(pa.bool_()))]


def _merged(scores, nodes, visited, more_scores, more_nodes, beam: int) -> tuple:
    """The best of both without repetition, best first; what was visited stays so."""
    scores, nodes = np.concatenate([scores, more_scores]), np.concatenate([nodes, more_nodes])
    visited = np.concatenate([visited, np.zeros(len(more_nodes), bool)])
    _, first = np.unique(nodes, return_index=True)  # the first of equals: those already there come first
    order = first[np.lexsort((nodes[first], -scores[first]))][:beam]
    return scores[order], nodes[order], visited[order]


def walk(starts: DataFrame, near: DataFrame, entries: list, width: int, beam: int = BEAM) -> DataFrame:
    """(q, scores, nodes, visited): the best nodes for every start (``q``, a node; ``code``, what it looks for)."""
    entry_nodes = np.array([row["node"] for row in entries], np.int64)
    entry_codes = np.frombuffer(b"".join(bytes(row["code"]) for row in entries), np.uint8).reshape(-1, width + 4)

    def begin():
        whole, factor = unpack(entry_codes)

        def work(column: pa.Array, q: pa.Array) -> list:
            own, scale = unpack(binaries(column, width + 4))
            scores = (own @ whole.T) * (scale[:, None] * factor[None, :])
            # A query's own node is visited first, whatever its score.
            pools = [_merged([np.inf], [node], [False], row, entry_nodes, beam) for node, row in zip(np.asarray(q), scores)]
            return _pool(*zip(*pools)) if pools else _pool([], [], [])

        return work

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                own, scale = unpack(binaries(part.column(1), width + 4))
                reached = part.column(3)
                counts = np.asarray(reached.value_lengths(), np.int64)
                flat = reached.flatten()
                nodes = np.asarray(flat.field(0))
                whole, factor = unpack(binaries(flat.field(1), width + 4))
                row = np.repeat(np.arange(part.num_rows), counts)
                scores = np.einsum("ij,ij->i", own[row], whole) * (scale[row] * factor)
                good = scores > np.asarray(part.column(2))[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.asarray(part.column(0))[row[good]]), pa.array(nodes[good]), pa.array(scores[good].astype(np.float32))],
                    names=["q", "node", "score"],
                )

    def merge():
        def work(scores, nodes, visited, found) -> list:
            pools = []
            for s, n, more in zip(scores.to_pylist(), nodes.to_pylist(), found):
                rows = more.values if more.is_valid else None
                new = (np.asarray(rows.field(0)), np.asarray(rows.field(1))) if rows is not None else ([], [])
                pools.append(_merged(s, n, [True] * len(n), *new, beam))
            return _pool(*zip(*pools)) if pools else _pool([], [], [])

        return work

    state = written(with_batches(starts, ["code", "q"], _POOL, begin), "walk")
    full = F.size("nodes") >= beam
    bound = F.when(full, F.element_at("scores", -1)).otherwise(F.lit(float("-inf")).cast("float"))
    left = F.filter(F.arrays_zip("nodes", "visited"), lambda n: ~n["visited"])
    while True:
        waiting = state.agg(F.sum(F.size(left))).first()[0]
        if not waiting:
            return state.select("q", "scores", "nodes", "visited")
        to_visit = state.select("q", "code", bound.alias("bound"), F.explode(left).alias("n")).select("q", "code", "bound", F.col("n.nodes").alias("node"))
        if waiting * (width + 48) <= BROADCAST_BYTES:
            to_visit = F.broadcast(to_visit)
        seen = near.join(to_visit, "node").select("q", "code", "bound", "near").mapInArrow(look, "q bigint, node bigint, score float")
        found = seen.groupBy("q").agg(F.collect_list(F.struct("score", "node")).alias("found"))
        state = written(with_batches(state.join(found, "q", "left"), ["scores", "nodes", "visited", "found"], _POOL, merge).drop("found"), "walk")


def nearest(vectors: DataFrame, queries: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", beam: int = BEAM) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` rows of the largest inner product for every row with ``queries`` true.

    ``queries`` is a condition on a column named ``id``, the key.  ``beam`` should be well above ``k``.
    """
    beam = max(beam, 2 * k + 2)
    own = F.col(vector)
    points = vectors.where(F.col(key).isNotNull() & finite(own) & F.exists(own, lambda x: x != 0))
    points = points.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("vector")).distinct()
    nodes, members = nodes_of(points)
    count, size, largest = nodes.agg(F.count("*"), F.max(F.size("vector")), F.max("norm")).first()
    size, largest = size or 1, largest or 1.0
    width = size + 1

    def prepare():
        def work(column: pa.Array) -> list:
            return [_code_column(_unit(dense(column, size), largest))]

        return work

    def prepare_query():
        def work(column: pa.Array) -> list:
            rows = dense(column, size)
            rows = rows / np.abs(rows).max(axis=1, keepdims=True)
            return [_code_column(np.hstack([rows / np.sqrt((rows**2).sum(axis=1, keepdims=True)), np.zeros((len(rows), 1))]))]

        return work

    codes = written(with_batches(nodes, ["vector"], "code binary", prepare).select("node", "code"), "codes")
    near = written(walkable(neighbour_graph(codes, width, count), codes), "near")
    longest = nodes.orderBy(F.desc("norm"), "node").limit(ENTRIES).select("node")
    entries = codes.join(F.broadcast(longest), "node").orderBy("node").collect()

    asked = written(members.where(queries), "asked")
    wanted = nodes.join(asked.select("node").distinct(), "node").select(F.col("node").alias("q"), "vector")
    starts = with_batches(wanted, ["vector"], "code binary", prepare_query)
    walked = walk(starts.select("q", "code"), near, entries, width, beam)

    few = max(RESCORED, k + 1)
    chosen = walked.join(wanted, "q").select("q", F.col("vector").alias("asked"), F.explode(F.slice("nodes", 1, few)).alias("node"))

    def rescore():
        def work(left: pa.Array, right: pa.Array) -> list:
            products = dense(left, size) * dense(right, size)
            return [[math.fsum(row) for row in products.tolist()]]

        return work

    pairs = chosen.join(nodes.select("node", "low", "vector"), "node")
    scored = with_batches(pairs, ["asked", "vector"], "score double", rescore).select("q", "node", "low", "score")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "low", "node"))
    best = scored.withColumn("place", place).where(F.col("place") <= k + 1).select("q", "node", "score")
    # Of rows with one vector, k and the query itself are enough.
    early = F.row_number().over(Window.partitionBy("node").orderBy("id"))
    named = members.withColumn("early", early).where(F.col("early") <= k + 1).select("node", "id")
    rows = asked.select(F.col("node").alias("q"), F.col("id").alias("query_id")).join(best, "q").join(named, "node").where("id != query_id")
    rank = F.row_number().over(Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "id"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
