"""Near-duplicate documents by an LSH forest: several sorted orders of MinHash signatures.

Every document has a set of hashed word shingles.  Equal sets are one node.  A node stands in each tree of the forest
under a key: the tree's MinHash values one after the other.  The keys of all trees are sorted together, in ranges, and
the nodes that share the longest prefixes are neighbours.  A region is a run of nodes that agree in the first
:data:`BASE_DEPTH` values; a small region gives all its pairs as candidates, a larger one is divided at the next value,
and so on, each as deep as its own density asks for, while the nodes on both sides of a division stay candidates.
Where ranges meet, the rows on both sides are looked at once more.

Candidates are confirmed on the full sets.  First each node with its best candidate; then, of the other candidates,
those whose ends are not yet connected.  Connected components give the groups.

Regions that were divided, or that reach over the end of a range, are then completed, as far as their nodes are not yet
connected.  First the node that shares most regions with others, such as the original of many copies, is compared with
all of its region, as long as that connects many.  What is left goes through an exact join: documents that are similar
enough share one of their rarest shingles.  The nodes of a frequent shingle are compared block by block.

Two documents with a similarity of 0.8 share a region in none of the 24 trees with a probability of 3e-6; those that
share one are found.  Shingles are compared by 64-bit hashes.

The key is an integer.  A null or empty text has no shingles and is linked with nothing.  Rows that share a doc_id are one
document, with all of their texts; a row without one is kept and belongs to no group.  Repeated rows are copies.  Columns named like the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wheelhouse.llm.batches import texts_of, with_batches
from wheelhouse.llm.components import components
from wheelhouse.llm.scratch import written
from wheelhouse.llm.shipping import ship

TREES = 24
BASE_DEPTH = 4
MORE_DEPTH = 8
SMALL = 12  # nodes of a region that are all compared with each other
BASE_BYTES = 1 + 4 * BASE_DEPTH
KEY_BYTES = BASE_BYTES + 2 * MORE_DEPTH
HELD_ROWS = 50_000
MOST_BITS = 16384  # of a set's parity; longer sets are told apart less sharply before they are compared
BLOCK_NODES = 500  # nodes of one frequent shingle that a row is joined with at a time
HASHES = TREES * BASE_DEPTH
_CHUNK = 1 << 14

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xBF58476D1CE4E5B9)
_seeds = np.random.RandomState(4).randint(0, 1 << 62, size=(2, HASHES)).astype(np.uint64)
_XORS, _FACTORS = _seeds[0], _seeds[1] | np.uint64(1)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


class Shingler:
    """Sorted distinct shingle hashes of texts; words met before are remembered."""

    def __init__(self, size: int) -> None:
        self.size, self.words = size, _WordHashes()

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        if len(self.words) > 1_000_000:
            self.words.clear()
        hashes = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        width = min(self.size, len(words))
        count = len(words) - width + 1
        mixed = np.full(count, width, np.uint64)
        for step in range(width):
            mixed = (mixed * _MIX) ^ hashes[step : step + count]
            mixed ^= mixed >> np.uint64(29)
        mixed *= _MIX2
        return np.unique(mixed ^ (mixed >> np.uint64(32)))


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The MinHash values of a set, as 32-bit numbers; the highest number for an empty set."""
    values = np.full(HASHES, np.uint64(0xFFFFFFFF), np.uint64)
    for start in range(0, len(shingles), _CHUNK):
        part = shingles[start : start + _CHUNK, None] ^ _XORS[None, :]
        part *= _FACTORS[None, :]
        np.minimum(values, part.min(axis=0) >> np.uint64(32), out=values)
    return values.astype(np.uint32)


def tree_keys(values: np.ndarray) -> list[bytes]:
    """The key of one node in every tree; further values of a tree are those of the trees after it."""
    big = values.astype(">u4")
    low = np.concatenate([values, values]).astype(">u2")
    return [
        bytes([tree]) + big[tree * BASE_DEPTH : (tree + 1) * BASE_DEPTH].tobytes() + low[(tree + 1) * BASE_DEPTH :][:MORE_DEPTH].tobytes()
        for tree in range(TREES)
    ]


def signatures(docs: DataFrame, text: str = "text", size: int = 4) -> DataFrame:
    """``docs`` with ``n_shingles``, ``set_key`` (equal for equal sets) and ``sketch``."""

    def prepare():
        shingler = Shingler(size)

        def work(column: pa.Array) -> list:
            sets = [shingler(body) for body in texts_of(column)]
            return [
                [len(s) for s in sets],
                [xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
                [sketch(s).tobytes() for s in sets],
            ]

        return work

    return with_batches(docs, [text], "n_shingles bigint, set_key binary, sketch binary", prepare)


def _levels(keys: np.ndarray) -> np.ndarray:
    """For rows in order, how many values each shares with the next one; 0 if not even a region."""
    differs = keys[1:] != keys[:-1]
    first = np.where(differs.any(axis=1), differs.argmax(axis=1), KEY_BYTES)
    return np.where(first < BASE_BYTES, 0, BASE_DEPTH + (first - BASE_BYTES) // 2)


def _runs(linked: np.ndarray, start: int, end: int) -> Iterator[tuple[int, int]]:
    """Runs of at least two rows from start to end in which each row is linked with the next."""
    cuts = np.flatnonzero(~linked[start : end - 1]) + start + 1
    for low, high in zip([start, *cuts.tolist()], [*cuts.tolist(), end]):
        if high - low > 1:
            yield low, high


def _pairs(levels: np.ndarray, start: int, end: int, depth: int, out: list[tuple[int, int]]) -> None:
    """Candidate pairs of rows start to end, all of which share ``depth`` values."""
    if end - start <= SMALL:
        out.extend((i, j) for i in range(start, end) for j in range(i + 1, end))
    elif depth == BASE_DEPTH + MORE_DEPTH:
        out.extend((i, j) for i in range(start, end) for j in range(i + 1, min(end, i + SMALL // 2)))
    else:
        borders = np.flatnonzero(levels[start : end - 1] == depth) + start
        out.extend((i, i + 1) for i in borders.tolist())
        for low, high in _runs(levels > depth, start, end):
            _pairs(levels, low, high, depth + 1, out)


def neighbours(keys: np.ndarray, nodes: np.ndarray, start: int, end: int) -> np.ndarray:
    """Pairs of nodes, smaller first, from rows start to end of a sorted run."""
    levels = _levels(keys)
    out: list[tuple[int, int]] = []
    for low, high in _runs(levels >= BASE_DEPTH, start, end):
        _pairs(levels, low, high, BASE_DEPTH, out)
    if not out:
        return np.empty((0, 2), np.int64)
    return np.unique(np.sort(nodes[np.array(out)], axis=1), axis=0)


def _crowded(keys: np.ndarray, first: bool, last: bool) -> np.ndarray:
    """Which rows of a sorted run stand in a region of more than SMALL rows, or in its first or last one if asked for."""
    base = keys[:, :BASE_BYTES]
    cuts = np.flatnonzero((base[1:] != base[:-1]).any(axis=1)) + 1
    sizes = np.diff(np.concatenate([[0], cuts, [len(keys)]]))
    wide = sizes > SMALL
    wide[0] |= first
    wide[-1] |= last
    return np.repeat(wide, sizes)


def _matrix(keys: Iterable[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), np.uint8).reshape(-1, KEY_BYTES)


_FOREST = "a long, b long, part int, side int, key binary, node long"


def _scan_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs within one range of the order, and its first and last rows, to be joined with the next range's.

    Rows without a pair and a part are the nodes of regions to be completed.
    """
    part = TaskContext.get().partitionId()
    first = True
    keys, nodes = np.empty((0, KEY_BYTES), np.uint8), np.empty(0, np.int64)
    head: list[tuple[bytes, int]] = []
    tail: list[tuple[bytes, int]] = []

    def made(pairs: np.ndarray) -> pa.RecordBatch:
        n = len(pairs)
        none = pa.nulls(n, pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array(pairs[:, 0], pa.int64()), pa.array(pairs[:, 1], pa.int64()), none, none, pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64())],
            names=["a", "b", "part", "side", "key", "node"],
        )

    def crowded(end: int, last: bool) -> pa.RecordBatch:
        rows = np.flatnonzero(_crowded(keys[:end], first, last))
        none, number = pa.nulls(len(rows), pa.int64()), pa.nulls(len(rows), pa.int32())
        regions = pa.array([keys[row, :BASE_BYTES].tobytes() for row in rows.tolist()], pa.binary())
        return pa.RecordBatch.from_arrays(
            [none, none, number, number, regions, pa.array(nodes[rows], pa.int64())], names=["a", "b", "part", "side", "key", "node"]
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        new_keys, new_nodes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        head += list(zip(new_keys, new_nodes))[: SMALL - len(head)]
        tail = (tail + list(zip(new_keys[-SMALL:], new_nodes[-SMALL:])))[-SMALL:]
        keys, nodes = np.concatenate([keys, _matrix(new_keys)]), np.concatenate([nodes, np.array(new_nodes, np.int64)])
        same = (keys[:, :BASE_BYTES] == keys[-1, :BASE_BYTES]).all(axis=1)
        open_from = len(keys) - int(same.sum())  # the last region may go on in the next batch
        if len(keys) - open_from > HELD_ROWS:
            yield made(neighbours(keys, nodes, 0, len(keys)))
            yield crowded(len(keys), False)
            first = False
            open_from = len(keys) - SMALL
        elif open_from:
            yield made(neighbours(keys, nodes, 0, open_from))
            yield crowded(open_from, False)
            first = False
        keys, nodes = keys[open_from:], nodes[open_from:]
    if len(keys):
        yield made(neighbours(keys, nodes, 0, len(keys)))
        yield crowded(len(keys), True)
    rows = [(None, None, part, side, key, node) for side, edge in ((0, head), (1, tail)) for key, node in edge]
    if rows:
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["a", "b", "part", "side", "key", "node"])


def _scan_border(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["key", "node"]).drop_duplicates()
    pairs = neighbours(_matrix(rows["key"]), rows["node"].to_numpy(), 0, len(rows))
    return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes, sketches = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        keys = [key for value in sketches for key in tree_keys(np.frombuffer(value, np.uint32))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(np.repeat(np.array(nodes, np.int64), TREES))], names=["key", "node"]
        )


def candidates(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For nodes (``node``, ``sketch``): (a, b, n_trees), neighbours in at least one tree, and in how many; and
    (region, node) of the regions that may have more pairs than those."""
    spark = nodes.sparkSession
    ship(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = nodes.select("node", "sketch").mapInArrow(_expand, "key binary, node long")
    ordered = keyed.repartitionByRange(parts, "key", "node").sortWithinPartitions("key", "node")
    scanned = written(ordered.mapInArrow(_scan_range, _FOREST), "forest")
    edges = scanned.where("part is not null")
    # One number per range that has rows: at most as many as there are ranges.
    used = sorted(row[0] for row in edges.select("part").distinct().collect())
    place = spark.createDataFrame([(part, i) for i, part in enumerate(used)], "part int, place int")
    border = edges.join(F.broadcast(place), "part").select((F.col("place") - 1 + F.col("side")).alias("border"), "key", "node")
    met = border.groupBy("border").applyInPandas(_scan_border, "a long, b long")
    pairs = scanned.where("a is not null").select("a", "b").union(met).where("a < b")
    crowded = scanned.where("a is null and part is null").select(F.col("key").alias("region"), "node").distinct()
    several = crowded.groupBy("region").count().where("count > 1")
    return pairs.groupBy("a", "b").agg(F.count("*").alias("n_trees")), crowded.join(several, "region", "left_semi")


def node_sets(nodes: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """(node, shingles, parity) of the given nodes; ``texts`` has (node, text).

    ``parity`` has a bit for every value of a shingle's hash, as many as the power of two at or above twice the
    number of shingles, within bounds; it tells whether an odd number of shingles has that value.
    """

    def prepare():
        shingler = Shingler(size)

        def work(column: pa.Array) -> list:
            sets = [shingler(body) for body in texts_of(column)]
            kind = pa.list_(pa.int64())
            return [pa.array([s.view(np.int64) for s in sets], kind), pa.array([parity_of(s) for s in sets], kind)]

        return work

    own = texts.join(nodes.hint("merge"), "node").withColumn("hash", F.xxhash64("text"))
    own = own.dropDuplicates(["node", "hash"]).select("node", "text")
    return with_batches(own, ["text"], "shingles array<bigint>, parity array<bigint>", prepare).drop("text")


def parity_of(shingles: np.ndarray) -> np.ndarray:
    """The parity bits of a set, in 64-bit words."""
    bits = min(max(64, 2 << max(0, len(shingles) - 1).bit_length()), MOST_BITS)
    odd = np.bincount((shingles % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _parity_gap(left: str, right: str) -> Column:
    """How many parity bits differ; never more than the shingles that only one of both sets has.

    A shingle in both sets changes no bit between them, and one in a single set changes one.  Of two lengths the longer
    one is folded to the shorter: its bits for hashes that are equal there are added up.
    """

    def folded(words: str) -> Column:
        half = (F.size(words) / 2).cast("int")
        lower, upper = F.slice(words, F.lit(1), half), F.slice(words, half + 1, half)
        return F.zip_with(lower, upper, lambda x, y: x.bitwiseXOR(y))

    a, b = F.col(left), F.col(right)
    a, b = F.when(F.size(a) > F.size(b), folded(left)).otherwise(a), F.when(F.size(b) > F.size(a), folded(right)).otherwise(b)
    differing = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(differing, F.lit(0), lambda total, n: total + F.coalesce(n, F.lit(0)))


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, ...) whose full sets have 100 * intersection >= percent * union; ``sets`` from :func:`node_sets`."""
    left, right = (sets.select(F.col("node").alias(end), F.col("shingles").alias(f"_{end}")) for end in ("a", "b"))
    both = F.size(F.array_intersect("_a", "_b"))
    linked = (both > 0) & (100 * both >= percent * (F.size("_a") + F.size("_b") - both))
    return pairs.join(left, "a").join(right, "b").where(linked).select(*pairs.columns)


def _best(pairs: DataFrame) -> DataFrame:
    """For every node the candidate found in most trees; each pair once."""
    both = pairs.select(F.col("a").alias("n"), "a", "b", "n_trees").union(pairs.select(F.col("b"), "a", "b", "n_trees"))
    best = F.max_by(F.struct("a", "b"), F.struct("n_trees", F.xxhash64("a", "b"))).alias("p")
    return both.groupBy("n").agg(best).select("p.a", "p.b").distinct()


def _unconnected(crowded: DataFrame, links: DataFrame) -> DataFrame:
    """(region, node, origin, component) of the regions whose nodes the links do not connect."""
    moved = components(links, "a_group", "b_group").toDF("origin", "component")
    rows = written(crowded.join(moved, "origin", "left").select("region", "node", "origin", F.coalesce("component", "origin").alias("component")), "regions")
    several = rows.groupBy("region").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    return written(rows.join(several, "region", "left_semi"), "open")


def _hub_pairs(rows: DataFrame, tried: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of every region's hub, the node that shares regions with most, and all others; (region, node) of the hubs."""
    sizes = rows.groupBy("region").agg(F.count("*").alias("size"))
    scores = rows.join(sizes, "region").groupBy("node").agg(F.sum("size").alias("score"))
    new = rows.join(tried, ["region", "node"], "left_anti").join(scores, "node")
    best = new.groupBy("region").agg(F.max_by(F.struct("node", "origin", "component"), F.struct("score", "node")).alias("hub"))
    best = written(best, "hubs")
    met = rows.join(best, "region").where("component != hub.component")
    swapped = F.col("node") > F.col("hub.node")
    one, other = F.struct("node", "origin"), F.struct("hub.node", "hub.origin")
    ends = met.select(F.when(swapped, other).otherwise(one).alias("x"), F.when(swapped, one).otherwise(other).alias("y"))
    pairs = ends.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"), F.col("x.origin").alias("a_group"), F.col("y.origin").alias("b_group"))
    return pairs.distinct(), best.select("region", "hub.node")


def rare_pairs(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, a_group, b_group) of all nodes (node, origin, component) that can be linked but are not connected.

    Sets that are similar enough have a member in common among the first ``n - ceil(n * percent / 100) + 1`` of each, in
    any order of all shingles; here from rare to frequent.  A pair goes on only if its parity bits leave it possible
    that the sets are similar enough: with t = percent / 100, sets of x and y shingles that are linked differ in at
    most (x + y) * (1 - t) / (1 + t) of them.  No linked pair is lost by either.
    """

    sets = written(nodes.join(sets, "node"), "shingles")
    members = sets.select("node", F.explode("shingles").alias("shingle"))
    often = members.groupBy("shingle").agg(F.count("*").alias("times")).where("times > 1")
    shared = members.join(often, "shingle").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("times", "shingle"))).alias("shared"))
    n = F.size("shingles")
    # Shingles of one node alone are the rarest; they take places but find nothing.
    places = n - F.floor((n * percent + 99) / 100).cast("int") + 1 - (n - F.size("shared"))
    heads = sets.join(shared, "node").where(places > 0).select("node", "origin", "component", n.alias("n"), "parity", F.explode(F.slice("shared", 1, places)).alias("s"))
    blocks = F.ceil(F.col("s.times") / BLOCK_NODES)
    heads = heads.select("node", "origin", "component", "n", "parity", F.col("s.shingle").alias("shingle"), blocks.alias("blocks"))
    heads = written(heads.withColumn("block", F.pmod(F.xxhash64("node"), "blocks")), "heads")
    met = heads.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")
    left = met.toDF("a", "a_group", "a_component", "a_n", "a_parity", "shingle", "i", "j")
    right = met.toDF("b", "b_group", "b_component", "b_n", "b_parity", "shingle", "j", "i")
    near = (F.col("a") < F.col("b")) & (F.col("a_component") != F.col("b_component"))
    near &= 100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n")
    near &= _parity_gap("a_parity", "b_parity") * (100 + percent) <= (F.col("a_n") + F.col("b_n")) * (100 - percent)
    return left.join(right, ["shingle", "i", "j"]).where(near).select("a", "b", "a_group", "b_group").distinct()


def completed(crowded: DataFrame, links: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The links (a, b, a_group, b_group), with those that still connect nodes of one region (region, node, origin)."""

    def more(pairs: DataFrame, purpose: str) -> DataFrame:
        return written(links.unionByName(confirm(pairs, sets, percent)), purpose)

    rows = _unconnected(crowded, links)
    tried = rows.select("region", "node").limit(0)
    count, before = rows.count(), 0
    while count and (not before or 10 * count <= 9 * before):
        pairs, hubs = _hub_pairs(rows, tried)
        links, tried = more(pairs, "hub-links"), written(tried.unionByName(hubs), "tried")
        rows = _unconnected(crowded, links)
        count, before = rows.count(), count
    if count:
        links = more(rare_pairs(rows.select("node", "origin", "component").distinct(), sets, percent), "rare-links")
    return links


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """(key, n_shingles, component_id, kept) for every row of ``docs``; shingles of ``size`` words."""
    own = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    signed = written(signatures(own, "text", size).drop("text"), "signatures")
    sets = signed.where("id is not null and n_shingles > 0").groupBy("set_key").agg(F.min("id").alias("node"), F.first("sketch").alias("sketch"))
    sets = written(sets, "sets")
    pairs, crowded = candidates(sets)
    pairs, crowded = written(pairs, "pairs"), written(crowded, "crowded")

    involved = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(crowded.select("node")).distinct()
    # One shuffle of the texts at any size; rows with one id and text are then dropped where they are.
    compared = written(node_sets(involved, own.withColumnRenamed("id", "node"), size), "compared")
    first = written(_best(pairs), "best")
    groups = written(components(confirm(first, compared, percent)), "groups")

    def group_of(node: str) -> Column:
        return F.coalesce(F.col(f"{node}_group"), F.col(node))

    rest = pairs.join(first, ["a", "b"], "left_anti")
    for end in ("a", "b"):
        rest = rest.join(groups.toDF(end, f"{end}_group"), end, "left")
    rest = written(rest.where(group_of("a") != group_of("b")).select("a", "b", group_of("a").alias("a_group"), group_of("b").alias("b_group")), "rest")
    later = written(confirm(rest, compared, percent), "later")
    crowded = crowded.join(groups.toDF("node", "node_group"), "node", "left").select("region", "node", group_of("node").alias("origin"))
    crowded = written(crowded, "origins")
    links = completed(crowded, later, compared, percent)
    merged = components(links, "a_group", "b_group").toDF("group", "merged")

    labels = groups.toDF("node", "group").unionByName(crowded.select("node", F.col("origin").alias("group"))).unionByName(rest.select(F.col("a").alias("node"), F.col("a_group").alias("group")).union(rest.select("b", "b_group")).distinct())
    labels = labels.distinct().join(merged, "group", "left").select("node", F.coalesce("merged", "group").alias("component"))
    labelled = sets.select("set_key", "node").join(labels, "node", "left").select("set_key", F.coalesce("component", "node").alias("component"))
    out = signed.drop("sketch").join(labelled, "set_key", "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(key), "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def without_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, columns as they came; of rows that share the kept id, those with equal texts are one."""
    kept = near_duplicates(docs, key, text, size, percent).where("kept").select(F.col(key).alias("_kept")).distinct()
    # By a shuffle on the id at any size, so that rows which share it are where one of them is chosen.
    chosen = docs.join(kept.hint("merge"), docs[key] == kept["_kept"], "left_semi").dropDuplicates([key, text])
    return chosen.unionByName(docs.where(F.col(key).isNull()))
