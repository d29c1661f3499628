"""Nearest vectors, part codes and clusters, against brute force."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wheelhouse.llm import centroids, nn_descent, part_codes, vectors

SCHEMA = "vec_id long, embedding array<float>, label int"
ODD = [
    (9001, None, 1), (9002, [], 2), (9003, [1.0, None, 2.0], 1), (9004, [float("nan"), 1.0], 1), (9005, [float("inf")], None), (9006, [float("-inf"), 0.0], None),
]


def rows_of(count, width, seed, clusters=5):
    rng = np.random.RandomState(seed)
    middles = rng.randn(clusters, width)
    found = middles[rng.randint(0, clusters, count)] + 0.6 * rng.randn(count, width)
    return [(i, [float(np.float32(x)) for x in row], int(rng.randint(0, 3)) if i % 7 else None) for i, row in enumerate(found.tolist())]


# --- the two exact searches ------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(6))
def test_equal_average_search_is_exact(seed):
    rng = np.random.RandomState(seed)
    book = rng.randint(-20, 20, (16, 4))
    book[5], book[9] = book[2], book[2]  # equal entries: the smallest index counts
    parts = rng.randint(-25, 25, (500, 4))
    index, best = part_codes.nearest_by_sum(parts, book)
    far = ((parts[:, None, :] - book[None]) ** 2).sum(2)
    assert (index == far.argmin(1)).all() and (best == far.min(1)).all()


def test_equal_average_search_looks_at_few_entries():
    """Entries far off in their sums are left out: a part near one entry does not meet the others."""
    book = np.arange(16)[:, None] * np.full((1, 8), 1000)
    index, best = part_codes.nearest_by_sum(book[[3]] + 1, book)
    assert index.tolist() == [3] and best.tolist() == [8]
    poisoned = book.copy()
    poisoned[10:] = np.iinfo(np.int32).max  # would overflow a distance if it were looked at
    with np.errstate(over="raise"):
        assert part_codes.nearest_by_sum(book[[3]] + 1, poisoned)[0].tolist() == [3]


@pytest.mark.parametrize("seed", range(6))
def test_threshold_algorithm_is_exact(seed):
    rng = np.random.RandomState(seed)
    middles = rng.randint(-9, 9, (7, 5))
    middles[4] = middles[1]
    rows = rng.randint(-12, 12, (400, 5))
    number, best = centroids.nearest_by_threshold(rows, middles)
    far = ((rows[:, None, :] - middles[None]) ** 2).sum(2)
    assert (number == far.argmin(1)).all() and (best == far.min(1)).all()


# --- part codes ------------------------------------------------------------------------------------


def brute_codes(rows, parts, entries, rounds, scale):
    kept = sorted(((i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)), key=lambda r: (r[0] is None, r[0] or 0, [math.floor(scale * x) for x in r[1]]))
    width = max([len(v) for _, v, _ in kept], default=1) or 1
    size = -(-width // parts)
    units = [[math.floor(scale * x) for x in v] + [0] * (size * parts - len(v)) for _, v, _ in kept]
    books = [[u[p * size : (p + 1) * size] for u in units[:entries]] for p in range(parts)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            own = [u[p * size : (p + 1) * size] for u in units]
            chosen = [near(x, book)[1] for x in own]
            for e in range(len(book)):
                mine = [x for x, c in zip(own, chosen) if c == e]
                if mine:
                    book[e] = [sum(column) // len(mine) for column in zip(*mine)]
    out = []
    for (i, _, lab), u in zip(kept, units):
        found = [near(u[p * size : (p + 1) * size], books[p]) for p in range(parts)]
        out.append((i, lab, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    total = {}
    for _, lab, _, error in out:
        total[lab] = total.get(lab, 0) + error
    return sorted(((i, lab, code, error, total[lab]) for i, lab, code, error in out), key=str), books


@pytest.mark.parametrize("width", [16, 13])
def test_part_codes_equal_brute_force(spark, width):
    rows = rows_of(120, width, 3) + ODD + [(7, rows_of(8, width, 4)[7][1], 2), (7, rows_of(8, width, 4)[7][1], 2), (9100, [0.5] * (width // 2), 0)]
    table = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", code string").repartition(5)
    got, books = part_codes.compressed(table, parts=4, entries=6, rounds=3)
    wanted, wanted_books = brute_codes(rows, 4, 6, 3, 4096)
    assert sorted(((r.vec_id, r.label, r.code, r.error, r.label_error) for r in got.collect()), key=str) == wanted
    assert books.tolist() == wanted_books


def test_part_codes_of_few_rows(spark):
    assert part_codes.compressed(spark.createDataFrame([], SCHEMA))[0].count() == 0
    assert part_codes.compressed(spark.createDataFrame(ODD[:1], SCHEMA))[0].count() == 0
    got, books = part_codes.compressed(spark.createDataFrame([(3, [1.0] * 8, None), (1, [2.0] * 8, None), (None, [9e9] * 8, 1)], SCHEMA))
    assert {(r.vec_id, r.code, r.error) for r in got.collect()} == {(3, "01" * 8, 0), (1, "00" * 8, 0), (None, "02" * 8, 0)}
    assert books.shape == (8, 3, 1) and books.max() == vectors.HELD


# --- clusters --------------------------------------------------------------------------------------


def brute_clusters(rows, count, rounds, scale, width, seed):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v, _ in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    middles = [u for _, u in order[:count]]

    def near(u):
        return min((sum((a - b) ** 2 for a, b in zip(u, m)), i) for i, m in enumerate(middles))

    for _ in range(rounds):
        groups = [[] for _ in middles]
        for _, u in kept:
            groups[near(u)[1]].append(u)
        middles = [[sum(c) // len(g) for c in zip(*g)] if g else m for g, m in zip(groups, middles)]
    found = [(i, *near(u)[::-1]) for i, u in kept]
    inertia = [sum(d for _, c, d in found if c == k) for k in range(len(middles))]
    return sorted((i, c, d, inertia[c], sum(inertia)) for i, c, d in found), middles


def test_clusters_equal_brute_force(spark):
    rows = rows_of(150, 6, 5) + ODD + [(3, [0.25] * 6, 1), (3, [0.25] * 6, 1), (9200, [1.0] * 5, 1), (9201, [1.0] * 7, 1)]
    table = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", cluster int").repartition(4)
    got, middles = centroids.clustered(table, count=5, rounds=4, width=6)
    wanted, wanted_middles = brute_clusters(rows, 5, 4, 1024, 6, "3")
    assert sorted((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia) for r in got.collect()) == wanted
    assert middles.tolist() == wanted_middles


def test_clusters_of_few_rows(spark):
    assert centroids.clustered(spark.createDataFrame([], SCHEMA))[0].count() == 0
    assert centroids.clustered(spark.createDataFrame(ODD, SCHEMA), width=3)[0].count() == 0
    got, middles = centroids.clustered(spark.createDataFrame([(1, [1.0], 1), (1, [1.0], 1), (None, [2.0], 1)], SCHEMA), width=1, rounds=2)
    assert sorted((str(r.vec_id), r.cluster, r.distance, r.inertia) for r in got.collect()) == [("1", 0, 0, 0), ("1", 0, 0, 0), ("None", 2, 0, 0)]
    assert len(middles) == 3


# --- nearest vectors -------------------------------------------------------------------------------


def brute_nearest(rows, k, asked):
    points = sorted({(i, tuple(v)) for i, v, _ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)})
    out = {}
    for q, v in points:
        if asked(q):
            scored = [(-math.fsum(a * b for a, b in zip(v, w)), i) for i, w in points if i != q]
            out.setdefault(q, []).append([(i, -s) for s, i in sorted(scored)[:k]])
    return out


def found_by(spark, rows, k=5, partitions=3, **options):
    table = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA + ", rank int").repartition(partitions)
    got = {}
    for r in sorted(nn_descent.nearest(table, F.col("id") % 4 == 0, k=k, **options).collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r["rank"], r.id, r.score))
    return got


def test_nearest_on_small_tables_is_exact(spark):
    """One block: all pairs are compared, with copies, several vectors under one key, zeros and other lengths."""
    rows = rows_of(90, 6, 9) + ODD + [(500 + i, [1.0, 2.0, 0.5, 0.0, 0.0, 0.0], 1) for i in range(12)] + [(600, [0.0, 0.0], 1), (604, [3.0, 1.0], 1), (None, [1.0] * 6, 1)]
    rows += [rows[8], rows[8]]
    got, wanted = found_by(spark, rows), brute_nearest(rows, 5, lambda q: q % 4 == 0)
    assert set(got) == set(wanted) and 600 not in got
    for q, (best,) in wanted.items():
        assert [(i, s) for _, i, s in got[q]] == best and [r for r, _, _ in got[q]] == [1, 2, 3, 4, 5]


def test_nearest_by_inner_product_with_unequal_norms(spark):
    rng = random.Random(4)
    rows = [(i, [x * rng.choice([0.01, 1.0, 50.0]) for x in v], None) for i, v, _ in rows_of(300, 8, 10)]
    got, wanted = found_by(spark, rows, k=10), brute_nearest(rows, 10, lambda q: q % 4 == 0)
    hits = [len({i for _, i, _ in got[q]} & {i for i, _ in best}) for q, (best,) in wanted.items()]
    assert sum(hits) >= 0.97 * 10 * len(hits)


def test_two_vectors_under_one_key_are_two_queries(spark):
    rows = [(4, [1.0, 0.0], 0), (4, [0.0, 1.0], 0), (5, [1.0, 0.1], 0), (6, [0.1, 1.0], 0)]
    table = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r["rank"], r.id, round(r.score, 3)) for r in nn_descent.nearest(table, F.col("id") == 4, k=1).collect())
    assert got == [(1, 5, 1.0), (1, 6, 1.0)]


def test_nearest_of_few_rows(spark):
    assert found_by(spark, []) == {} and found_by(spark, [(4, [1.0], 1)]) == {} and found_by(spark, ODD) == {}
    assert found_by(spark, [(4, [1.0], 1), (5, [-2.0], 1)]) == {4: [(1, 5, -2.0)]}


def test_recall_of_the_descent(spark, monkeypatch):
    """Small blocks, so that the rounds and the walk have to find what no block holds."""
    monkeypatch.setattr(nn_descent, "BLOCK", 64)
    rows = rows_of(2400, 24, 12, clusters=9)
    matrix = np.array([v for _, v, _ in rows])
    points = spark.createDataFrame(rows, SCHEMA).select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector"))
    nodes, _ = nn_descent.nodes_of(points)
    got = found_by(spark, rows, k=10, beam=48)
    hits = tries = 0
    for q, best in got.items():
        scores = matrix @ matrix[q]
        scores[q] = -np.inf
        hits += len({i for _, i, _ in best} & set(np.argsort(-scores)[:10].tolist()))
        tries += 10
    assert len(got) == 600 and hits >= 0.9 * tries


def test_rounds_improve_the_graph(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "BLOCK", 64)
    rows = rows_of(1500, 16, 13)
    unit = np.array([v for _, v, _ in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    coded = [(i, bytes(code)) for i, code in enumerate(nn_descent.pack(unit))]
    codes = spark.createDataFrame(coded, "node long, code binary").repartition(3)
    scores = unit @ unit.T
    np.fill_diagonal(scores, -1)
    best = [set(row[:8].tolist()) for row in np.argsort(-scores, axis=1)]

    def share(graph):
        return sum(r.w in best[r.v] for r in graph.collect()) / (8 * len(best))

    graph = nn_descent.first_edges(codes, 16, len(coded), 8).cache()
    before = share(graph)
    after = nn_descent.descend(graph, codes, 16, 8).cache()
    assert share(after) > before + 0.1 and share(nn_descent.descend(after, codes, 16, 8)) > 0.85
    assert after.groupBy("v").count().agg(F.max("count")).first()[0] == 8


def test_a_hub_meets_in_several_groups(spark, monkeypatch):
    """The graph of one round is the same however many groups a much-named node is divided into."""
    rows = rows_of(300, 8, 14)
    unit = np.array([v for _, v, _ in rows]) / 10
    codes = spark.createDataFrame([(i, bytes(code)) for i, code in enumerate(nn_descent.pack(unit))], "node long, code binary")
    graph = nn_descent.first_edges(codes, 8, 300, 6).cache()
    hub = graph.where("w != 5").select("v", F.when(F.col("score") >= 0, F.col("w")).otherwise(F.lit(5)).alias("w"), "score", "new").dropDuplicates(["v", "w"]).where("v != w").cache()
    whole = sorted(map(tuple, nn_descent.descend(hub, codes, 8, 6).collect()))
    monkeypatch.setattr(nn_descent, "MEETING", 3)
    assert sorted(map(tuple, nn_descent.descend(hub, codes, 8, 6).collect())) == whole


# --- helpers ---------------------------------------------------------------------------------------


def test_runs_join_batches_of_one_key():
    batches = [pa.record_batch({"a": [1, 1, 2], "b": [0, 0, 0], "x": [1, 2, 3]}), pa.record_batch({"a": [], "b": [], "x": []}, schema=pa.schema({"a": pa.int64(), "b": pa.int64(), "x": pa.int64()})), pa.record_batch({"a": [2, 2, 3], "b": [0, 1, 1], "x": [4, 5, 6]})]
    assert [run.column(2).to_pylist() for run in vectors.runs(iter(batches), ["a", "b"])] == [[1, 2], [3, 4], [5], [6]]


def test_codes_keep_inner_products():
    rows = np.random.RandomState(0).randn(50, 30)
    whole, factor = nn_descent.unpack(nn_descent.pack(rows))
    assert np.abs((whole * factor[:, None]) - rows).max() < 0.02
    assert nn_descent.unpack(nn_descent.pack(np.zeros((2, 3))))[0].tolist() == [[0, 0, 0]] * 2
