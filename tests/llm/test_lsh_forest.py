from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wheelhouse.llm import lsh_forest as forest
from wheelhouse.llm.components import components


def shingles(text: str | None, size: int) -> frozenset:
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return frozenset()
    width = min(size, len(words))
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute(rows: list[tuple[int, str | None]], size: int = 4, percent: int = 80) -> dict[int, int]:
    sets = [(doc, shingles(text, size)) for doc, text in rows]
    parent = {doc: doc for doc, _ in rows}

    def root(doc):
        while parent[doc] != doc:
            doc = parent[doc]
        return doc

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {doc: root(doc) for doc, _ in rows}


def groups(spark, rows, size=4, percent=80):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = forest.near_duplicates(docs, size=size, percent=percent).collect()
    assert len(got) == len(rows)
    for row in got:
        assert row.n_shingles in {len(shingles(t, size)) for d, t in rows if d == row.doc_id}
        assert row.kept == (row.doc_id == row.component_id)
    return {row.doc_id: row.component_id for row in got}


def _varied(rng, words, changes):
    out = list(words)
    for place in rng.sample(range(len(out)), changes):
        out[place] = f"w{rng.randrange(10**6)}"
    return " ".join(out)


def test_small_cases(spark):
    rows = [
        (5, "A b C d e f"), (3, "a B c\td  e\nf"), (9, None), (8, ""), (7, " \n"), (2, "one two"), (11, "ONE\x0btwo"), (12, "two one"), (1, "É one two"), (4, "é one two"),
        (20, "x " * 40000), (21, "x y " * 40000), (22, "y x " * 40000),
    ]
    assert groups(spark, rows) == brute(rows)


def test_near_copies_and_borders_equal_brute_force(spark):
    rng = random.Random(6)
    rows = []
    for _ in range(12):
        words = [f"v{rng.randrange(3000)}" for _ in range(rng.randint(30, 160))]
        for _ in range(rng.randint(1, 9)):
            rows.append((len(rows), _varied(rng, words, rng.randint(0, max(1, len(words) // 20)))))
    # A passage that many otherwise different documents share.
    shared = [f"s{i}" for i in range(60)]
    rows += [(len(rows) + i, " ".join(shared + [f"o{rng.randrange(10**6)}" for _ in range(rng.randint(5, 60))])) for i in range(80)]
    rng.shuffle(rows)
    assert groups(spark, rows) == brute(rows)


def test_large_group_is_divided_and_stays_one(spark):
    rng = random.Random(7)
    words = [f"v{i}" for i in range(200)]
    rows = [(i, _varied(rng, words, rng.randint(1, 3))) for i in range(600)]
    assert groups(spark, rows) == brute(rows)


def test_star_of_copies_that_are_unlike_each_other(spark):
    rng = random.Random(8)
    words = [f"v{i}" for i in range(200)]
    # Four changes far from each other: 183 or so of 197 shingles stay, J to the original about 0.85, among copies about 0.73.
    rows = [(0, " ".join(words))]
    for i in range(1, 1001):
        copy = list(words)
        for k in range(4):
            copy[50 * k + rng.randrange(4, 46)] = f"w{i}x{k}"
        rows.append((i, " ".join(copy)))
    want = brute(rows)
    assert len(set(want.values())) == 1
    assert groups(spark, rows) == want


@pytest.mark.parametrize("block", [500, 7])
def test_rare_shingles_find_every_link(spark, monkeypatch, block):
    monkeypatch.setattr(forest, "BLOCK_NODES", block)
    rng = random.Random(9)
    rows = [(0, "one"), (1, "one"), (2, "one two three four five"), (3, "one two three four five six")]
    for _ in range(6):
        words = [f"v{rng.randrange(300)}" for _ in range(rng.randint(10, 90))]
        rows += [(len(rows) + i, _varied(rng, words, rng.randint(0, 4))) for i in range(20)]
    sets = {doc: shingles(text, 4) for doc, text in rows}
    want = {(a, b) for a, x in sets.items() for b, y in sets.items() if a < b and 100 * len(x & y) >= 80 * len(x | y)}
    texts = spark.createDataFrame(rows, "node long, text string")
    nodes = texts.selectExpr("node", "node as origin", "node as component")
    full = forest.node_sets(nodes.select("node"), texts, 4).cache()
    got = {(r.a, r.b) for r in forest.rare_pairs(nodes, full, 80).collect()}
    assert want <= got and len(got) < len(rows) ** 2 // 4
    assert {(r.a, r.b) for r in forest.confirm(spark.createDataFrame(sorted(got), "a long, b long"), full, 80).collect()} == want


def test_chain_of_links(spark):
    words = [f"c{i}" for i in range(400)]
    rows = [(1000 - i, " ".join(words[i * 4 : i * 4 + 80])) for i in range(60)]
    assert groups(spark, rows) == brute(rows) and len(set(brute(rows).values())) == 1


def test_nulls_repeated_ids_and_clashing_columns(spark):
    rows = [(None, "a b c d e", 1), (1, "a b c d e", 2), (1, "a b c d e", 3), (2, "a b c d e", 4), (3, "z", 5), (3, "q", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    got = sorted((tuple(r) for r in forest.near_duplicates(docs, size=4).collect()), key=str)
    assert [r for r in got if r[0] == 1] == [(1, 2, 1, True)] * 2 and (2, 2, 1, False) in got and (None, 2, 1, True) in got
    left = forest.without_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id) == [1, 3, 3]  # the two texts of one document stay
    assert forest.near_duplicates(docs.limit(0)).count() == 0 and forest.without_copies(docs.limit(0)).count() == 0


@pytest.mark.parametrize("held", [50_000, 30])
def test_scan_in_small_batches_finds_the_same(spark, monkeypatch, held):
    rng = np.random.RandomState(1)
    base = rng.randint(0, 2**32, forest.HASHES, dtype=np.uint64).astype(np.uint32)
    keys = sorted(forest.tree_keys(np.where(rng.rand(forest.HASHES) < 0.9, base, i).astype(np.uint32))[0] for i in range(300))
    nodes, matrix = np.arange(300), forest._matrix(keys)
    pairs = forest.neighbours(matrix, nodes, 0, 300)
    same = (matrix[1:, : forest.BASE_BYTES] == matrix[:-1, : forest.BASE_BYTES]).all(axis=1)
    assert {(i, i + 1) for i in np.flatnonzero(same)} <= {tuple(p) for p in pairs.tolist()}


def test_components(spark):
    links = [(1, 2), (2, 3), (5, 4), (4, 4), (9, 8), (8, 7), (7, 9), (None, 1), (3, 1), (1, 2)] + [(i, i + 1) for i in range(100, 160)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 7: 7, 8: 7, 9: 7} | {i: 100 for i in range(100, 161)}
    assert components(df.limit(0)).count() == 0


def test_parity_never_says_more_than_differs(spark):
    """The bits that differ are at most the shingles in one set alone, also between sets of different lengths."""
    rng = np.random.RandomState(2)
    rows = []
    for size in (1, 3, 60, 64, 65, 100, 500, 520, 3000, 20_000):
        one = np.unique(rng.randint(0, 1 << 62, size).astype(np.uint64))
        for kept in (1.0, 0.95, 0.8, 0.3):
            other = np.unique(np.concatenate([one[: int(kept * len(one))], rng.randint(0, 1 << 62, max(1, size // 9)).astype(np.uint64)]))
            for x, y in ((one, other), (other, one)):
                rows.append((forest.parity_of(x).tolist(), forest.parity_of(y).tolist(), len(np.setxor1d(x, y)), max(len(x), len(y))))
    table = spark.createDataFrame(rows, "x array<long>, y array<long>, differing long, n long")
    got = table.select(forest._parity_gap("x", "y").alias("gap"), "differing", "n", F.size("x").alias("words")).collect()
    assert all(r.gap <= r.differing for r in got)
    assert all(r.gap >= 0.3 * r.differing - 2 for r in got if r.differing <= 16 * r.words)


def test_alike_but_unlinked_texts_stay_apart(spark):
    """Two hundred texts that share two thirds of their words in place: none is similar enough, and few pairs are compared."""
    rng = random.Random(12)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(200):
        words = list(base)
        for place in range(0, 300, 12):
            words[place + rng.randrange(4)] = f"own{i}x{place}"
        rows.append((i, " ".join(words)))
    assert groups(spark, rows) == brute(rows)
    texts = spark.createDataFrame(rows, "node long, text string")
    full = forest.node_sets(texts.select("node"), texts, 4).cache()
    pairs = forest.rare_pairs(texts.selectExpr("node", "node as origin", "node as component"), full, 80)
    assert pairs.count() < 200


def test_texts_of_one_id_are_all_kept(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g"), (1, "quite another text altogether here"), (1, "a b c d e f g"), (2, "a b c d e f g"), (None, "x")], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.text) for r in forest.without_copies(docs).collect()) == [("1", "a b c d e f g"), ("1", "quite another text altogether here"), ("None", "x")]
