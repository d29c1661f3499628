from __future__ import annotations

import random
from itertools import combinations

import numpy as np

from wheelhouse.llm import toxicity as tox


def test_score_is_the_sum_over_pairs():
    rng = np.random.RandomState(1)
    machine = tox.Machine(tuple(range(9)), rng.randn(9), rng.randn(9, tox.FACTORS), 0.3)
    for places in ([], [2], [0, 3, 8], list(range(9))):
        pairs = sum(float(machine.factors[a] @ machine.factors[b]) for a, b in combinations(places, 2))
        assert abs(tox.raw_score(machine, places) - (0.3 + machine.weights[places].sum() + pairs)) < 1e-9
    assert tox._sigmoid(-1000) == 0.0 and tox._sigmoid(1000) == 1.0


def _table(rng, n):
    common = [f"word{i}" for i in range(200)]
    rows = []
    for i in range(n):
        words = rng.choices(common, k=40)
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words += ["clown"] * insult + ["people"] * group
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(insult and group)))
    return rows


def test_pairs_are_learned_on_held_out_rows(spark):
    rows = _table(random.Random(2), 1200)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows[:800]], "doc_id long, label int")
    machine = tox.fit(docs, labels, max_terms=200)
    scores = {r.doc_id: r.score for r in tox.scored(docs, machine).collect()}
    right = sum((scores[i] >= 0.5) == bool(label) for i, _, label in rows[800:])
    assert right / 400 > 0.95


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, "a b", 7), (2, None, 7), (2, None, 7), (3, "", 7), (4, "x " * 90000, 7)], "doc_id long, text string, score int")
    none = spark.createDataFrame([], "doc_id long, label int")
    flat = tox.fit(docs, none)
    assert {round(r.score, 6) for r in tox.scored(docs, flat).collect()} == {0.5}
    odd = spark.createDataFrame([(1, 1), (1, 0), (2, None), (3, 5), (None, 1)], "doc_id long, label int")
    assert tox.fit(docs, odd).buckets == ()
    assert tox.scored(docs, flat).count() == 5 and tox.scored(docs.limit(0), flat).count() == 0


def test_query_on_held_out_rows(spark):
    from wheelhouse.llm import QUERIES

    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = QUERIES["op10_toxicity"](spark, folder).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    hits, said, toxic = sum(p and t for p, t in held), sum(p for p, _ in held), sum(t for _, t in held)
    assert toxic >= 10 and hits / toxic >= 0.5 and hits / said > 0.75  # few labels here; "never toxic" has no hits at all
    assert sum(p == t for p, t in held) / len(held) > 0.9
