"""Toxic texts by a factorization machine over hashed terms.

The terms of a text are its distinct lower-cased words and the first four and five letters of longer ones, hashed to
:data:`BUCKETS`.  A factorization machine adds to the linear weights a product of learned factors for every two terms
of a text, so that a pair (an insult and the mention of a group, say) can weigh more, or less, than its parts.

Fitting uses at most ``max_rows`` labelled rows, those with the smallest hashes of their id (a bounded, documented
sample); Spark counts the terms of toxic and other rows, keeps the ``max_terms`` with the largest chi-squared statistic
and trains the machine with its own learner.  Scoring reads every whole text.

Labels other than 0 and 1, and null ones, are left out; of several labels for one id the largest holds.  Without rows of
both classes every score is the smoothed share of toxic rows.  A null or empty text has no terms and the score of the
intercept.  Repeated rows are scored alike; an empty table gives no rows.  Columns named like the results are replaced.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import FMClassifier
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wheelhouse.llm.batches import texts_of, with_batches
from wheelhouse.llm.scratch import written

BUCKETS = 1 << 22
FACTORS = 8
LEAST_ROWS = 3
PREFIXES = (4, 5)
_WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class Machine:
    """A fitted machine: weights and factors of the chosen buckets."""

    buckets: tuple[int, ...]
    weights: np.ndarray
    factors: np.ndarray
    intercept: float


def bucket(term: str) -> int:
    return xxhash.xxh32_intdigest(term) % BUCKETS


def buckets_of_word(word: str) -> list[int]:
    """The buckets of a word and of its beginnings."""
    return [bucket(word), *(bucket(word[:size] + "*") for size in PREFIXES if len(word) > size)]


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


class _Chosen(dict):
    """For a word, the places of its buckets among the chosen ones; remembers words."""

    def __init__(self, buckets: tuple[int, ...]) -> None:
        super().__init__()
        self.places = {b: i for i, b in enumerate(buckets)}

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > 500_000:
            self.clear()
        self[word] = found = tuple(self.places[b] for b in buckets_of_word(word) if b in self.places)
        return found

    def of_text(self, text: str) -> list[int]:
        return sorted({place for word in words_of(text) for place in self[word]})


def raw_score(machine: Machine, places: list[int]) -> float:
    """The intercept, the weights of the terms and the products of the factors of all pairs of terms."""
    if not places:
        return machine.intercept
    v = machine.factors[places]
    pairs = 0.5 * float((v.sum(axis=0) ** 2 - (v**2).sum(axis=0)).sum())
    return machine.intercept + float(machine.weights[places].sum()) + pairs


def _sigmoid(value: float) -> float:
    return 1 / (1 + math.exp(-value)) if value >= 0 else math.exp(value) / (1 + math.exp(value))


def training_rows(docs: DataFrame, labels: DataFrame, key: str, text: str, max_rows: int) -> DataFrame:
    """(label, buckets) of the bounded sample; only its ids are sent to the tasks that read the texts."""
    usable = labels.where(F.col("label").isin(0, 1) & F.col(key).isNotNull()).groupBy(key).agg(F.max("label").cast("double").alias("label"))
    sample = written(usable.orderBy(F.xxhash64(key), key).limit(max_rows), "labels")
    texts = docs.select(F.col(key), F.col(text).alias("text")).join(F.broadcast(sample), key)  # max_rows ids

    def prepare():
        def work(column: pa.Array) -> list:
            return [[sorted({b for word in words_of(body) for b in buckets_of_word(word)}) for body in texts_of(column)]]

        return work

    return written(with_batches(texts.select("label", "text"), ["text"], "buckets array<int>", prepare).drop("text"), "terms")


def _chi_squared(rows: DataFrame, total: int, toxic: int, max_terms: int) -> tuple[int, ...]:
    """The buckets that tell the classes apart best."""
    counts = rows.select("label", F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"), F.sum("label").alias("hits"))
    n, hits = F.col("n"), F.col("hits")
    statistic = (hits - n * toxic / total) ** 2 * F.lit(float(total)) / (n * (F.lit(float(total)) - n) + 1)
    best = counts.where(n >= LEAST_ROWS).orderBy(statistic.desc(), "bucket").limit(max_terms).select("bucket").collect()
    return tuple(sorted(row.bucket for row in best))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", max_rows: int = 20_000, max_terms: int = 2_000) -> Machine:
    """A machine for (key, label) rows of ``labels`` and the texts of ``docs``."""
    rows = training_rows(docs, labels, key, text, max_rows)
    total, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    chosen = _chi_squared(rows, total, toxic, max_terms) if 0 < toxic < total else ()
    if not chosen:
        share = (toxic + 1) / (total + 2)
        return Machine((), np.zeros(0), np.zeros((0, FACTORS)), math.log(share / (1 - share)))
    known = F.array(*[F.lit(b) for b in chosen]) if len(chosen) < 2 else F.lit(list(chosen))
    terms = rows.select("label", F.array_intersect("buckets", known).cast("array<string>").alias("terms"))
    vectors = CountVectorizerModel.from_vocabulary([str(b) for b in chosen], "terms", "features").setBinary(True).transform(terms)
    learner = FMClassifier(factorSize=FACTORS, maxIter=80, stepSize=0.05, regParam=1e-3, initStd=0.02, seed=3, solver="adamW")
    model = learner.fit(written(vectors.select("label", "features"), "vectors"))
    return Machine(chosen, model.linear.toArray(), model.factors.toArray(), float(model.intercept))


def scored(docs: DataFrame, machine: Machine, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # max_terms rows of FACTORS numbers

    def prepare():
        chosen = _Chosen(shared.value.buckets)

        def work(column: pa.Array) -> list:
            return [[_sigmoid(raw_score(shared.value, chosen.of_text(body))) for body in texts_of(column)]]

        return work

    return with_batches(docs, [text], "score double", prepare)
