"""Passages of benchmark items in documents, found by one Aho-Corasick automaton over normalised windows.

Normalising lower-cases A-Z and keeps the words, one space between them.  A window is ten consecutive words of an item;
an item with fewer, but not none, is one window.  The automaton holds every window with a space on either side, so
that matches begin and end at word borders, and reads the normalised text of each document once; the words of a match
are counted back to their places in the original text.

The windows are cut out, and made distinct, by Spark.  Their total length is summed before any is fetched: those of
up to :data:`BLOCK_CHARS` characters make one automaton, as all usual benchmarks do; beyond that there are several,
each of about that size, and the documents pass them one after the other with the findings so far.

A null or empty text has no words; an item without words has no window and is never found.  With an empty benchmark
no document is hit.  Repeated documents are judged each on their own; repeated items count once per item_id.
Other columns are kept; columns named like the results are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wheelhouse.llm.batches import set_aside, texts_of, with_batches

WINDOW = 10
BLOCK_CHARS = 6_000_000
GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"  # in lower-cased text
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ORIGINAL_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_NORMAL = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def normal_words(text: Column) -> Column:
    """The words of a text, as the scan sees them."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), GAP), "")


def item_windows(items: DataFrame, key: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Distinct (item, window) pairs; items without words or id have none."""
    words = items.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("item"), normal_words(F.col(text)).alias("words"))
    places = F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1)))
    each = F.transform(places, lambda i: F.array_join(F.slice(F.col("words"), i, F.lit(window)), " "))
    return words.where(F.size("words") > 0).select("item", F.explode(each).alias("window")).distinct()


def normalise(text: str) -> tuple[str, int]:
    """The text with one space before, between and after its words, and the number of words."""
    words = text.encode("utf-8", "surrogatepass").translate(_NORMAL).split()
    return (b" " + b" ".join(words) + b" ").decode("utf-8", "surrogatepass"), len(words)


class Windows:
    """The automaton over the windows of one block."""

    def __init__(self, rows: Iterable[tuple[str, str]]) -> None:
        self.items: dict[str, list[str]] = {}
        for item, window in rows:
            self.items.setdefault(window, []).append(item)
        self.automaton = ahocorasick.Automaton()
        for window in self.items:
            self.automaton.add_word(f" {window} ", window)
        if self.items:
            self.automaton.make_automaton()

    def scan(self, normal: str) -> tuple[list[tuple[int, int]], set[str]]:
        """Word ranges that matches cover (start, end), not merged, and the items found."""
        if not self.items:
            return [], set()
        found = [(end - len(window) - 1, window) for end, window in self.automaton.iter(normal)]
        if not found:
            return [], set()
        spaces = np.flatnonzero(np.frombuffer(normal.encode("utf-32-le", "surrogatepass"), np.uint32) == 32)
        starts = np.searchsorted(spaces, [start for start, _ in found])
        ranges = [(int(s), int(s) + window.count(" ") + 1) for s, (_, window) in zip(starts, found)]
        return ranges, {item for _, window in found for item in self.items[window]}


def merged(ranges: Iterable[Sequence[int]]) -> list[tuple[int, int]]:
    """The union of ranges as ascending ranges that do not touch."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(map(tuple, ranges)):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def original_spans(text: str, ranges: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character ranges of the original text for word ranges."""
    if not ranges:
        return []
    words = [match.span() for match in _ORIGINAL_WORD.finditer(text)]
    return [(words[start][0], words[end - 1][1]) for start, end in ranges]


_RANGES = "array<struct<start:bigint,end:bigint>>"
_automata: dict[int, Windows] = {}


def _windows(shared) -> Windows:
    """One automaton at a time per worker process."""
    if shared.value[0] not in _automata:
        _automata.clear()
        _automata[shared.value[0]] = Windows(shared.value[1])
    return _automata[shared.value[0]]


def _blocks(windows: DataFrame) -> Iterable[list[tuple[str, str]]]:
    """The pairs in blocks of bounded size; all items of a window are in one block."""
    size = windows.agg(F.coalesce(F.sum(F.length("window") + F.length("item")), F.lit(0))).first()[0]
    count = max(1, -(-size // BLOCK_CHARS))
    for block in range(count):
        chosen = windows if count == 1 else windows.where(F.pmod(F.xxhash64("window"), F.lit(count)) == block)
        yield sorted(tuple(row) for row in chosen.select("item", "window").collect())


def _dicts(ranges: Iterable[Sequence[int]]) -> list[dict[str, int]]:
    return [{"start": start, "end": end} for start, end in ranges]


def find_items(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``hit_items`` (ids as strings, sorted) and ``hit_spans`` (characters)."""
    context = docs.sparkSession.sparkContext
    out = docs
    for number, rows in enumerate(_blocks(item_windows(items, key, item_text, window))):
        shared = context.broadcast((hash(tuple(rows)), rows))

        def prepare(shared=shared, first=number == 0):
            windows = _windows(shared)

            def work(column: pa.Array, *before: pa.Array) -> list:
                counts, ranges, names, spans = [], [], [], []
                earlier = [c.to_pylist() for c in before]
                for i, body in enumerate(texts_of(column)):
                    normal, n_words = normalise(body)
                    found, items_found = windows.scan(normal)
                    if earlier:
                        found += [(r["start"], r["end"]) for r in earlier[0][i]]
                        items_found |= set(earlier[1][i])
                    union = merged(found)
                    counts.append(n_words)
                    ranges.append(_dicts(union))
                    names.append(sorted(items_found))
                    spans.append(_dicts(original_spans(body, union)))
                return [counts, ranges, names, spans]

            return work

        inputs = [text] if number == 0 else [text, "hit_words", "hit_items"]
        out = with_batches(out, inputs, f"n_words bigint, hit_words {_RANGES}, hit_items array<string>, hit_spans {_RANGES}", prepare)
    total = F.aggregate("hit_words", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return out.withColumn("n_hit", total).drop("hit_words")


def clean_documents(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The documents without any window of an item, columns as they came."""
    own, restore = set_aside(docs, ("n_words", "n_hit", "hit_words", "hit_items", "hit_spans"))
    return restore(find_items(own, items, text).where(F.col("n_hit") == 0))
