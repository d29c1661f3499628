"""Secrets in texts: known shapes, and strings that a battery of randomness tests takes for random.

Known shapes are assignments to a secret's name, access keys and long hexadecimal strings.  Every other run of at least
:data:`LEAST` key characters is a candidate, but for plain numbers.  Its encoding is inferred as the smallest alphabet that has all of its
characters, and three tests ask whether it could be a uniform draw from that alphabet: chi-squared uniformity of the
characters, number of runs above and below the middle, and serial correlation.  A fourth one weighs the draw against the
table's own way of writing: how often one character follows another is counted over all its texts, and the likelihood of
the candidate under these pairs is compared with what it would be for uniform draws.  The smallest of the four p-values,
times four, is the candidate's score: ordinary words have low scores, the lower the longer they are.

Which score is high enough is decided by length.  Candidates that look like words (small letters alone, or after a
capital) serve as decoys, with a fixed sample of long words beside those of the table: the share of decoys that reach a
score estimates the share of ordinary strings among the other candidates that do.  As every further letter of a word is
further evidence, this share is taken to fall by the same factor with each; the factor is fitted over the decoys of all
lengths.  A length class takes the share of this trend, weighed against that of its own decoys, the more the fewer it
has, so that classes with few or no decoys are judged too.  The threshold of a class is the lowest score at which
the estimated false-discovery rate is at most :data:`RATE`.  The scores of the whole table are counted in bins, so that
only a few hundred numbers reach the driver.

A null or empty text has no spans.  Texts are read whole; positions are code points, ends exclusive.  Spans of one kind
do not overlap; a random string that meets a known span is left out.  Repeated rows are judged each on their own but
all count in the statistics; an empty table gives no rows.  Columns named like the results are replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wheelhouse.llm.batches import set_aside, slices, texts_of, with_batches
from wheelhouse.llm.shipping import ship

KINDS = ("assign", "access", "hex", "random")
LEAST = 16
RATE = 0.01
BINS = 40  # of scores, ten to each power of ten
CLASS_CHARS, CLASSES = 4, 16
PRIOR = 500  # pairs after one character that the fixed words stand for
WEIGHT = 100  # decoys of its own at which a length class counts as much as the trend
REPLACEMENT = "[secret]"

_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST)
_WORD = re.compile(r"[A-Z]?[a-z]+")

# The alphabets of common encodings, in their order.
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALPHABETS = (
    ("decimal", _DIGITS),
    ("hex", _DIGITS + "abcdef"),
    ("HEX", _DIGITS + "ABCDEF"),
    ("base32", _UPPER + "234567"),
    ("base36", _DIGITS + _LOWER),
    ("BASE36", _DIGITS + _UPPER),
    ("base62", _UPPER + _LOWER + _DIGITS),
    ("base64", _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64url", _UPPER + _LOWER + _DIGITS + "-_"),
    ("any", _UPPER + _LOWER + _DIGITS + "+/-_="),
)
# Decoys of every table.
_LONG_WORDS = """
internationalisation responsibilities characteristically misunderstandings telecommunications incomprehensible
constitutionally industrialisation enthusiastically disproportionately institutionalised professionalisation
straightforwardness interdisciplinary counterproductive environmentalists superconductivity unconstitutional
uncharacteristically electromagnetism transcontinental autobiographical compartmentalise psychotherapeutic
Geschwindigkeitsbegrenzung Wissenschaftlerinnen Verantwortungsbewusstsein Krankenversicherung Lebensmittelvergiftung
Wettervorhersage Bundesverfassungsgericht Entscheidungsfreiheit Aufenthaltsgenehmigung Sehenswuerdigkeiten
Arbeitslosenversicherung Unabhaengigkeitserklaerung Haftpflichtversicherung Rechtsschutzversicherung
anticonstitutionnellement gouvernementalisation incomprehensibilite professionnellement particularisation
extraordinairement institutionnalisation approvisionnements chronologiquement intergouvernemental
electroencefalografista internacionalizacion responsabilidades desafortunadamente contrarrevolucionario
caracteristicamente institucionalizado extraordinariamente constitucionalidad independientemente
""".split()
_WIDE_PLACES = {c: i for i, c in enumerate(ALPHABETS[-1][1])}
WIDEST = len(_WIDE_PLACES)
_CODE_OF_BYTE = np.full(256, WIDEST, np.int64)
_CODE_OF_BYTE[[ord(c) for c in _WIDE_PLACES]] = list(_WIDE_PLACES.values())
_PLACES = [{c: i for i, c in enumerate(chars)} for _, chars in ALPHABETS]


def known_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the known shapes, ascending."""
    found = []
    lowered = text.lower()
    if any(name in lowered for name in _NAMES):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def encoding(value: str) -> int:
    """The number of the smallest alphabet that has all characters of a candidate, padding aside."""
    chars = set(value.rstrip("="))
    return next(i for i, places in enumerate(_PLACES) if chars <= places.keys())


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def chi_squared_p(values: list[int], k: int) -> float:
    """The chance of counts at least as uneven, by the cube-root normal approximation."""
    n, df = len(values), k - 1
    statistic = k / n * sum(c * c for c in Counter(values).values()) - n
    z = ((max(statistic, 0) / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return 0.5 * math.erfc(z / math.sqrt(2))


def runs_p(values: list[int], k: int) -> float:
    """Runs above and below the middle of the alphabet against their expected number."""
    high = [2 * v >= k for v in values]
    n, n1 = len(high), sum(high)
    n2 = n - n1
    if not n1 or not n2:
        return 2 * 0.5**n
    runs = 1 + sum(a != b for a, b in zip(high, high[1:]))
    mean = 1 + 2 * n1 * n2 / n
    variance = (mean - 1) * (mean - 2) / (n - 1)
    return _two_sided((runs - mean) / math.sqrt(variance)) if variance > 0 else 1.0


def serial_p(values: list[int]) -> float:
    """Correlation of each character with the next one."""
    n = len(values)
    mean = sum(values) / n
    spread = sum((v - mean) ** 2 for v in values)
    if not spread:
        return 0.0
    r = sum((a - mean) * (b - mean) for a, b in zip(values, values[1:])) / spread
    return _two_sided((r + 1 / n) * math.sqrt(n))


def pair_counts_of(text: str) -> np.ndarray:
    """How often each key character follows each other one in a text (flat, by place in the widest alphabet)."""
    codes = _CODE_OF_BYTE[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)]
    first, second = codes[:-1], codes[1:]
    both = (first < WIDEST) & (second < WIDEST)
    return np.bincount(first[both] * WIDEST + second[both], minlength=WIDEST * WIDEST)


class Pairs:
    """The likelihood of a string under counted character pairs, against uniform draws from an alphabet."""

    def __init__(self, counts: np.ndarray) -> None:
        seen = pair_counts_of(" ".join(_LONG_WORDS)).reshape(WIDEST, WIDEST)
        # In the fixed words, a character after which little was seen is taken to be followed as characters are on the
        # whole, and a capital by capitals as its small letter is by small ones.
        expected = np.repeat((seen.sum(axis=0) + 0.5)[None, :] / (seen.sum() + 0.5 * WIDEST), WIDEST, axis=0)
        counts = counts.reshape(WIDEST, WIDEST)
        upper, lower = ([_WIDE_PLACES[c] for c in letters] for letters in (_UPPER, _LOWER))
        small = (seen + counts)[np.ix_(lower, lower)]
        expected[np.ix_(upper, upper)] += (small + 0.5) / (small.sum(axis=1, keepdims=True) + 13)
        base = (seen + 20 * expected) / (seen.sum(axis=1, keepdims=True) + 20)
        # The table's pairs count beside these, so that a key in a small table does not pass for its way of writing.
        self.logs = np.log((counts + PRIOR * base) / (counts.sum(axis=1, keepdims=True) + PRIOR))
        self.rows = self.logs.tolist()
        self.uniform = []
        for _, chars in ALPHABETS:
            own = [_WIDE_PLACES[c] for c in chars]
            cells = self.logs[np.ix_(own, own)]
            self.uniform.append((float(cells.mean()), float(cells.std())))

    def p(self, body: str, number: int) -> float:
        """The chance that a uniform draw from the alphabet is as likely under the pairs; low for ordinary writing."""
        places = [_WIDE_PLACES[c] for c in body]
        n = len(places) - 1
        mean, spread = self.uniform[number]
        if n < 1 or not spread:
            return 1.0
        total = sum(self.rows[a][b] for a, b in zip(places, places[1:]))
        return 0.5 * math.erfc((total - n * mean) / (spread * math.sqrt(n)) / math.sqrt(2))


def pairs_of(texts: Iterable[str]) -> Pairs:
    """The pairs of a few texts."""
    return Pairs(sum((pair_counts_of(text) for text in texts), np.zeros(WIDEST * WIDEST, np.int64)))


def score(value: str, pairs: Pairs | None = None) -> float:
    """The smallest p-value of the battery times the number of tests, at most 1; high for random strings."""
    number = encoding(value)
    places = _PLACES[number]
    body = value.rstrip("=")
    if not body:
        return 0.0
    values, k = [places[c] for c in body], len(places)
    found = [chi_squared_p(values, k), runs_p(values, k), serial_p(values)]
    if pairs is not None:
        found.append(pairs.p(body, number))
    return min(1.0, len(found) * min(found))


def score_bin(value: str, pairs: Pairs | None = None) -> int:
    """0 for the best score; the last bin for all low ones."""
    s = score(value, pairs)
    return BINS if s <= 0 else min(BINS, int(-10 * math.log10(s)))


def length_class(length: int) -> int:
    return min(CLASSES, (length - LEAST) // CLASS_CHARS)


def candidates(text: str, known: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, str, bool]]:
    """(start, end, string, is decoy) of the candidates that meet no known span."""
    taken: list[list[int]] = []
    for start, _, end in known:
        if taken and start < taken[-1][1]:
            taken[-1][1] = max(end, taken[-1][1])
        else:
            taken.append([start, end])
    k = 0
    for match in _CANDIDATE.finditer(text):
        start, end = match.span()
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        if k < len(taken) and taken[k][0] < end or match[0].isdigit():
            continue
        yield start, end, match[0], _WORD.fullmatch(match[0]) is not None


def counted_pairs(docs: DataFrame, text: str = "text") -> Pairs:
    """The character pairs of all texts of a table; a few thousand numbers come to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(WIDEST * WIDEST, np.int64)
        for batch in batches:
            for part in slices(batch):
                counts += pair_counts_of("\n".join(texts_of(part.column(0))))
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(counts[seen])], names=["pair", "n"])

    ship(docs.sparkSession)
    parts = docs.select(F.col(text).alias("text")).mapInArrow(count, "pair int, n long")
    whole = np.zeros(WIDEST * WIDEST, np.int64)
    for pair, n in parts.groupBy("pair").agg(F.sum("n")).collect():
        whole[pair] = n
    return Pairs(whole)


def histogram(docs: DataFrame, text: str = "text", pairs: Pairs | None = None) -> DataFrame:
    """(length_class, decoy, bin, n) over all candidates of a table."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for part in slices(batch):
                for body in texts_of(part.column(0)):
                    for start, end, value, decoy in candidates(body, known_spans(body)):
                        counts[length_class(end - start), decoy, score_bin(value, pairs)] += 1
        rows = [(*key, n) for key, n in counts.items()]
        columns = list(zip(*rows)) if rows else [[], [], [], []]
        types = [pa.int32(), pa.bool_(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["length_class", "decoy", "bin", "n"])

    ship(docs.sparkSession)
    parts = docs.select(F.col(text).alias("text")).mapInArrow(count, "length_class int, decoy boolean, bin int, n long")
    return parts.groupBy("length_class", "decoy", "bin").agg(F.sum("n").alias("n"))


def _sample(pairs: Pairs | None) -> Counter:
    """(length class, bin) of the fixed decoys, counted."""
    return Counter((length_class(len(word)), score_bin(word, pairs)) for word in _LONG_WORDS)


def _decay(passed: int, sizes: list[int]) -> float:
    """The rate g at which decoys of all length classes, each passing with exp(-g * length), pass in the number seen."""
    lengths = [LEAST + CLASS_CHARS * (c + 1) - 1 for c in range(len(sizes))]  # the longest of a class: decays too slowly, if anything
    low, high = 0.0, 10.0
    for _ in range(60):
        middle = (low + high) / 2
        expected = sum(n * math.exp(-middle * length) for n, length in zip(sizes, lengths))
        low, high = (middle, high) if expected > passed else (low, middle)
    return low


def shares(decoys: Counter) -> list[list[float]]:
    """For every length class, the estimated share of ordinary strings that reach each bin."""
    sizes = [sum(decoys[c, b] for b in range(BINS + 1)) for c in range(CLASSES + 1)]
    first = next((c for c, n in enumerate(sizes) if n), 0)
    passed, out = [0] * (CLASSES + 1), [[] for _ in sizes]
    for b in range(BINS + 1):
        passed = [n + decoys[c, b] for c, n in enumerate(passed)]
        # One decoy more that passes, as otherwise no share would be estimated where none does.
        decay = _decay(sum(passed) + 1, [n + (c == first) for c, n in enumerate(sizes)])
        for c, n in enumerate(passed):
            out[c].append((n + WEIGHT * math.exp(-decay * (LEAST + CLASS_CHARS * c))) / (sizes[c] + WEIGHT))
    return out


def thresholds(counts: list[tuple[int, bool, int, int]], rate: float = RATE, pairs: Pairs | None = None) -> list[int]:
    """For every length class the last bin that is taken for random, -1 for none."""
    decoys, others = _sample(pairs), Counter()
    for length, decoy, number, times in counts:
        (decoys if decoy else others)[length, number] += times
    last = []
    for length, share in enumerate(shares(decoys)):
        total = sum(others[length, b] for b in range(BINS + 1))
        passed, best = 0, -1
        for b in range(BINS):
            passed += others[length, b]
            if passed and share[b] * total <= rate * passed:
                best = b
        last.append(best)
    return last


def spans_of(text: str, last: list[int], pairs: Pairs | None = None) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all spans of a text, ascending."""
    known = known_spans(text)
    random = [
        (start, 3, end)
        for start, end, value, decoy in candidates(text, known)
        if not decoy and score_bin(value, pairs) <= last[length_class(end - start)]
    ]
    return sorted(known + random)


def redacted(text: str, spans: list[tuple[int, int, int]], replacement: str = REPLACEMENT) -> str:
    """The text with every run of overlapping spans replaced."""
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], replacement]
        at = max(at, end)
    return "".join(out) + text[at:]


def find_secrets(docs: DataFrame, text: str = "text", rate: float = RATE) -> DataFrame:
    """``docs`` with ``secrets`` (kind, start, end; by start, then kind) and ``redacted`` text (null stays null)."""
    pairs = counted_pairs(docs, text)
    rows = histogram(docs, text, pairs).collect()  # at most classes x bins x 2
    last = thresholds([tuple(row) for row in rows], rate, pairs)

    def prepare():
        def work(column: pa.Array) -> list:
            spans, texts = [], []
            for body in column.to_pylist():
                found = spans_of(body or "", last, pairs)
                spans.append([{"kind": KINDS[kind], "start": start, "end": end} for start, kind, end in found])
                texts.append(redacted(body, found) if found else body)
            return [spans, texts]

        return work

    return with_batches(docs, [text], "secrets array<struct<kind:string,start:bigint,end:bigint>>, redacted string", prepare)


def without_secrets(docs: DataFrame, text: str = "text", chars: str = "n_chars") -> DataFrame:
    """All documents, columns as they came, with secrets replaced and the length column brought up to date."""
    own, restore = set_aside(docs, ("secrets", "redacted"))
    found = find_secrets(own, text)
    changed = F.size("secrets") > 0
    new = {text: F.col("redacted")}
    if chars in docs.columns:
        new[chars] = F.when(changed, F.length("redacted").cast(docs.schema[chars].dataType)).otherwise(F.col(chars))
    return restore(found.withColumns(new))
