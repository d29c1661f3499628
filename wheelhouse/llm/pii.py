"""Personal data in texts: exact shapes, and whole spans chosen by a semi-Markov conditional random field.

Digits and at-signs are rare, so a text is first reduced to islands: runs of words that hold one, with the words before
them as context.  No entity can lie outside an island.  An island is cut into tokens, and candidate segments of up to
:data:`LONGEST` tokens are scored as wholes, by type: number and grouping of digits, check sum, octets, separators, what
stands on either side, the word before.  Dynamic programming over the segments (entities are bounded, other tokens stand
alone) finds the boundaries and types of best total score together with the weights between neighbouring labels.

The weights are trained here, by the likelihood of a small labelled table that is generated from rules: the four kinds
of data in many writings, among dates, times, versions, amounts, book and order numbers, counts, lines of number tables.

The exact shapes (email, ip, card, phone) always stay; a span of the field is added where it meets none of them.  A null
or empty text has no spans.  Texts are read whole; positions are code points, ends exclusive.  Repeated rows are judged
each on their own; an empty table gives no rows; a column named like the result is replaced.
"""

from __future__ import annotations

import random
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wheelhouse.llm.batches import texts_of, with_batches

KINDS = ("email", "ip", "card", "phone")
LABELS = ("other", *KINDS)
MOST_DIGITS = 19  # of any number that is personal data here
LONGEST = 16  # tokens of an entity; a card of single digits with separators has more, its exact shape is found anyway
EPOCHS = 16
TABLE_ROWS = 750

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT_RUN = re.compile(r"[0-9][0-9.]*")
_CUE = re.compile(r"[0-9@]+")
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|[^\w]|_|\w")
_NUMBER_CHARS = frozenset("0123456789 ().+-")
_SHAPE = str.maketrans("123456789", "000000000")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Every at-sign in turn: the longest local part before it that no earlier match has taken, and a domain."""
    taken = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > taken and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        taken = at + 1
        if found:
            yield start, found.end()
            taken = found.end()
        at = taken


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for run in _DIGIT_RUN.finditer(text):
        if run[0].count(".") >= 3:
            for match in _IP.finditer(text, *run.span()):
                if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in match[0].split(".")):
                    yield match.span()


def exact_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the exact shapes, ascending."""
    found = []
    if "@" in text:
        found += [(start, 0, end) for start, end in _emails(text)]
    if _CUE.search(text):
        found += [(start, 1, end) for start, end in _ips(text)]
        for match in _CARD.finditer(text):
            digits = _digits(match[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((match.start(), 2, match.end()))
        if "+" in text:
            found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(found)


@dataclass(frozen=True)
class Segment:
    """Tokens ``start`` to ``end`` of an island under a label, with the names of its features."""

    start: int
    end: int
    label: int
    features: tuple[str, ...]


def islands(text: str) -> Iterator[tuple[int, int]]:
    """Runs of neighbouring words that hold a digit or an at-sign."""
    start = end = -1
    for cue in _CUE.finditer(text):
        if cue.start() < end:
            continue
        low, high = cue.span()
        while low > 0 and not text[low - 1].isspace():
            low -= 1
        while high < len(text) and not text[high].isspace():
            high += 1
        if end >= 0 and low - end <= 1:
            end = high
        else:
            if end >= 0:
                yield start, end
            start, end = low, high
    if end >= 0:
        yield start, end


def _side(text: str, at: int) -> str:
    if not 0 <= at < len(text) or text[at].isspace():
        return "space"
    return "word" if text[at].isalnum() or text[at] in "_@" else "close" if text[at] in ",;:!?\"')]>" else text[at]


def _in_row(text: str, at: int, step: int) -> bool:
    """Whether another number stands next to a place, with nothing but a few blanks and list marks in between."""
    for k in range(at, at + 6 * step, step):
        if not 0 <= k < len(text) or text[k] not in " \t\n,;|":
            return k != at and 0 <= k < len(text) and text[k] in "0123456789"
    return False


def _word_before(text: str, start: int) -> str:
    words = re.findall(r"[^\W\d_]+", text[max(0, start - 24) : start].lower())
    return words[-1] if words else ""


def _shape_features(kind: str, shape: str, zero: bool) -> tuple[str, ...]:
    """What the form of a number says, digits as 0; the same for all numbers of one form."""
    groups = re.findall("0+", shape)
    marks = "".join(sorted(set(shape) & set(" ().+-")))
    facts = ["bias", f"digits {shape.count('0')}", f"marks {marks}", f"groups {len(groups)}", f"sizes {'-'.join(str(len(g)) for g in groups)}"]
    facts += [f"plus {shape[0] == '+'}", f"brackets {shape.count('(') == shape.count(')') == shape.count(' (') + shape.startswith('(')}", f"zero {zero}"]
    return tuple(f"{kind} {fact}" for fact in facts)


def _place_features(kind: str, text: str, start: int, end: int) -> tuple[str, ...]:
    """What stands around a number."""
    left, right = _in_row(text, start - 1, -1), _in_row(text, end, 1)
    facts = [f"left {_side(text, start - 1)}", f"right {_side(text, end)}", f"before {_word_before(text, start)}", f"row {left} {right}"]
    return tuple(f"{kind} {fact}" for fact in facts)


def _mail_features(text: str, start: int, end: int) -> tuple[str, ...]:
    name, _, domain = text[start:end].partition("@")
    last = domain.rpartition(".")[2]
    facts = ["bias", f"left {_side(text, start - 1)}", f"right {_side(text, end)}", f"dot {'.' in domain}"]
    facts += [f"last {last.isalpha() and 2 <= len(last) <= 10}", f"name {bool(name)}", f"again {'@' in domain}"]
    return tuple(f"email {fact}" for fact in facts)


def _features(text: str, start: int, end: int, label: int) -> tuple[str, ...]:
    kind = LABELS[label]
    if kind == "email":
        return _mail_features(text, start, end)
    span = text[start:end]
    return _shape_features(kind, span.translate(_SHAPE), _digits(span)[:1] == "0") + _place_features(kind, text, start, end)


def _token_feature(token: str) -> str:
    shape = f"digits {min(len(token), 8)}" if token[0].isdigit() else "@" if token == "@" else "word" if token[0].isalpha() else "mark"
    return f"other {shape}"


def candidates(text: str, tokens: list[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
    """(first token, token after the last, label) of what may be an entity, by first token.

    An entity is bounded: by its tokens, and by what its kind can be at all.  A card has 12 to 19 digits that pass the
    check sum, a telephone number 7 to 15, an address four octets between dots.
    """
    count = len(tokens)
    for i, (start, stop) in enumerate(tokens):
        first = text[start]
        if not (first.isalnum() or first in "+("):
            continue
        numeric = mail = True
        ats, digits, dots, others = 0, "", 0, False
        for j in range(i, min(count, i + LONGEST)):
            low, end = tokens[j]
            piece = text[low:end]
            if "0" <= piece[0] <= "9":
                digits += piece
            elif piece == ".":
                dots += 1
            else:
                numeric = numeric and piece in _NUMBER_CHARS
                others = True
            numeric = numeric and len(digits) <= MOST_DIGITS
            if mail:
                ats += piece == "@"
                mail = piece == "@" or all(c in _LOCAL for c in piece)
            if not numeric and not mail:
                break
            if not piece[-1].isalnum():
                continue
            if numeric:
                n = len(digits)
                if 7 <= n <= 15:
                    yield i, j + 1, 4
                if 12 <= n and luhn(digits):
                    yield i, j + 1, 3
                if dots == 3 and not others and j == i + 6 and all(tokens[k][1] - tokens[k][0] <= 3 and int(text[tokens[k][0] : tokens[k][1]]) <= 255 for k in (i, i + 2, i + 4, j)):
                    yield i, j + 1, 2
            if mail and ats and j > i:
                yield i, j + 1, 1


def segments(text: str, low: int, high: int) -> tuple[list[tuple[int, int]], list[Segment]]:
    """The tokens of an island and all segments, single tokens that are no entity among them, by their ends."""
    tokens = [m.span() for m in _TOKEN.finditer(text, low, high)]
    out = [Segment(i, i + 1, 0, (_token_feature(text[start:stop]),)) for i, (start, stop) in enumerate(tokens)]
    out += [Segment(i, j, label, _features(text, tokens[i][0], tokens[j - 1][1], label)) for i, j, label in candidates(text, tokens)]
    out.sort(key=lambda s: (s.end, s.start))
    return tokens, out


class Field:
    """A trained field: weights of features, and between the labels of neighbouring segments."""

    def __init__(self, weights: dict[str, float], steps: np.ndarray) -> None:
        self.weights, self.steps = weights, steps

    def best(self, count: int, found: list[Segment]) -> list[Segment]:
        """The segments of the best division of ``count`` tokens."""
        states = len(LABELS)
        score = np.full((count + 1, states), -np.inf)
        score[0, 0] = 0.0
        back: dict[tuple[int, int], tuple[Segment, int]] = {}
        for segment in found:
            arriving = score[segment.start] + self.steps[:, segment.label]
            last = int(arriving.argmax())
            value = arriving[last] + sum(self.weights.get(f, 0.0) for f in segment.features)
            if value > score[segment.end, segment.label]:
                score[segment.end, segment.label] = value
                back[segment.end, segment.label] = segment, last
        at, label, chosen = count, int(score[count].argmax()), []
        while at:
            segment, label = back[at, label]
            chosen.append(segment)
            at = segment.start
        return chosen[::-1]

    def entities(self, text: str, tokens: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """(start, label, end) in the text, of the best division; the same as :meth:`best`, holding little of it.

        Scores are kept for as many tokens as an entity can have; for the rest of an island there are two small numbers
        for each token and label, which lead back.  What depends on the form of a number alone is worked out once.
        """
        count, states = len(tokens), len(LABELS)
        steps, weights = self.steps.tolist(), self.weights
        low = float("-inf")
        ring = [[low] * states for _ in range(LONGEST + 1)]
        ring[0][0] = 0.0
        back_from, back_label = array("l", bytes(array("l").itemsize * (count + 1) * states)), bytearray((count + 1) * states)
        shapes: dict[tuple, float] = {}
        found, follow = candidates(text, tokens), None
        follow = next(found, None)
        for i in range(count):
            score = ring[i % (LONGEST + 1)]
            arriving: list[tuple[float, int] | None] = [None] * states

            def reach(label: int, end: int, value: float) -> None:
                if arriving[label] is None:
                    options = [score[k] + steps[k][label] for k in range(states)]
                    top = max(options)
                    arriving[label] = top, options.index(top)
                base, last = arriving[label]
                target = ring[end % (LONGEST + 1)]
                if base + value > target[label]:
                    target[label] = base + value
                    back_from[end * states + label], back_label[end * states + label] = i, last

            start, stop = tokens[i]
            reach(0, i + 1, weights.get(_token_feature(text[start:stop]), 0.0))
            while follow is not None and follow[0] == i:
                _, j, label = follow
                reach(label, j, self._value(text, start, tokens[j - 1][1], label, shapes))
                follow = next(found, None)
            ring[i % (LONGEST + 1)] = [low] * states
        ends = ring[count % (LONGEST + 1)]
        at, label, out = count, ends.index(max(ends)), []
        while at:
            begin, last = back_from[at * states + label], back_label[at * states + label]
            if label:
                out.append((tokens[begin][0], label, tokens[at - 1][1]))
            at, label = begin, last
        return out[::-1]

    def _value(self, text: str, start: int, end: int, label: int, shapes: dict[tuple, float]) -> float:
        weights, kind = self.weights, LABELS[label]
        if kind == "email":
            return sum(weights.get(f, 0.0) for f in _mail_features(text, start, end))
        span = text[start:end]
        shape = span.translate(_SHAPE)
        key = (label, shape, span[shape.index("0")] == "0")
        value = shapes.get(key)
        if value is None:
            if len(shapes) > 50_000:
                shapes.clear()
            value = shapes[key] = sum(weights.get(f, 0.0) for f in _shape_features(kind, shape, key[2]))
        return value + sum(weights.get(f, 0.0) for f in _place_features(kind, text, start, end))


def _expected(count: int, found: list[Segment], scores: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of the segments, and of the label steps, under the field (forward and backward sums)."""
    states = len(LABELS)
    ahead, behind = np.full((count + 1, states), -np.inf), np.full((count + 1, states), -np.inf)
    ahead[0, 0], behind[count] = 0.0, 0.0
    for k, s in enumerate(found):
        ahead[s.end, s.label] = np.logaddexp(ahead[s.end, s.label], np.logaddexp.reduce(ahead[s.start] + steps[:, s.label]) + scores[k])
    for k in range(len(found) - 1, -1, -1):
        s = found[k]
        behind[s.start] = np.logaddexp(behind[s.start], steps[:, s.label] + scores[k] + behind[s.end, s.label])
    total = np.logaddexp.reduce(ahead[count])
    chances, moves = np.zeros(len(found)), np.zeros((states, states))
    for k, s in enumerate(found):
        each = np.exp(ahead[s.start] + steps[:, s.label] + scores[k] + behind[s.end, s.label] - total)
        chances[k] = each.sum()
        moves[:, s.label] += each
    return chances, moves


def labelled_table(rows: int = TABLE_ROWS, seed: int = 11) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """(text, [(start, label, end)]) rows, generated by rule."""
    rng = random.Random(seed)

    def number(n: int) -> str:
        return "".join(rng.choice("0123456789") for _ in range(n))

    def card() -> str:
        body = rng.choice("3456") + number(rng.choice((13, 14, 14, 14)))
        digits = next(body + d for d in "0123456789" if luhn(body + d))
        cut = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        return rng.choice((digits, " ".join(cut), "-".join(cut)))

    def phone() -> str:
        a, b, c = str(rng.randint(201, 989)), number(3), number(4)
        return rng.choice(
            (f"+1 ({a}) {b}-{c}", f"+1-{a}-{b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+49 {number(3)} {number(7)}", f"+{rng.randint(30, 99)}{number(9)}", f"{a}.{b}.{c}")
        )

    def word() -> str:
        return "".join(rng.choice("abcdefghilmnoprstuv") for _ in range(rng.randint(2, 9)))

    def email() -> str:
        return f"{word()}{rng.choice(('', '.' + number(2), number(2), '_' + word()))}@{word()}{rng.choice(('', number(1)))}.{rng.choice(('com', 'org', 'net', 'co.uk', 'example.com'))}"

    def ip() -> str:
        return ".".join(str(rng.randint(0, 255)) for _ in range(4))

    def ordinary() -> str:
        return rng.choice(
            (
                f"{rng.randint(1900, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}", f"{rng.randint(10, 23)}:{rng.randint(10, 59)}", number(rng.randint(1, 12)),
                f"{number(2)}.{number(2)}", f"v{rng.randint(1, 9)}.{rng.randint(0, 20)}.{rng.randint(0, 9)}", f"{number(3)}-{number(2)}", f"{word()}{number(3)}", f"#{number(8)}",
                f"{number(4)}.{number(5)}.{number(3)}.{number(4)}", f"{number(16)}x", f"{number(1)} {number(3)} {number(3)}", f"{number(5)} {number(5)}", f"@{word()}",
                f"{number(2)}/{number(2)}/{number(4)}", f"{number(3)}, {number(3)}, {number(4)}", f"{number(22)}", f"{word()}@{word()}", f"{number(10)}", f"{number(9)}", number(16),
            )
        )

    def isbn() -> str:
        return rng.choice((f"978-{number(1)}-{number(2)}-{number(6)}-{number(1)}", f"978-{number(1)}-{number(4)}-{number(4)}-{number(1)}", f"978{number(10)}", f"{number(1)}-{number(3)}-{number(5)}-{number(1)}"))

    def numbers() -> str:
        """A line of a table: numbers of like sizes, one after the other."""
        least = rng.randint(1, 6)
        if rng.random() < 0.5:
            return " ".join(number(4) for _ in range(rng.randint(6, 16)))
        between = rng.choice((" ", " ", " ", ", ", "\t", "  ", ";"))
        return between.join(number(rng.randint(least, least + rng.randint(0, 3))) for _ in range(rng.randint(3, 12)))

    def count() -> str:
        mark = rng.choice((" ", " ", ",", "."))
        return str(rng.randint(1, 999)) + "".join(mark + number(3) for _ in range(rng.randint(2, 4)))

    makers = (email, ip, card, phone)
    table = []
    for row in range(rows):
        if row % 3 == 2:
            cue = rng.choice(("isbn", "isbn", "book", word()))
            value = rng.choice((f"{cue} {isbn()}", f"{cue}: {isbn()}", numbers(), numbers(), f"{word()} {count()} {word()}", f"{count()} {word()}"))
            table.append((f"{word()} {value} {word()}", []))
            continue
        text, spans = word(), []
        for _ in range(rng.randint(1, 3)):
            text += " " + " ".join(word() for _ in range(rng.randint(0, 2)))
            text = text.rstrip() + " "
            label = rng.choice((0, 0, 0, 1, 2, 3, 4))
            value = makers[label - 1]() if label else ordinary()
            if label:
                spans.append((len(text), label, len(text) + len(value)))
            text += value + rng.choice(("", "", "", ",", ".", ";"))
            text += " " + word()
        table.append((text, spans))
    return table


@cache
def trained_field(rows: int = TABLE_ROWS, epochs: int = EPOCHS) -> Field:
    """Weights by gradient steps on the likelihood of the labelled table, with a small quadratic penalty."""
    names: dict[str, int] = {}
    samples = []
    for text, spans in labelled_table(rows):
        wanted = {(start, label, end) for start, label, end in spans}
        for low, high in islands(text):
            tokens, found = segments(text, low, high)
            told = {(s, label, e) for s, label, e in wanted if low <= s and e <= high}
            gold = [s for s in found if s.label and (tokens[s.start][0], s.label, tokens[s.end - 1][1]) in told]
            inside = {i for s in gold for i in range(s.start, s.end)}
            gold = sorted(gold + [s for s in found if not s.label and s.start not in inside], key=lambda s: s.start)
            if sum(s.end - s.start for s in gold) != len(tokens):
                continue  # a value that its neighbours have grown into: not a clean example
            rows_of = [np.array([names.setdefault(f, len(names)) for f in s.features]) for s in found]
            samples.append((len(tokens), found, rows_of, [found.index(s) for s in gold], [s.label for s in gold]))
    weights, steps = np.zeros(len(names)), np.zeros((len(LABELS), len(LABELS)))
    squares, step_squares = np.full(len(names), 1e-6), np.full_like(steps, 1e-6)
    for epoch in range(epochs):
        for k in range(0, len(samples), 50):
            grad, step_grad = -1e-3 * weights, -1e-3 * steps
            for count, found, rows_of, gold, labels in samples[k : k + 50]:
                scores = np.array([weights[r].sum() for r in rows_of])
                chances, moves = _expected(count, found, scores, steps)
                chances[gold] -= 1.0
                np.subtract.at(grad, np.concatenate(rows_of), np.repeat(chances, [len(r) for r in rows_of]))
                step_grad -= moves
                for a, b in zip([0, *labels], labels):
                    step_grad[a, b] += 1.0
            squares += grad**2
            step_squares += step_grad**2
            weights += 0.3 * grad / np.sqrt(squares)
            steps += 0.3 * step_grad / np.sqrt(step_squares)
    return Field(dict(zip(names, weights.tolist())), steps)


def field_spans(text: str, trained: Field) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the entities that the field finds."""
    out = []
    for low, high in islands(text):
        tokens = [m.span() for m in _TOKEN.finditer(text, low, high)]
        out += [(start, label - 1, end) for start, label, end in trained.entities(text, tokens)]
    return out


def spans_of(text: str, trained: Field) -> list[tuple[int, int, int, bool]]:
    """(start, kind number, end, is exact), ascending; spans of the field only where no exact one is met."""
    exact = exact_spans(text)
    taken, k, out = sorted((s, e) for s, _, e in exact), 0, [(*span, True) for span in exact]
    for start, kind, end in field_spans(text, trained):
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        if not any(s < end and e > start for s, e in taken[k : k + 5]):
            out.append((start, kind, end, False))
    return sorted(out)


def find_personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``personal``: kind, start, end and whether it is an exact shape, by start and kind."""
    shared = docs.sparkSession.sparkContext.broadcast(trained_field())  # a few hundred weights

    def prepare():
        trained = shared.value

        def work(column: pa.Array) -> list:
            return [
                [
                    [{"kind": KINDS[kind], "start": start, "end": end, "exact": exact} for start, kind, end, exact in spans_of(body, trained)]
                    for body in texts_of(column)
                ]
            ]

        return work

    return with_batches(docs, [text], "personal array<struct<kind:string,start:bigint,end:bigint,exact:boolean>>", prepare)
