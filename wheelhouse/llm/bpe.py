"""Byte-level byte-pair encoding and decoding with a segment tree over the byte positions of each piece.

A text is cut into pieces by the vocabulary's pattern.  In every piece the leaves of a binary tree hold, for each live
position, the rank of the pair that starts there (with the position, so that the leftmost of equal ranks wins), and the
inner nodes hold minima: the root is the next merge.  A merge changes three leaves, its own, that of the live neighbour
before it and that of the position that ceases to exist, and their paths to the root.  The trees of all pieces of a
size class are kept side by side in one array, so that one step merges one pair in every piece that still has any.

A null or empty text has no tokens and decodes to no bytes.  Texts are encoded whole; long ones are read in segments,
which never cut a piece.  Special tokens are ordinary text.  Repeated rows give repeated results, an empty table gives
an empty one; other columns are kept, and columns named like the results are replaced.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from wheelhouse.llm.batches import texts_of, with_batches

NONE = np.int64(1) << 62
SEGMENT = 1 << 21  # characters of a text that are looked at together
KNOWN = 250_000  # remembered pieces and units; forgetting them changes no result
TREE_CELLS = 1 << 17
RANK_BITS = 21  # of a token id; also what a pair key shifts by


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file by their ids: lines of base64 bytes and the id."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    tokens = [b""] * len(pairs)
    for word, rank in pairs:
        tokens[int(rank)] = base64.b64decode(word)
    return tokens


class _Index(dict):
    """Numbers its keys in the order of their first use and lists the new ones."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list = []

    def __missing__(self, key):
        self[key] = number = len(self)
        self.new.append(key)
        return number


class _Ragged:
    """Rows of ids of different lengths in one array."""

    def __init__(self) -> None:
        self.flat = np.empty(0, np.int32)
        self.counts = np.empty(0, np.int64)
        self.starts = np.empty(0, np.int64)

    def append(self, flat: np.ndarray, counts: np.ndarray) -> None:
        self.flat = np.concatenate([self.flat, flat.astype(np.int32)])
        self.counts = np.concatenate([self.counts, counts])
        self.starts = np.cumsum(self.counts) - self.counts

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the rows one after the other, and how many each has."""
        counts = self.counts[rows]
        ends = np.cumsum(counts)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[rows] - (ends - counts), counts)
        return self.flat[places], counts


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of the given lengths."""
    ends = np.cumsum(counts)
    total = np.concatenate([[0], np.cumsum(values)])
    return total[ends] - total[ends - counts]


class Encoder:
    """Encodes texts by the ranks of ``tokens``; pieces met before are remembered."""

    def __init__(self, tokens: Sequence[bytes], pattern: str) -> None:
        self.ids = {token: number for number, token in enumerate(tokens)}
        self.split = regex.compile(pattern).findall
        self.iterate = regex.compile(pattern).finditer
        self.gaps = regex.compile(r"\s\s").search
        self.bytes_to_ids = np.array([self.ids[bytes([b])] for b in range(256)], np.int64)
        found = {}
        for number, token in enumerate(tokens):
            for cut in range(1, len(token)):
                left, right = self.ids.get(token[:cut]), self.ids.get(token[cut:])
                if left is not None and right is not None:
                    found[(left << RANK_BITS) | right] = number
        self.pair_keys = np.array(sorted(found), np.int64)
        self.pair_ranks = np.array([found[key] for key in sorted(found)], np.int64)
        self._forget()

    def _forget(self) -> None:
        self.units, self.unit_rows = _Index(), _Ragged()
        self.pieces, self.piece_rows = _Index(), _Ragged()

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, :data:`NONE` where the pair is no token; an id of -1 has no pairs."""
        keys = (left << RANK_BITS) | right
        places = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[places] == keys) & (right >= 0), self.pair_ranks[places], NONE)

    def merge(self, pieces: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all pieces one after the other, and how many each piece has."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        classes = np.ceil(np.log2(np.maximum(lengths, 2))).astype(int)
        rows, order = _Ragged(), np.argsort(classes, kind="stable")
        for size in np.unique(classes):
            members = order[classes[order] == size]
            step = max(1, TREE_CELLS >> int(size))
            for start in range(0, len(members), step):
                chosen = members[start : start + step]
                rows.append(*self._merge_class([pieces[i] for i in chosen.tolist()], lengths[chosen], int(size)))
        return rows.take(np.argsort(order))

    def _merge_class(self, pieces: list[bytes], lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        leaves = 1 << size
        many, wide = len(pieces), leaves + 1  # the last place of a row stands for "no neighbour"
        ids = np.full((many, wide), -1, np.int64)
        live = np.arange(wide)[None, :] < lengths[:, None]
        ids[live] = self.bytes_to_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        after = np.where(np.arange(1, wide + 1)[None, :] < lengths[:, None], np.arange(1, wide + 1)[None, :], leaves)
        before = np.repeat(np.arange(-1, wide - 1)[None, :], many, axis=0)
        before[:, 0] = leaves
        tree = np.full((many, 2 * leaves), NONE, np.int64)
        first = self._ranks(ids[:, :-1], ids[:, 1:])
        tree[:, leaves:] = np.where(first < NONE, (first << size) | np.arange(leaves), NONE)
        level = leaves >> 1
        while level:
            tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
            level >>= 1
        ids, after, before, tree = ids.ravel(), after.ravel(), before.ravel(), tree.ravel()
        active = np.arange(many)
        while True:
            root = tree[active * 2 * leaves + 1]
            alive = root < NONE
            active, root = active[alive], root[alive]
            if not len(active):
                break
            row, top = active * wide, active * 2 * leaves
            at, rank = root & (leaves - 1), root >> size
            gone = after[row + at]
            next_ = after[row + gone]
            last = before[row + at]
            ids[row + at], ids[row + gone] = rank, -1
            after[row + at] = next_
            before[row + next_] = at
            own = self._ranks(rank, ids[row + next_])
            own = np.where(own < NONE, (own << size) | at, NONE)
            left = self._ranks(ids[row + last], rank)
            has_left = last < leaves
            left_at = np.where(has_left, last, at)
            left = np.where(has_left, np.where(left < NONE, (left << size) | left_at, NONE), own)
            tree[top + leaves + gone] = NONE
            tree[top + leaves + at] = own
            tree[top + leaves + left_at] = left
            paths = [leaves + gone, leaves + at, leaves + left_at]
            for _ in range(size):
                for k, node in enumerate(paths):
                    paths[k] = node = node >> 1
                    tree[top + node] = np.minimum(tree[top + 2 * node], tree[top + 2 * node + 1])
        ids = ids.reshape(many, wide)
        live = ids >= 0
        return ids[live], live.sum(axis=1)

    def _learn(self) -> None:
        """Encode the units, and below them the pieces, that were met for the first time."""
        if not self.units.new:
            return
        cut = [self.split(key[0] if type(key) is tuple else " " + key) for key in self.units.new]
        rows = np.fromiter((self.pieces[piece] for pieces in cut for piece in pieces), np.int64)
        if self.pieces.new:
            raw = [piece.encode() for piece in self.pieces.new]
            whole = [self.ids.get(piece) for piece in raw]
            flat, counts = self.merge([piece for piece, number in zip(raw, whole) if number is None])
            single = np.array([number for number in whole if number is not None], np.int64)
            is_single = np.array([number is not None for number in whole])
            both = _Ragged()
            both.append(np.concatenate([flat, single]), np.concatenate([counts, np.ones(len(single), np.int64)]))
            places = np.where(is_single, len(counts) + np.cumsum(is_single) - 1, np.cumsum(~is_single) - 1)
            self.piece_rows.append(*both.take(places))
            self.pieces.new = []
        flat, counts = self.piece_rows.take(rows)
        self.unit_rows.append(flat, _sums(counts, np.fromiter(map(len, cut), np.int64, len(cut))))
        self.units.new = []

    def _unit_lists(self, text: str) -> Iterator[list[int]]:
        """Numbers of the text's units in segments.

        Without two white-space characters in a row, no piece reaches over a space into the word after it but for the
        space itself, so that each word with the space before it is a unit.  Other texts are cut by the pattern.
        """
        if self.gaps(text):
            pieces = (match[0] for match in self.iterate(text))
            while part := list(islice(pieces, SEGMENT // 8)):
                yield [self.units[(piece,)] for piece in part]
            return
        start = 0
        while start < len(text):
            end = text.find(" ", start + SEGMENT)
            words = text[start : end if end >= 0 else len(text)].split(" ")
            head = [self.units[(words[0],)]] if words[0] else []
            yield head + list(map(self.units.__getitem__, words[1:]))
            start = end if end >= 0 else len(text)

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Token ids of each text."""
        done: list[list[np.ndarray]] = [[] for _ in texts]
        waiting: list[tuple[int, list[int]]] = []
        held = 0

        def flush() -> None:
            nonlocal waiting, held
            self._learn()
            sizes = np.fromiter((len(units) for _, units in waiting), np.int64, len(waiting))
            rows = np.fromiter(chain.from_iterable(units for _, units in waiting), np.int64, int(sizes.sum()))
            flat, counts = self.unit_rows.take(rows)
            for (i, _), ids in zip(waiting, np.split(flat, np.cumsum(_sums(counts, sizes))[:-1])):
                done[i].append(ids)
            waiting, held = [], 0
            if len(self.units) > KNOWN or len(self.pieces) > KNOWN:
                self._forget()

        for i, text in enumerate(texts):
            for units in self._unit_lists(text):
                waiting.append((i, units))
                held += len(units)
                if held > SEGMENT // 64:
                    flush()
        if waiting:
            flush()
        empty = np.empty(0, np.int32)
        return [parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else empty for parts in done]


def decode_ids(tokens: Sequence[bytes], token_bytes: bytes) -> bytes:
    return b"".join(map(tokens.__getitem__, np.frombuffer(token_bytes, "<u4").tolist()))


_encoders: dict[tuple, Encoder] = {}


def _encoder(tokens: list[bytes], pattern: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    key = (pattern, len(tokens), hash(tuple(tokens)))
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(tokens, pattern)
    return _encoders[key]


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", decoded: bool = False) -> DataFrame:
    """``docs`` with ``token_bytes``: the ids as little-endian unsigned 32-bit integers.

    With ``decoded`` the ids are decoded in the same pass, as :func:`decode` does in one of its own.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(path))  # a vocabulary file, under 1 MB

    def prepare():
        encoder = _encoder(shared.value, pattern)

        def work(column: pa.Array) -> list:
            ids = [each.astype("<u4").tobytes() for each in encoder.encode(texts_of(column))]
            return [ids, [decode_ids(shared.value, value) for value in ids]] if decoded else [ids]

        return work

    return with_batches(docs, [text], "token_bytes binary" + ", decoded binary" * decoded, prepare)


def decode(rows: DataFrame, path: str, ids: str = "token_bytes") -> DataFrame:
    """``rows`` with ``decoded``: the bytes that the ids stand for."""
    shared = rows.sparkSession.sparkContext.broadcast(read_ranks(path))

    def prepare():
        tokens = shared.value

        def work(column: pa.Array) -> list:
            return [[decode_ids(tokens, value or b"") for value in column.to_pylist()]]

        return work

    return with_batches(rows, [ids], "decoded binary", prepare)
