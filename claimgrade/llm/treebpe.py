"""Byte-level BPE from a rank file, by a segment tree over the byte positions of a pre-token.

A pre-token is a match of the file's pattern. Every byte position has a leaf: the rank of the
live pair that begins there, or nothing. A node holds the smaller of its children, rank before
position, so the root is the leftmost pair of least rank. A merge joins a pair with its live
neighbour on the right and changes three leaves (its own, the absorbed one, the neighbour on
the left), each in logarithmic time: n bytes take O(n log n) steps, one very long word included.

Pre-tokens of ordinary length are remembered by their bytes; a text's ids are then looked up.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from claimgrade.llm.common import kept, with_arrow_columns

# pre-tokens remembered per Python worker, of at most so many characters; beyond it the memory starts anew
REMEMBERED, SHORT = 600_000, 48
# longer texts are cut into pre-tokens a stretch at a time
STRETCH = 1 << 18

# Code points that are letters or digits to the regex package but not to the rank
# file's library, which knows Unicode up to version 16.
NEWER_LETTERS = (
    "0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 "
    "10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DF1 16EA0-16EB8 16EBB-16ED3 16FF2-16FF3 187F8-187FF 18CD6-18CDA 18D09-18D20 "
    "18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE "
    "1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
)
NEWER_DIGITS = "11DE0-11DE9 1246F 12475-1247F 12550-12686 16FF4-16FF6"


def _class(ranges: str) -> str:
    """The code points of ``ranges`` for use inside a character class."""
    return "".join("-".join(f"\\U{int(end, 16):08X}" for end in part.split("-")) for part in ranges.split())


# no newer letter or digit comes before the first of them: most texts end here
_MAYBE_NEWER = re.compile("[\u0558-\U0010ffff]")
_NEWER = regex.compile(f"[{_class(NEWER_LETTERS)}{_class(NEWER_DIGITS)}]")


def splitters(pattern: str) -> tuple[regex.Pattern, regex.Pattern]:
    """``pattern`` for texts without and with letters or digits that the library does not know."""
    letters, digits = f"[\\p{{L}}--[{_class(NEWER_LETTERS)}]]", f"[\\p{{N}}--[{_class(NEWER_DIGITS)}]]"
    # inside a negated class a difference cannot stand as it is: the newer ones are let in beside it
    exact = pattern.replace(r"[^\s\p{L}\p{N}]", f"(?:[^\\s\\p{{L}}\\p{{N}}]|[{_class(NEWER_LETTERS)}{_class(NEWER_DIGITS)}])")
    exact = exact.replace(r"\p{L}+|", f"{letters}+|").replace(r"\p{N}+|", f"{digits}+|")
    return regex.compile(pattern), regex.compile(exact, regex.V1)


class Ranks:
    """A rank file: lines of a token's bytes in base 64, a blank, and its rank, which is its id."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"no rank for single bytes {missing}")
        self.above = max(self.ranks.values()) + 1
        self.tokens = np.full(self.above, None, object)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.plain, self.exact = splitters(pattern)
        self.memory = _Memory(self)

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one pre-token."""
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        n = len(piece)
        shift = n.bit_length()
        half = 1 << max(1, (n - 1).bit_length())
        nothing = self.above << shift
        # leaf of position i: half + i; a node's value is rank and position in one number
        found = [ranks.get(piece[i : i + 2]) for i in range(n - 1)]
        level = [nothing if rank is None else rank << shift | i for i, rank in enumerate(found)] + [nothing] * (half - n + 1)
        levels = [level]
        while len(level) > 1:
            level = list(map(min, level[::2], level[1::2]))
            levels.append(level)
        tree = [nothing]
        for level in reversed(levels):
            tree += level
        # ends of live tokens, and where the token before begins
        after = list(range(1, n + 2))
        before = list(range(-1, n + 1))
        low = (1 << shift) - 1
        while tree[1] < nothing:
            i = tree[1] & low
            j = after[i]
            k = after[i] = after[j]
            before[k] = i
            changed = [(j, nothing), (i, nothing)]
            if k < n:
                rank = ranks.get(piece[i : after[k]])
                if rank is not None:
                    changed[1] = (i, rank << shift | i)
            h = before[i]
            if h >= 0:
                rank = ranks.get(piece[h:k])
                changed.append((h, nothing if rank is None else rank << shift | h))
            for place, value in changed:
                node = half + place
                if tree[node] == value:
                    continue
                tree[node] = value
                while node > 1:
                    other = tree[node ^ 1]
                    value = value if value < other else other
                    node >>= 1
                    if tree[node] == value:
                        break
                    tree[node] = value
        ids, i = [], 0
        while i < n:
            ids.append(ranks[piece[i : after[i]]])
            i = after[i]
        return ids

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens of ``text``, a list at a time."""
        splitter = self.exact if not text.isascii() and _MAYBE_NEWER.search(text) and _NEWER.search(text) else self.plain
        if len(text) <= STRETCH:
            yield splitter.findall(text)
            return
        matches = splitter.finditer(text)
        while some := [m.group() for m in islice(matches, STRETCH)]:
            yield some

    def encode(self, text: str) -> bytes:
        """The ids of ``text`` as little-endian 32-bit integers, one after the other."""
        if len(self.memory) > REMEMBERED:
            self.memory.clear()
        return b"".join(b"".join(map(self.memory.__getitem__, some)) for some in self.pieces(text))

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(self.tokens[ids].tolist())


class _Memory(dict):
    """Packed ids by pre-token; one that is missing is merged, and kept if it is short."""

    def __init__(self, ranks: Ranks) -> None:
        self.ranks = ranks

    def __missing__(self, piece: str) -> bytes:
        packed = np.array(self.ranks.merge(piece.encode("utf-8", "surrogatepass")), "<u4").tobytes()
        if len(piece) <= SHORT:
            self[piece] = packed
        return packed


def _loaded(path: str, pattern: str) -> Ranks:
    return kept(("ranks", path, pattern), lambda: Ranks(path, pattern))


def _text(value: pa.Scalar) -> str:
    if not value.is_valid:
        return ""
    try:
        return value.as_py()
    except UnicodeDecodeError:
        return value.as_buffer().to_pybytes().decode("utf-8", "replace")


def _lists(column: pa.ListArray) -> Iterator[np.ndarray]:
    """The rows of a column of lists; a null row is empty."""
    offsets, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    for a, b, null in zip(offsets[:-1], offsets[1:], column.is_null(), strict=True):
        yield values[a : a if null.as_py() else b]


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or the columns ``keep``) with ``token_ids``, an array of int, by the rank file at
    ``path`` for whole texts. Special tokens are ordinary text.

    Null counts as empty and has no ids; bytes that are no UTF-8 count as U+FFFD. A column of the
    input named ``token_ids`` is replaced. Every row is encoded by itself: ties, repeated rows and
    empty tables need no rule. Memory holds one batch, its ids, and ``REMEMBERED`` pre-tokens.
    """

    def make() -> Callable[[pa.Array], list[pa.Array]]:
        ranks = _loaded(path, pattern)

        def function(column: pa.Array) -> list[pa.Array]:
            packed = [ranks.encode(_text(value)) for value in column]
            offsets = np.zeros(len(packed) + 1, np.int32)
            np.cumsum([len(p) // 4 for p in packed], out=offsets[1:])
            values = np.frombuffer(b"".join(packed), "<i4").astype(np.int32, copy=False)
            return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))]

        return function

    return with_arrow_columns(docs, text, [("token_ids", T.ArrayType(T.IntegerType()))], make, keep)


def decode(tokens: DataFrame, path: str, pattern: str, ids: str = "token_ids", keep: list[str] | None = None) -> DataFrame:
    """``tokens`` (or the columns ``keep``) with ``decoded``, the bytes of the array of int ``ids``.

    Null decodes to no bytes; an id that the file does not know is an error.
    """

    def make() -> Callable[[pa.Array], list[pa.Array]]:
        ranks = _loaded(path, pattern)
        return lambda column: [pa.array(map(ranks.decode, _lists(column)), pa.binary())]

    return with_arrow_columns(tokens, ids, [("decoded", T.BinaryType())], make, keep)


def with_digest(tokens: DataFrame, ids: str = "token_ids") -> DataFrame:
    """``tokens`` with ``ids_sha256``: lowercase hex over the ids as little-endian 32-bit integers."""

    def function(column: pa.ListArray) -> list[pa.Array]:
        return [pa.array([hashlib.sha256(row.astype("<u4").tobytes()).hexdigest() for row in _lists(column)], pa.string())]

    return with_arrow_columns(tokens, ids, [("ids_sha256", T.StringType())], lambda: function)
