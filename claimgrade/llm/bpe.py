"""Byte-level BPE as a streaming transducer with bounded lookahead, and its inverse.

``Vocabulary`` reads a tokenizer file (merge list, vocabulary, added tokens). ``Encoder`` takes a
text piece by piece and gives out ids as soon as no later character can change them, so its
memory is bounded by the piece, not by the text:

* A space before a visible character always begins a new pre-token, so everything before the
  last such space is stable.
* Inside a run without such a space, a pre-token is stable once the characters after it are
  known.
* Inside one very long pre-token, a token is stable when it ends at least ``lookahead`` bytes
  before the last byte known. The lookahead follows from the merge list: see ``lookahead``.

``Decoder`` turns ids into text through an incremental UTF-8 machine that keeps at most three
pending bytes.
"""

from __future__ import annotations

import codecs
import heapq
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from claimgrade.llm.common import kept, with_arrow_columns

# characters taken from a text at a time
PIECE = 1 << 16
# words whose ids are remembered per Python worker; beyond it the memory starts anew
REMEMBERED = 250_000
# characters of texts whose new words are merged together
TOGETHER = 1 << 20
# bytes of pre-tokens that are merged many at a time, by class
_WIDTHS = (6, 9, 12, 16, 24, 40)
# marks that often end a word and are a pre-token of their own after a letter
_ENDS = frozenset(".,;:!?")

# White space of the pre-tokenizer's pattern (Unicode White_Space).
_S = r"\t-\r \x85\xa0  -     　"
_PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_S}\p{{L}}\p{{N}}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
_OTHER = regex.findall(rf"[{_S}]", "".join(map(chr, (*range(0x0A), *range(0x0B, 0x20), *range(0x21, 0x3001)))))
_PRETOKEN = regex.compile(_PATTERN)
_ODD_SPACE = regex.compile(rf" [{_S}]")
# what continues a pre-token that was given out in part, by its kind
_GO_ON = [regex.compile(p) for p in (r"\p{L}+", r"\p{N}+", rf"[^{_S}\p{{L}}\p{{N}}]+", rf"[{_S}]+(?![^{_S}])|[{_S}]+")]


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins of the 256 bytes in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def lookahead(merges: Iterable[tuple[bytes, bytes]]) -> int:
    """Bytes before the end of the known text within which a token may still change.

    Compare two texts that agree up to some byte. While the rules are applied in order, the
    first place where the two token sequences differ moves to the left only if a rule (u, v)
    fires in one of them, with u ending at that place and v beginning there; it then moves by
    the length of u, and the token that now begins at the place begins with u. A later rule can
    move it on only if its right part begins with u. The longest such chain, by rules in rising
    order, bounds the distance.
    """
    reach: dict[bytes, int] = {}
    most = 0
    for left, right in merges:
        before = max((reach.get(right[:n], 0) for n in range(1, len(right) + 1)), default=0)
        far = before + len(left)
        if far > reach.get(left, 0):
            reach[left] = far
        most = max(most, far)
    return most


def _packed(ids: Iterable[int]) -> bytes:
    return np.fromiter(ids, np.int32).tobytes()


class Vocabulary:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        self.bytes_of: dict[int, bytes] = {}
        by_bytes: dict[bytes, int] = {}
        for word, i in spec["model"]["vocab"].items():
            raw = bytes(letters[c] for c in word) if all(c in letters for c in word) else word.encode()
            self.bytes_of[i] = raw
            by_bytes[raw] = i
        self.byte_ids = [by_bytes.get(bytes([b])) for b in range(256)]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        pairs = []
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b = (bytes(letters[c] for c in x) for x in (left, right))
            pairs.append((a, b))
            self.merges[by_bytes[a], by_bytes[b]] = (rank, by_bytes[a + b])
        self.lookahead = lookahead(pairs)
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        for word, i in self.added.items():
            self.bytes_of[i] = word.encode()
        self._tables()
        self.ends = {c: _packed(self.merge(c.encode())) for c in _ENDS}
        self.split = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None

    def _tables(self) -> None:
        """The rules as arrays: sorted pairs, and those of two bytes by byte (256: none)."""
        pairs = np.array([(a << 32 | b, rank, new) for (a, b), (rank, new) in self.merges.items()], np.int64).reshape(-1, 3)
        pairs = pairs[np.argsort(pairs[:, 0])]
        self.none = np.int32(len(pairs))
        self.keys, self.rank_of = np.r_[pairs[:, 0], -1], np.r_[pairs[:, 1], self.none].astype(np.int32)
        self.made = np.zeros(len(pairs) + 1, np.int32)
        self.made[pairs[:, 1]] = pairs[:, 2]
        self.of_byte = np.array([*(-1 if i is None else i for i in self.byte_ids), -1], np.int32)
        first, second = np.repeat(self.of_byte, 257), np.tile(self.of_byte, 257)
        self.of_bytes = self._ranks(first, second).reshape(257, 257)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the rule for each pair of ids; ``none`` where there is no rule."""
        wanted = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys[:-1], wanted)
        return np.where((self.keys[at] == wanted) & (left >= 0) & (right >= 0), self.rank_of[at], self.none)

    def merge_many(self, words: list[bytes]) -> list[bytes]:
        """``merge`` of many pre-tokens, packed: all of a class advance together by one rule a round."""
        out: list = [None] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        below = 0
        for width in _WIDTHS:
            which = np.flatnonzero((sizes > below) & (sizes <= width))
            below = width
            if not len(which):
                continue
            bytes_ = np.full((len(which), width), 256, np.int16)
            filled = np.arange(width) < sizes[which][:, None]
            bytes_[filled] = np.frombuffer(b"".join([words[i] for i in which.tolist()]), np.uint8)
            ids, rank = self.of_byte[bytes_], self.of_bytes[bytes_[:, :-1], bytes_[:, 1:]]
            while len(which):
                at = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(which), np.int64)
                best = rank[np.arange(len(which)), at] if rank.shape[1] else np.full(len(which), self.none)
                done = best == self.none
                if done.any():
                    ended = ids[done]
                    ends = (4 * (ended >= 0).sum(axis=1)).tolist()
                    data, size = ended.tobytes(), 4 * ended.shape[1]
                    for k, (i, end) in enumerate(zip(which[done].tolist(), ends, strict=True)):
                        out[i] = data[k * size : k * size + end]
                    go = ~done
                    which, ids, rank, at, best = which[go], ids[go], rank[go], at[go], best[go]
                    if not len(which):
                        break
                rows, wide = np.arange(len(which)), ids.shape[1]
                new = self.made[best]
                ids[rows, at] = new
                ids = ids[np.arange(wide) != at[:, None] + 1].reshape(len(rows), wide - 1)
                rank = rank[np.arange(wide - 1) != at[:, None]].reshape(len(rows), wide - 2)
                left = np.flatnonzero(at > 0)
                rank[left, at[left] - 1] = self._ranks(ids[left, at[left] - 1], new[left])
                right = np.flatnonzero(at < wide - 2)
                rank[right, at[right]] = self._ranks(new[right], ids[right, at[right] + 1])
        for i in np.flatnonzero((sizes > below) | (sizes == 0)).tolist():
            out[i] = _packed(self.merge(words[i]))
        return out

    def merge(self, data: bytes) -> list[int]:
        """Ids of one pre-token: the lowest rule first, from the left, until none applies."""
        ids = [self.byte_ids[b] for b in data]
        rules = self.merges
        if len(ids) <= 40:
            while len(ids) > 1:
                rule = min((rules[p] for p in zip(ids, ids[1:], strict=False) if p in rules), default=None)
                if rule is None:
                    break
                new, i, out = rule[1], 0, []
                while i < len(ids):
                    if i + 1 < len(ids) and rules.get((ids[i], ids[i + 1])) == rule:
                        out.append(new)
                        i += 2
                    else:
                        out.append(ids[i])
                        i += 1
                ids = out
            return ids
        after, before = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
        heap = [(*rules[p], i, p) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in rules]
        heapq.heapify(heap)
        while heap:
            _, new, i, pair = heapq.heappop(heap)
            j = after[i]
            if j < 0 or (ids[i], ids[j]) != pair:
                continue
            ids[i], ids[j] = new, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            after[j] = -1
            for x in (before[i], i):
                if x >= 0 and after[x] >= 0 and (p := (ids[x], ids[after[x]])) in rules:
                    heapq.heappush(heap, (*rules[p], x, p))
        return [i for i in ids if i >= 0]


class _Words(dict):
    """Packed ids of the words of a text, remembered for the words met last. A word stands with
    the space before it, unless it begins with a line feed or is the ``first`` of its text."""

    def __init__(self, vocabulary: Vocabulary, first: bool = False):
        self.vocabulary, self.first = vocabulary, first

    def _split(self, word: str) -> list[str]:
        if not self.first and word[:1] != "\n":
            return [" " + word] if word.isalpha() else _PRETOKEN.findall(" " + word)
        return _PRETOKEN.findall(word)

    def prepare(self, words: set[str]) -> None:
        """Remembers the ids of all of these words that are new."""
        new = [w for w in words.difference(self) if len(w) <= 64]
        if len(self) + len(new) > REMEMBERED:
            self.clear()
            new = [w for w in words if len(w) <= 64]
        for at in range(0, len(new), REMEMBERED):
            part = new[at : at + REMEMBERED]
            plain = [w for w in part if w.isalpha()]
            self.update(zip(plain, self._spaced(plain), strict=True))
            ended = [w for w in part if w[-1:] in _ENDS and w[:-1].isalpha()]
            ends = map(self.vocabulary.ends.__getitem__, [w[-1] for w in ended])
            self.update(zip(ended, map(bytes.__add__, self._spaced([w[:-1] for w in ended]), ends), strict=True))
            rest = [w for w in part if not w.isalpha() and not (w[-1:] in _ENDS and w[:-1].isalpha())]
            split = list(map(self._split, rest))
            ids = iter(self.vocabulary.merge_many([p.encode() for ps in split for p in ps]))
            self.update((w, b"".join([next(ids) for _ in pieces])) for w, pieces in zip(rest, split, strict=True))

    def _spaced(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters with a space before each."""
        return self.vocabulary.merge_many((" " + "\0 ".join(words)).encode().split(b"\0")) if words else []

    def __missing__(self, word: str) -> bytes:
        merge = self.vocabulary.merge
        ids = b"".join([_packed(merge(p.encode())) for p in self._split(word)])
        if len(word) <= 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = ids
        return ids


class Encoder:
    """One text in pieces: ``feed`` returns the ids that became stable, ``finish`` the rest."""

    def __init__(self, vocabulary: Vocabulary, words: tuple[_Words, _Words] | None = None, most: int = PIECE):
        self.vocabulary = vocabulary
        self.first, self.words = words or (_Words(vocabulary, True), _Words(vocabulary))
        self.window = max(4 * vocabulary.lookahead, 4096)
        self.most = max(most, 2 * self.window)
        self.hold = max(map(len, vocabulary.added), default=1) - 1
        self.text = ""
        self._forget()

    def _forget(self) -> None:
        """No pre-token is open: ``bytes`` of it still wait, and its ``kind`` is unknown."""
        self.bytes, self.kind = b"", None

    def _whole(self, text: str) -> bytes:
        """Ids of a text that begins and ends at pre-token borders."""
        words = text.replace("\n", " \n").split(" ")
        first, rest = words[0], words[1:]
        # single spaces and line feeds between words, no other white space
        if "" not in rest and "\n" not in rest and not any(c in text for c in _OTHER):
            return self.first[first] + b"".join(map(self.words.__getitem__, rest))
        merge = self.vocabulary.merge
        return b"".join([_packed(merge(p.encode())) if len(p) > 64 else self.first[p] for p in _PRETOKEN.findall(text)])

    def _long(self, last: bool) -> bytes:
        """Ids from a text without a safe border; unless ``last``, what may change is kept."""
        out, text, merge = [], self.text, self.vocabulary.merge
        # an added token may begin in the last ``hold`` characters; three more decide contractions
        end = len(text) if last else max(0, len(text) - max(self.hold, 3))
        at = 0
        while at < len(text) or (last and self.bytes):
            found = (_GO_ON[self.kind] if self.kind is not None else _PRETOKEN).match(text, at)
            stop = found.end() if found else at
            if self.kind is not None and stop == at:  # the open pre-token has ended
                out += merge(self.bytes)
                self._forget()
                continue
            if last or stop < end:
                out += merge(self.bytes + text[at:stop].encode())
                self._forget()
                at = stop
                continue
            # the last pre-token is open: windows of it become stable
            whole = text[at : max(at, end - 1)]
            if len(whole) <= self.window:
                break
            if self.kind is None:
                self.kind = next(i for i, p in enumerate(_GO_ON) if p.match(whole[1] if whole[0] == " " and not whole[1].isspace() else whole[0]))
            self.bytes += whole.encode()
            at += len(whole)
            while len(self.bytes) > self.window:
                sure, size = self.window - self.vocabulary.lookahead, 0
                for i in merge(self.bytes[: self.window]):
                    size += len(self.vocabulary.bytes_of[i])
                    if size > sure:
                        size -= len(self.vocabulary.bytes_of[i])
                        break
                    out.append(i)
                self.bytes = self.bytes[size:]
            break
        self.text = text[at:]
        return _packed(out)

    def _part(self, last: bool) -> bytes:
        if self.kind is not None or (len(self.text) > self.most and " " not in self.text):
            out = self._long(last)
            if self.kind is not None or last:
                return out
            return out + self._part(last)
        if last:
            out, self.text = self._whole(self.text), ""
            return out
        cut = len(self.text) - max(self.hold, 1)
        while (cut := self.text.rfind(" ", 0, max(0, cut))) > 0:
            if not _ODD_SPACE.match(self.text, cut):
                out, self.text = self._whole(self.text[:cut]), self.text[cut:]
                return out
        return self._long(False) if len(self.text) > self.most else b""

    def feed(self, piece: str) -> np.ndarray:
        out = b""
        self.text += piece
        while self.vocabulary.split and (found := self.vocabulary.split.search(self.text)):
            rest, self.text = self.text[found.end() :], self.text[: found.start()]
            out += self._part(True) + _packed([self.vocabulary.added[found.group()]])
            self._forget()
            self.text = rest
        return np.frombuffer(out + self._part(False), np.int32)

    def finish(self) -> np.ndarray:
        out = self._part(True)
        self._forget()
        return np.frombuffer(out, np.int32)


class Decoder:
    """Ids in blocks to text; bytes that are not UTF-8 become U+FFFD."""

    def __init__(self, vocabulary: Vocabulary):
        self.bytes_of = vocabulary.bytes_of
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.machine.decode(b"".join(map(self.bytes_of.__getitem__, ids)))

    def finish(self) -> str:
        return self.machine.decode(b"", True)


def encode_pieces(pieces: Iterable[str], vocabulary: Vocabulary, words=None) -> Iterator[np.ndarray]:
    encoder = Encoder(vocabulary, words)
    for piece in pieces:
        yield encoder.feed(piece)
    yield encoder.finish()


def _loaded(path: str) -> tuple[Vocabulary, tuple[_Words, _Words]]:
    def build():
        vocabulary = Vocabulary(path)
        return vocabulary, (_Words(vocabulary, True), _Words(vocabulary))

    return kept(("bpe", path), build)


def _batches(column: pa.Array) -> Iterator[list[str]]:
    """The texts (null: empty) in groups of about ``TOGETHER`` characters."""
    texts, size = [], 0
    for value in column:
        texts.append(value.as_py() or "")
        size += len(texts[-1])
        if size >= TOGETHER:
            yield texts
            texts, size = [], 0
    if texts:
        yield texts


def encode(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``token_ids`` array<int>, the encoding of the whole text (null: empty).

    ``path`` is that of a byte-level BPE tokenizer file, readable on every executor. The strings
    of added tokens in a text become these tokens.
    """

    def make():
        vocabulary, words = _loaded(path)

        def function(column: pa.Array) -> list[pa.Array]:
            sizes, blocks = [0], []
            for texts in _batches(column):
                words[1].prepare({w for t in texts for w in t.replace("\n", " \n").split(" ")})
                for value in texts:
                    n = 0
                    pieces = (value[i : i + PIECE] for i in range(0, len(value), PIECE))
                    for ids in encode_pieces(pieces, vocabulary, words):
                        blocks.append(ids)
                        n += len(ids)
                    sizes.append(n)
            flat = np.concatenate([*blocks, np.zeros(0, np.int32)])
            return [pa.ListArray.from_arrays(np.cumsum(sizes).astype(np.int32), flat)]

        return function

    return with_arrow_columns(docs, text, [("token_ids", T.ArrayType(T.IntegerType()))], make, keep)


def decode(tokens: DataFrame, path: str, ids: str = "token_ids", keep: list[str] | None = None) -> DataFrame:
    """``tokens`` with ``decoded``, the text of the ids (null: empty)."""

    def make():
        vocabulary, _ = _loaded(path)

        def function(column: pa.Array) -> list[pa.Array]:
            out = []
            for value in column:
                decoder, found = Decoder(vocabulary), value.values.to_numpy() if value.is_valid else np.zeros(0, int)
                text = [decoder.feed(found[i : i + PIECE].tolist()) for i in range(0, len(found), PIECE)]
                out.append("".join([*text, decoder.finish()]))
            return [pa.array(out, pa.string())]

        return function

    return with_arrow_columns(tokens, ids, [("decoded", T.StringType())], make, keep)
