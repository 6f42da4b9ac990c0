"""Language identification by cross-parsing against suffix automata of labelled text.

For every language a suffix automaton recognises the factors of a bounded sample of labelled
text. A text is parsed from left to right into phrases, each the longest match in that sample;
the language that needs the fewest phrases, normalised by the logarithm of its sample's length,
wins. Texts are parsed whole: pieces of ``PIECE`` letters go forward together, and each is then
parsed again from where the piece before really ended, until both parses agree.

Letters are lower-cased; every run of other characters is one separator. Every letter of the
samples is told from every other one; letters that no sample has match nothing.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from claimgrade.llm.common import kept, with_arrow_columns

# Bound of the labelled sample: so many characters, from at most so many rows, per language.
SAMPLE_CHARS = 32_768
SAMPLE_ROWS = 64
PIECE = 1024
UNKNOWN = "und"


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> dict[str, str]:
    """A bounded sample of text per language: even shares of texts in the order of a hash of their id.

    Rows without text or language are ignored. At most ``SAMPLE_ROWS`` texts of a language share
    ``SAMPLE_CHARS`` characters: short ones are taken whole, of the others a stretch whose place
    is drawn by the hash, so that no long text is a language's whole sample.
    """
    size, h = F.length("text"), F.xxhash64(F.col(f"`{doc_id}`"))
    rows = labelled.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"), h.alias("h"), F.col(f"`{doc_id}`").alias("id"))
    at = 1 + F.pmod("h", F.greatest(size - SAMPLE_CHARS, F.lit(0)) + 1)
    # no text of more than the whole sample's length is moved
    rows = rows.where("lang IS NOT NULL AND text RLIKE '\\\\p{L}'").withColumn("text", F.substring("text", at.cast("int"), F.lit(SAMPLE_CHARS)))
    order = Window.partitionBy("lang").orderBy("h", "id", "text")
    found = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= SAMPLE_ROWS).orderBy("lang", "n")
    texts: dict[str, list[tuple[str, int]]] = {}
    for row in found.select("lang", "text", "h").toLocalIterator():
        texts.setdefault(row["lang"], []).append((row["text"], row["h"]))
    return {name: _shared_out(rows) for name, rows in texts.items()}


def _shared_out(rows: list[tuple[str, int]]) -> str:
    """Stretches of the texts, joined by spaces, of at most ``SAMPLE_CHARS`` characters together."""
    left = SAMPLE_CHARS
    cut = {}
    # short texts first: what they do not need goes to the longer ones
    for rank, i in enumerate(sorted(range(len(rows)), key=lambda i: len(rows[i][0]))):
        text, h = rows[i]
        size = min(len(text), max(left // (len(rows) - rank) - 1, 0))
        at = h % (len(text) - size + 1)
        cut[i] = text[at : at + size]
        left -= size + 1
    return " ".join(cut[i] for i in range(len(rows)))


@functools.cache
def _is_letter() -> np.ndarray:
    return np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def _classes(points: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Class of each letter; runs of other characters become one 0."""
    found = classes[points]
    zero = found == 0
    keep = ~zero
    keep[1:] |= ~zero[:-1]
    return found[keep]


def _transitions(word: list[int]) -> list[dict[int, int]]:
    """Transitions of the states of the suffix automaton of ``word``; state 0 is the root."""
    next_, link, length = [{}], [-1], [0]
    last = 0
    for c in word:
        now = len(next_)
        next_.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in next_[p]:
            next_[p][c] = now
            p = link[p]
        if p >= 0:
            q = next_[p][c]
            if length[p] + 1 == length[q]:
                link[now] = q
            else:
                twin = len(next_)
                next_.append(dict(next_[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and next_[p].get(c) == q:
                    next_[p][c] = twin
                    p = link[p]
                link[q] = link[now] = twin
        last = now
    return next_


class Automaton:
    """A suffix automaton whose sparse transitions share one pair of arrays.

    The transition of ``state`` by ``letter`` stands at ``base[state] + letter`` if ``check`` has
    ``state`` there, so memory follows the transitions and not states times letters. State
    ``start`` is that before the first letter and after a letter the sample does not have.
    """

    def __init__(self, word: list[int], alphabet: int):
        next_ = _transitions(word)
        self.start = len(next_)
        self.size = len(word)
        base = np.zeros(self.start + 1, np.int32)
        # free places are searched from ``low`` on; behind ``top`` all are free
        used, low, top = bytearray(4 * alphabet), alphabet, alphabet - 1
        check, target = [], []
        for state in sorted((i for i, x in enumerate(next_) if x), key=lambda i: -len(next_[i])):
            moves = next_[state]
            first = min(moves)
            rest = [c - first for c in moves]
            at, tries = used.find(0, low), 0
            while any(used[at + r] for r in rest):
                at, tries = used.find(0, at + 1), tries + 1
            if tries > 32 or len(rest) == 1:
                # what comes before is too crowded to be searched again
                low = at
            base[state] = at - first
            for c, t in moves.items():
                used[at + c - first] = 1
                check.append((at + c - first, state))
                target.append(t)
            top = max(top, at + max(rest))
            if top + 2 * alphabet >= len(used):
                used.extend(bytes(len(used)))
        length = max((p for p, _ in check), default=0) + alphabet + 1
        self.base = base
        self.check = np.full(length, -1, np.int32)
        self.target = np.zeros(length, np.int32)
        places = np.fromiter((p for p, _ in check), np.int64, len(check))
        self.check[places] = np.fromiter((x for _, x in check), np.int32, len(check))
        self.target[places] = target
        self.root = np.full(alphabet, self.start, np.int32)
        self.root[list(next_[0])] = list(next_[0].values())

    def step(self, states: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states, and whether a new phrase begins with the letter."""
        places = self.base[states] + letters
        new = self.check[places] != states
        return np.where(new, self.root[letters], self.target[places]), new

    def run(self, state: int, letters: np.ndarray) -> tuple[int, int]:
        """State after the letters, and the phrases that begin in them."""
        base, check, target, root = map(memoryview, (self.base, self.check, self.target, self.root))
        phrases = 0
        for c in letters.tolist():
            place = base[state] + c
            if check[place] == state:
                state = target[place]
            else:
                state = root[c]
                phrases += 1
        return state, phrases


class Parser:
    """Counts the phrases of texts against the sample of every language."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        points = {k: _points(samples[k]) for k in self.languages}
        own = np.unique(np.concatenate([np.zeros(0, np.uint32), *points.values()]))
        own = own[_is_letter()[own]]
        # class 0 separates, class 1 has the letters of no sample
        self.classes = _is_letter().astype(np.int32)
        self.classes[own] = 2 + np.arange(len(own))
        words = [_classes(points[k], self.classes) for k in self.languages]
        self.automata = [Automaton(w.tolist(), 2 + len(own)) for w in words]
        self.bits = np.log2([len(w) + 1 for w in words])

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Number of phrases of each text for each language."""
        streams = [_classes(_points(t), self.classes) if t else np.zeros(0, np.int32) for t in texts]
        sizes = np.array([len(s) for s in streams], np.int64)
        flat = np.concatenate([*streams, np.zeros(0, np.int32)])
        pieces = -(-sizes // PIECE)
        owner = np.repeat(np.arange(len(texts)), pieces)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = np.repeat(np.cumsum(sizes) - sizes, pieces) + within * PIECE
        length = np.minimum(PIECE, sizes[owner] - within * PIECE)
        out = np.zeros((len(texts), len(self.languages)), np.int64)
        if not len(owner):
            return out
        for i, (state, count) in enumerate(self._apart(flat, begin, length)):
            self._join(self.automata[i], flat, begin, length, within > 0, state, count)
            np.add.at(out[:, i], owner, count)
        return out

    def _apart(self, flat: np.ndarray, begin: np.ndarray, length: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Last state and number of phrases of each piece by itself, for each language."""
        order = np.argsort(-length, kind="stable")
        # all pieces go forward together, one letter at a time; the ended ones drop off the end
        active = np.searchsorted(-length[order], -np.arange(length.max()), side="left")
        begin = begin[order]
        states = [np.full(len(order), a.start, np.int32) for a in self.automata]
        counts = [np.zeros(len(order), np.int64) for _ in self.automata]
        for step, width in enumerate(active.tolist()):
            letters = flat[begin[:width] + step]
            for state, count, automaton in zip(states, counts, self.automata, strict=True):
                state[:width], new = automaton.step(state[:width], letters)
                count[:width] += new
        back = np.argsort(order)
        return [(s[back], c[back]) for s, c in zip(states, counts, strict=True)]

    @staticmethod
    def _join(automaton: Automaton, flat: np.ndarray, begin: np.ndarray, length: np.ndarray, follows: np.ndarray, ends: np.ndarray, count: np.ndarray) -> None:
        """Corrects ``count``, the phrases of the pieces by themselves, to those of whole texts.

        A piece that follows another is parsed from the state that one ended in beside the parse
        from the start, until both are in one state. Pieces where they never are, and those
        after them for as long as it matters, are parsed one after the other.
        """
        lanes = np.flatnonzero(follows)
        real = ends[lanes - 1]
        alone = np.full(len(lanes), automaton.start, np.int32)
        apart = np.zeros(0, np.int64)
        step = 0
        while True:
            open_ = real != alone
            lanes, real, alone = lanes[open_], real[open_], alone[open_]
            over = length[lanes] <= step
            apart = np.concatenate([apart, lanes[over]])
            lanes, real, alone = lanes[~over], real[~over], alone[~over]
            if not len(lanes):
                break
            letters = flat[begin[lanes] + step]
            real, new = automaton.step(real, letters)
            alone, other = automaton.step(alone, letters)
            count[lanes] += new.astype(np.int64) - other
            step += 1
        last = -1
        for i in np.sort(apart).tolist():
            if i <= last:
                continue
            state = int(ends[i - 1])
            while True:
                state, count[i] = automaton.run(state, flat[begin[i] : begin[i] + length[i]])
                last = i
                if state == ends[i] or i + 1 == len(ends) or not follows[i + 1]:
                    break
                i += 1

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; the score is the posterior of the winner when
        phrases cost their logarithmic code length."""
        texts = [t or "" for t in texts]
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        found = np.zeros((len(texts), len(self.languages)))
        # bounded batches: a few million letters at a time
        start, size = 0, 0
        for i, t in enumerate(texts):
            size += len(t)
            if size > 4_000_000 or i == len(texts) - 1:
                found[start : i + 1] = self.phrases(texts[start : i + 1])
                start, size = i + 1, 0
        cost = found * self.bits * np.log(2)
        best = cost.argmin(axis=1)
        score = 1 / np.exp(np.minimum(0, cost.min(axis=1, keepdims=True) - cost)).sum(axis=1)
        letters = [bool(t) and any(map(str.isalpha, t)) for t in texts]
        names = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), letters, strict=True)]
        return names, np.where(letters, score, 0.0)


def identify(docs: DataFrame, samples: dict[str, str], text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1).

    A text that is null or has no letter gets ``und`` and score 0, and so does every text when
    no language was learned. Ties go to the first language by code point. The samples are
    broadcast: at most ``SAMPLE_CHARS`` characters per language; the automata are built once
    per Python worker.
    """
    model = docs.sparkSession.sparkContext.broadcast(tuple(sorted(samples.items())))

    def make():
        parser = kept(("language", model.value), lambda: Parser(dict(model.value)))

        def function(column: pa.Array) -> list[pa.Array]:
            names, score = parser.predict(column.to_pylist())
            return [pa.array(names, pa.string()), pa.array(score, pa.float64())]

        return function

    return with_arrow_columns(docs, text, [("lang_pred", T.StringType()), ("score", T.DoubleType())], make, keep)


def held_out(doc_id: str, parts: int, part: int) -> F.Column:
    """True where crc32 of the id as text leaves ``part``; an id that is null is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % parts == part, F.lit(False))
