"""Quality by nearest-neighbour voting in a latent semantic space.

A text becomes counts of hashed words, of word shapes and of a few kinds of repetition, over its
whole length. The labelled sample fixes the inverse frequencies and, by a singular value
decomposition, the latent directions. Every document is then compared with every labelled vector
by exact cosine products in blocks; its nearest neighbours vote, weighted by similarity.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimgrade.llm.common import kept, with_arrow_columns

# Bound of the labelled sample, in rows. It bounds what is broadcast: so many vectors of RANK.
SAMPLE = 3000
WORDS, SHAPES = 512, 512
# whether a word is the one before it; whether a pair of words stood in the text before; lines
EXTRA = 3
WIDTH = WORDS + SHAPES + EXTRA
RANK = 64
NEIGHBOURS = 25
# similarities count to this power
SHARPNESS = 4
REMEMBERED = 200_000
_SHAPE = bytes.maketrans(
    bytes(range(256)),
    bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256)),
)
# a run of one byte
_RUN = re.compile(rb"(.)\1+", re.DOTALL)


class _Codes(dict):
    """Word to its hashed word in the low half and its hashed shape in the high half."""

    def __missing__(self, word: bytes) -> int:
        shape = word.translate(_SHAPE)
        # runs of one class stand once
        short = _RUN.sub(rb"\1", shape)
        code = xxhash.xxh32_intdigest(word.lower()) % WORDS | xxhash.xxh32_intdigest(short, 1) % SHAPES << 16
        if len(self) >= REMEMBERED:
            self.clear()
        if len(word) <= 64:
            self[word] = code
        return code


def _codes() -> _Codes:
    return kept("word codes", _Codes)


def counts(text: str | None) -> np.ndarray:
    """The feature counts of a whole text; a text without words has none."""
    out = np.zeros(WIDTH, np.float32)
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return out
    codes = np.fromiter(map(_codes().__getitem__, words), np.int64, len(words))
    out[:WORDS] = np.bincount(codes & 0xFFFF, minlength=WORDS)
    out[WORDS : WORDS + SHAPES] = np.bincount(codes >> 16, minlength=SHAPES)
    pairs = codes[1:] * 0x9E3779B1 + codes[:-1]
    out[-3] = np.count_nonzero(codes[1:] == codes[:-1])
    out[-2] = len(pairs) - len(np.unique(pairs))
    out[-1] = raw.count(b"\n")
    return out


def features(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``counts``, the feature counts as little-endian 32-bit floats."""

    def make():
        def function(column: pa.Array) -> list[pa.Array]:
            return [pa.array([counts(t.as_py()).tobytes() for t in column], pa.binary())]

        return function

    return with_arrow_columns(docs, text, [("counts", T.BinaryType())], make, keep)


@dataclass
class Model:
    """Inverse frequencies, latent directions, and the labelled vectors with their labels."""

    idf: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def latent(self, rows: np.ndarray) -> np.ndarray:
        return _unit(_unit(np.log1p(rows) * self.idf) @ self.directions)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Share of label 1 among the nearest labelled vectors, weighted by similarity; rows
        similar to none get the share in the sample."""
        if not len(self.labels):
            return np.full(len(rows), 0.5)
        prior = float(self.labels.mean())
        out = np.empty(len(rows))
        for at in range(0, len(rows), 512):
            near = self.latent(rows[at : at + 512]) @ self.vectors.T
            k = min(NEIGHBOURS, near.shape[1])
            top = np.argpartition(-near, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(near, top, axis=1), 0).astype(float) ** SHARPNESS
            # a little of the sample's share, so that weak neighbours do not decide alone
            out[at : at + 512] = ((weight * self.labels[top]).sum(axis=1) + 1e-3 * prior) / (weight.sum(axis=1) + 1e-3)
        return np.clip(out, 0.0, 1.0)


def _unit(x: np.ndarray) -> np.ndarray:
    return (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def fit(labelled: DataFrame, text: str = "text", label: str = "quality") -> Model:
    """Model from ``labelled``, a bounded table of texts with label 0 or 1."""
    rows = features(labelled, text, keep=[label]).collect()
    found = np.array([np.frombuffer(r["counts"], np.float32) for r in rows]).reshape(-1, WIDTH)
    labels = np.array([float(r[label]) for r in rows])
    seen = (found > 0).sum(axis=0)
    idf = np.log((1 + len(found)) / (1 + seen)).astype(np.float32) + 1
    weighted = _unit(np.log1p(found) * idf)
    values, vectors = np.linalg.eigh(weighted.T.astype(float) @ weighted)
    directions = vectors[:, np.argsort(-values)[:RANK]].astype(np.float32)
    model = Model(idf, directions, np.zeros((0, RANK), np.float32), labels)
    model.vectors = model.latent(found)
    return model


def sample(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text", rows: int = SAMPLE) -> DataFrame:
    """At most ``rows`` labelled texts, in the order of a hash of the id. Labels that are null are
    no labels; an id with several labels counts with its smallest."""
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(doc_id).agg(F.min(label).alias("__label"))
    chosen = known.orderBy(F.xxhash64(doc_id), doc_id).limit(rows)
    found = docs.select(F.col(doc_id), F.col(text).alias("__text")).join(F.broadcast(chosen), doc_id)
    # rows that repeat an id are more than the bound says: keep it
    return found.orderBy(F.xxhash64(doc_id), doc_id, "__text").limit(rows).select(F.col("__text").alias(text), F.col("__label").alias(label))


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: label 1 is likelier). A null text counts as empty;
    an empty text gets the share of label 1 in the sample, and without any label 0.5."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable:
        def function(column: pa.Array) -> list[pa.Array]:
            rows = [counts(t.as_py()) for t in column]
            out = [shared.value.scores(np.array(rows[i : i + 512])) for i in range(0, len(rows), 512)]
            return [pa.array(np.concatenate([*out, np.zeros(0)]), pa.float64())]

        return function

    return with_arrow_columns(docs, text, [("score", T.DoubleType())], make, keep)
