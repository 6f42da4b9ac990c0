"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint has a bit set where over half the hashes of the text's shingles have it. Masks from
a Hadamard code cover every pair within the radius: bit i has a nonzero vector m(i) of
radius + 1 bits, and table v (a nonzero vector too) keeps the bits with <m(i), v> = 1. For any
``radius`` differing bits some v is orthogonal to all their vectors, so the pair agrees on what
table v keeps. A table's key that too many fingerprints share is split by the same construction
over the bits it leaves free; after three levels a key leaves so few bits free that its
fingerprints are few by necessity. No pair is lost and no bucket is unbounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimgrade.llm.common import shuffle_parts, stored, unused, with_arrow_columns
from claimgrade.llm.graph import components

SEED = 42
RADIUS = 2
# fingerprints compared with each other in one bucket; larger buckets are split
BUCKET = 512
LEVELS = 3
_BLOCK = 1 << 15


def _fingerprint(text: str | None, width: int) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    many = max(1, len(words) - width + 1)
    votes = np.zeros(64, np.int64)
    for i in range(0, many, _BLOCK):
        part = words[i : i + _BLOCK + width - 1]
        shingles = map(b" ".join, zip(*(part[k:] for k in range(width)), strict=False)) if len(words) >= width else [b" ".join(words)]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.dtype(">u8"))
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > many).tobytes(), "big", signed=True)


def of_hashes(hashes: np.ndarray) -> int:
    """The fingerprint of some 64-bit hashes, each counted as often as it stands there; 0 for none."""
    votes = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _BLOCK):
        part = hashes[i : i + _BLOCK].astype(np.dtype(">u8"))
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, text: str = "text", width: int = 3, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``simhash`` (long) of the whole text: words without white space, A-Z in lower
    case, shingles of ``width`` words, repeats included. A text with fewer words is one shingle;
    a text without words, or null, has fingerprint 0."""

    def make():
        def function(column: pa.Array) -> list[pa.Array]:
            return [pa.array([_fingerprint(t.as_py(), width) for t in column], pa.int64())]

        return function

    return with_arrow_columns(docs, text, [("simhash", T.LongType())], make, keep)


def covering_masks(bits: list[int], radius: int) -> list[int]:
    """Masks over ``bits`` such that any ``radius`` of them are outside some mask."""
    vectors = 2 ** (radius + 1)
    of = {bit: 1 + i % (vectors - 1) for i, bit in enumerate(bits)}
    return [sum(1 << b for b in bits if (of[b] & v).bit_count() % 2) for v in range(1, vectors)]


def _paths(level: int, radius: int) -> list[int]:
    """Masks of a level by path, the masks chosen at the levels above included."""
    masks = [0]
    for _ in range(level):
        masks = [m | more for m in masks for more in covering_masks([b for b in range(64) if not m >> b & 1], radius)]
    return masks


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _joined(values: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links among some fingerprints."""
    left = np.ones(len(values), bool)
    for i in range(len(values)):
        if not left[i]:
            continue
        left[i] = False
        todo = [i]
        while todo:
            at = todo.pop()
            near = np.flatnonzero(left & (np.bitwise_count(values ^ values[at]) <= radius))
            left[near] = False
            todo += near.tolist()
            yield from ((int(values[k]), int(values[at])) for k in near)


def _bucket_links(rows: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) inside the buckets (path, key) of ``rows`` (path, key, fp)."""
    spark = rows.sparkSession
    dealt = rows.repartition(shuffle_parts(spark), "path", "key").sortWithinPartitions("path", "key", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            path, key, fp = (batch.column(i).to_numpy() for i in range(3))
            if rest is not None:
                path, key, fp = (np.concatenate(x) for x in zip(rest, (path, key, fp), strict=True))
            if not len(fp):
                continue
            starts = np.flatnonzero(np.r_[True, (path[1:] != path[:-1]) | (key[1:] != key[:-1])])
            yield links(fp[: starts[-1]], starts)  # the last bucket may go on in the next batch
            rest = (path[starts[-1] :], key[starts[-1] :], fp[starts[-1] :])
        if rest is not None:
            yield links(rest[2], np.array([0, len(rest[2])]))

    def links(fp: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
        found: list[tuple[int, int]] = []
        sizes = np.diff(starts)
        two = starts[:-1][sizes == 2]
        two = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= radius] if len(two) else two
        for at, size in zip(starts[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            found += _joined(fp[at : at + size], radius)
        a = np.r_[fp[two + 1] if len(two) else fp[:0], np.array([x[0] for x in found], np.int64)]
        b = np.r_[fp[two] if len(two) else fp[:0], np.array([x[1] for x in found], np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def fingerprint_links(values: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) among the distinct fingerprints in column ``fp``: a forest with the same
    components as all pairs that differ in at most ``radius`` bits."""
    spark = values.sparkSession
    found = spark.createDataFrame([], "a long, b long")
    rest = values.select("fp")
    for level in range(1, LEVELS + 1):
        masks = F.array(*[F.lit(_signed(m)) for m in _paths(level, radius)])
        split = 2 ** (radius + 1) - 1
        if level == 1:
            rest = rest.withColumn("path", F.lit(0))
        rows = (
            rest.withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(split - 1))))
            .withColumn("path", (F.col("path") * split + F.col("v")).cast("int"))
            .withColumn("key", F.col("fp").bitwiseAND(F.get(masks, F.col("path"))))
            .select("path", "key", "fp")
        )
        if level > 1:
            rows = rows.distinct()
        if level == LEVELS:
            return found.unionAll(_bucket_links(rows, radius))
        large = stored(rows.groupBy("path", "key").count().where(F.col("count") > BUCKET).drop("count"), "large")
        if large.isEmpty():
            return found.unionAll(_bucket_links(rows, radius))
        found = found.unionAll(_bucket_links(rows.join(large, ["path", "key"], "left_anti"), radius))
        rest = stored(rows.join(large, ["path", "key"], "left_semi").select("path", "fp"), "split")
    return found


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = 3, radius: int = RADIUS, keep: list[str] | None = None) -> DataFrame:
    """One row per document, with ``simhash`` and ``component_id``, the smallest id reachable over
    links between fingerprints that differ in at most ``radius`` bits, the own id included.

    Equal fingerprints are one node, however many documents have them. Rows that repeat an id are
    kept; ids that are null never become the id of a component with other members.
    """
    columns = docs.columns if keep is None else keep
    own = [c for c in columns if c.lower() not in ("simhash", "component_id")]
    # what is compared is narrow: the texts move once, at the end, and rows are told apart by id and
    # the hash of the text
    tagged = unused(docs, "simhash", "component_id", "__tag").withColumn("__tag", F.xxhash64(F.col(f"`{text}`")))
    marked = stored(fingerprints(tagged, text, width, [doc_id, "__tag"]), "fingerprints")
    nodes = stored(marked.groupBy(F.col("simhash").alias("fp")).agg(F.min(doc_id).alias("first")), "nodes")
    labels = components(stored(fingerprint_links(nodes, radius), "links"))
    grouped = labels.select(F.col("node").alias("fp"), "component")
    smallest = nodes.join(grouped, "fp").groupBy("component").agg(F.min("first").alias("smallest"))
    linked = stored(grouped.join(stored(smallest, "smallest"), "component").select("fp", "smallest"), "linked")
    ids = stored(nodes.join(linked, "fp", "left").select(F.col("fp").alias("simhash"), F.coalesce("smallest", "first").alias("component_id")), "ids")
    found = marked.join(ids, "simhash", "left")
    if set(own) <= {doc_id}:
        return found.select(*own, "simhash", "component_id")
    found = stored(found.select(F.col(f"`{doc_id}`").alias("__id"), "__tag", "simhash", "component_id").distinct(), "found")
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col("__id")) & (tagged["__tag"] == found["__tag"])
    return tagged.join(found, same).select(*[F.col(f"`{c}`") for c in own], "simhash", "component_id")
