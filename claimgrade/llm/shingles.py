"""Near-duplicates by the five-word shingles of whole texts: Jaccard similarity of 0.8 or more.

Candidates come in two steps. First the covering masks of ``simhash`` over the fingerprints of the sets
bring together all texts whose fingerprints differ in 2 bits or fewer. Pairs at 0.8 differ in some 10 bits of
64, which no masks of few tables cover, so what is still apart meets in bands: of every text's set,
``BANDS`` bands of ``ROWS`` smallest hashes are taken, and two texts meet where a band agrees, which
a pair at 0.8 misses with a chance of 0.672 ** 32, or 3 in a million.
What meets is compared on the sets themselves before it links. A bucket is compared with its
smallest member first, so that a group of copies costs one comparison each; buckets that are still
apart are then compared in full, block by block. There are two such steps whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimgrade.llm import simhash
from claimgrade.llm.common import release, shuffle_parts, stored, unused, with_arrow_columns
from claimgrade.llm.graph import components

WIDTH = 5
# similarity as a fraction: 4 / 5
OVER, UNDER = 4, 5
ROWS, BANDS = 5, 32
SEED = 42
# members and shingles of a bucket that one task compares at a time
BLOCK_NODES, BLOCK_SHINGLES = 2048, 2_000_000
_BLOCK = 1024

_random = np.random.default_rng(SEED)
_TIMES = _random.integers(0, 1 << 63, ROWS * BANDS, np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
_FLIP = _random.integers(0, 1 << 63, ROWS * BANDS, np.uint64)[:, None]


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the shingles: words without white space, A-Z in lower case. A text
    with fewer words is one shingle; a text without words has none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    shingles = map(b" ".join, zip(*(words[k:] for k in range(width)), strict=False)) if len(words) >= width else [b" ".join(words)]
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return UNDER * both >= OVER * (len(a) + len(b) - both)


def _bands(shingles: np.ndarray) -> list[int]:
    if not len(shingles):
        return []
    least = np.full(ROWS * BANDS, np.iinfo(np.uint64).max)
    for i in range(0, len(shingles), _BLOCK):
        least = np.minimum(least, ((shingles[i : i + _BLOCK] ^ _FLIP) * _TIMES).min(axis=1))
    return [_signed(xxhash.xxh64_intdigest(row.tobytes(), i)) for i, row in enumerate(least.reshape(BANDS, ROWS))]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def sketches(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` with ``node`` (hash of the set of shingles), ``n`` (its size), ``fp`` (its fingerprint) and ``bands``."""

    def make():
        def function(column: pa.Array) -> list[pa.Array]:
            sets = [shingle_set(t.as_py()) for t in column]
            nodes = [_signed(xxhash.xxh64_intdigest(s.tobytes(), SEED)) for s in sets]
            return [pa.array(nodes, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(map(simhash.of_hashes, sets), pa.int64()), pa.array(map(_bands, sets), pa.list_(pa.int64()))]

        return function

    added = [("node", T.LongType()), ("n", T.LongType()), ("fp", T.LongType()), ("bands", T.ArrayType(T.LongType()))]
    return with_arrow_columns(docs, text, added, make, keep)


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) whose sets of shingles are similar; ``texts`` has (node, text)."""
    first = texts.select(F.col("node").alias("a"), F.col("text").alias("s"))
    second = texts.select(F.col("node").alias("b"), F.col("text").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None)
        for batch in batches:
            a, b, s, t = (batch.column(i) for i in range(4))
            good = []
            for i in range(len(batch)):
                if last[0] != a[i]:
                    last = (a[i], shingle_set(s[i].as_py()))
                good.append(similar(last[1], shingle_set(t[i].as_py())))
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    return pairs.join(first, "a").join(second, "b").select("a", "b", "s", "t").mapInArrow(run, "a long, b long")


def apart_links(nodes: list[int], components_: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links between members of a bucket that are in different components: as many as join what similar
    pairs join. Whoever is outside the largest component is compared with all, by the inverted lists
    of the bucket's own shingles; of a component that is met, one link is enough."""
    joined: dict[int, int] = {}

    def end(c: int) -> int:
        while c in joined:
            c = joined[c]
        return c

    n = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), n)
    values = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint32)
    order = np.argsort(values, kind="stable")
    owner, values = owner[order], values[order]
    names, starts, counts = np.unique(values, return_index=True, return_counts=True)
    label = np.array(components_)
    different, sizes = np.unique(label, return_counts=True)
    largest = different[np.argmax(sizes)]
    found = []
    for i in np.flatnonzero(label != largest):
        at = np.searchsorted(names, sets[i])
        begin, many = starts[at], counts[at]
        # all places of this text's shingles in the inverted lists, one after the other
        places = np.repeat(begin - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())
        common = np.bincount(owner[places], minlength=len(sets))
        for j in np.flatnonzero((OVER + UNDER) * common >= OVER * (n + n[i])):
            one, other = end(components_[i]), end(components_[j])
            if one != other:
                joined[one] = other
                found.append((min(nodes[i], nodes[j]), max(nodes[i], nodes[j])))
    return found


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, i, j, node, c, set), equal (key, i, j) together, to links (a, b)."""
    current, nodes, labels, sets = None, [], [], []
    links: list[tuple[int, int]] = []

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    for batch in batches:
        keys = zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)
        for key, node, c, packed in zip(keys, batch.column(3).to_pylist(), batch.column(4).to_pylist(), batch.column(5), strict=True):
            if key != current:
                if len(nodes) > 1:
                    links += apart_links(nodes, labels, sets)
                current, nodes, labels, sets = key, [], [], []
            nodes.append(node)
            labels.append(c)
            sets.append(np.frombuffer(packed.as_py(), np.uint32))
        if links:
            yield flush()
            links = []
    if len(nodes) > 1:
        links += apart_links(nodes, labels, sets)
    yield flush()


def _folded(texts: DataFrame) -> DataFrame:
    """(node, set): the shingles as 32-bit numbers, sorted and distinct. What they find is compared on whole sets again."""

    def make():
        def function(column: pa.Array) -> list[pa.Array]:
            return [pa.array([np.unique(shingle_set(t.as_py()).astype(np.uint32)).tobytes() for t in column], pa.binary())]

        return function

    return with_arrow_columns(texts, "text", [("set", T.BinaryType())], make, ["node"])


def _dealt(members: DataFrame) -> DataFrame:
    """``members`` (key, node, c) of buckets with several components, in pairs of blocks: (key, i, j, node, c).

    A bucket within ``BLOCK_NODES`` and ``BLOCK_SHINGLES`` is one block. Of a larger one every two blocks
    meet, and a member goes to as many pairs as there are blocks.
    """
    facts = members.groupBy("key").agg(F.count("*").alias("many"), F.sum("n").alias("total"), F.min("c").alias("c1"), F.max("c").alias("c2"))
    blocks = F.greatest(F.ceil(F.col("many") / BLOCK_NODES), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")
    apart = stored(facts.where("c1 < c2").select("key", blocks.alias("blocks")), "apart")
    own = F.pmod(F.xxhash64("key", "node"), F.col("blocks")).cast("int")
    placed = members.join(apart, "key").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return placed.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "c")


def mask_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of ``nodes`` (node, n, fp) that covering masks bring together, to be compared: the smallest
    nodes of two fingerprints that are linked, and nodes of one fingerprint with the smallest of them. Pairs
    whose sizes are too far apart to be similar are left out."""
    heads = stored(nodes.groupBy("fp").agg(F.min("node").alias("head")), "prints")
    met = stored(simhash.fingerprint_links(heads.select("fp")), "masks")
    first, second = heads.toDF("a", "x"), heads.toDF("b", "y")
    across = met.join(first, "a").join(second, "b").select("x", "y")
    alike = nodes.join(heads, "fp").where("node <> head").selectExpr("head AS x", "node AS y")
    sizes = nodes.select("node", "n")
    sized = across.unionAll(alike).join(sizes.toDF("x", "n"), "x").join(sizes.toDF("y", "m"), "y").where(_near())
    return stored(sized.selectExpr("least(x, y) AS a", "greatest(x, y) AS b").distinct(), "mask-pairs")


def _near() -> Column:
    """Sets of ``n`` and ``m`` shingles can be similar."""
    return F.least("n", "m") * UNDER >= F.greatest("n", "m") * OVER


def copy_links(nodes: DataFrame, texts_of) -> DataFrame:
    """Links (a, b) among ``nodes`` (node, n, fp, bands), with the same components as all pairs that are
    similar and agree in a band or meet by the masks. ``texts_of`` gives (node, text) for the nodes of a table.

    What the masks bring together is compared first. Then two steps, whatever the buckets of bands hold. First each member of a bucket is compared with its smallest
    member, unless the masks have linked them, which joins most copies at one comparison each. Then buckets with several components
    are compared in full, in blocks; of each a task gives out no more links than join it.
    """
    spark = nodes.sparkSession
    members = stored(nodes.select(F.explode("bands").alias("key"), "node", "n"), "bands")
    many = members.groupBy("key").agg(F.min("node").alias("least"), F.count("*").alias("many"))
    members = stored(members.join(stored(many.where("many > 1"), "buckets"), "key"), "members")
    close = mask_pairs(nodes.select("node", "n", "fp"))
    if members.isEmpty() and close.isEmpty():
        return spark.createDataFrame([], "a long, b long")
    compared = members.select("node").unionAll(close.select("a")).unionAll(close.select("b"))
    texts = stored(texts_of(compared.distinct()), "texts")
    linked = stored(_verified(close, texts), "mask-links")
    labels = stored(components(linked), "mask-components")
    sizes = members.select("node", "n").distinct().select(F.col("node").alias("least"), F.col("n").alias("m"))
    star = stored(members.where(F.col("node") != F.col("least")).select("least", "node", "n").distinct(), "heads")
    of_least, of_node = labels.toDF("least", "c"), labels.toDF("node", "d")
    apart = F.coalesce(F.col("c") != F.col("d"), F.lit(True))
    asked = star.join(sizes, "least").where(_near()).join(of_least, "least", "left").join(of_node, "node", "left").where(apart)
    pairs = stored(asked.selectExpr("least AS a", "node AS b"), "pairs")
    links = stored(linked.unionAll(_verified(pairs, texts)), "copies")
    # buckets of two are done
    left = members.where("many > 2").select("key", "node", "n")
    named = left.join(components(links), "node", "left").select("key", "node", "n", F.coalesce("component", "node").alias("c"))
    dealt = stored(_dealt(stored(named, "named")), "dealt")
    release(spark)
    sets = stored(_folded(texts.join(dealt.select("node").distinct(), "node", "left_semi")), "sets")
    order = ["key", "i", "j"]
    met = dealt.join(sets, "node").select(*order, "node", "c", "set").repartition(shuffle_parts(spark), *order).sortWithinPartitions(*order)
    more = stored(met.mapInArrow(_compared, "a long, b long").distinct(), "apart-pairs")
    return stored(links.unionAll(_verified(more, texts)), "copies")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with ``component_id``, the smallest id reachable over similar texts, the own id
    included. Texts without words, or null, are alike and similar to nothing else. Rows that repeat
    an id are kept; ids that are null never become the id of a component with other members.
    """
    own = [c for c in docs.columns if c.lower() != "component_id"]
    tagged = unused(docs, "component_id", "__tag", "__node").withColumn("__tag", F.xxhash64(F.col(f"`{text}`")))
    marked = stored(sketches(tagged, text, [doc_id, "__tag"]).withColumnRenamed(doc_id, "__id"), "sketches")
    grouped = marked.groupBy("node").agg(F.min("__id").alias("first"), F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("bands").alias("bands"), F.min(F.struct("__id", "__tag")).alias("at"))
    nodes = stored(grouped, "nodes")

    def texts_of(asked: DataFrame) -> DataFrame:
        places = stored(nodes.join(asked, "node", "left_semi").select("node", "at.*"), "places")
        same = F.col(f"`{doc_id}`").eqNullSafe(F.col("__id")) & (tagged["__tag"] == places["__tag"])
        return tagged.join(places, same).select("node", F.col(f"`{text}`").alias("text")).dropDuplicates(["node"])

    labels = components(copy_links(nodes.select("node", "n", "fp", "bands"), texts_of))
    smallest = nodes.join(labels, "node").groupBy("component").agg(F.min("first").alias("smallest"))
    linked = stored(labels.join(stored(smallest, "smallest"), "component").select("node", "smallest"), "linked")
    ids = stored(nodes.join(linked, "node", "left").select("node", F.coalesce("smallest", "first").alias("component_id")), "ids")
    found = stored(marked.join(ids, "node", "left").select("__id", "__tag", "component_id").distinct(), "found")
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col("__id")) & (tagged["__tag"] == found["__tag"])
    return tagged.join(found, same).select(*[F.col(f"`{c}`") for c in own], "component_id")
