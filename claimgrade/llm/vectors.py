"""Near-duplicate vectors by a pivot-permutation index.

Every vector is described by its nearest reference points (pivots) in order. Inverted lists, one
per group and pivot, bring together the vectors that have a pivot in common; two vectors that
share at least ``SHARED`` of their ``NEAREST`` pivots are candidates and are verified by their
cosine in double precision. A pair is counted in one place only: the list of the smallest pivot
it shares. A list too long for one task is replaced by lists of every ``SHARED`` pivots that
begin with it (fewer where a table has fewer pivots), and one that is still too long is compared in blocks that go to tasks of their own.
Links are counted, and a forest of them is kept for the components; pairs are never listed.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from claimgrade.llm.common import stored
from claimgrade.llm.graph import components

# Pivots per number of dimensions: at most so many, from a bounded sample of the vectors, none of
# them nearer to another than the cosine APART, so that a dense group does not take them all.
PIVOTS = 256
SAMPLE = 1024
APART = 0.7
NEAREST = 10
SHARED = 3
# Rows of a list that one task compares with each other
LIST = 4096
THRESHOLD = 0.93
_ROWS = 512


def _usable(vector: str) -> F.Column:
    """True for vectors with finite components, not all of them zero."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0)


def _units(vectors: pd.Series) -> np.ndarray:
    x = np.array([np.asarray(v, float) for v in vectors])
    x /= np.abs(x).max(axis=1, keepdims=True)  # squares of large or small components stay finite
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _pivots(classes: DataFrame) -> dict[int, np.ndarray]:
    order = Window.partitionBy("dim").orderBy(F.xxhash64("rep"), "rep")
    rows = classes.withColumn("n", F.row_number().over(order)).where(F.col("n") <= SAMPLE).orderBy("dim", "n").select("dim", "vector").collect()
    found: dict[int, list] = {}
    for r in rows:
        found.setdefault(r["dim"], []).append(r["vector"])
    out = {}
    for dim, sample in found.items():
        units = _units(pd.Series(sample))
        near = units @ units.T > APART
        taken: list[int] = []
        for i in range(len(units)):
            if len(taken) < PIVOTS and not near[i, taken].any():
                taken.append(i)
        out[dim] = units[taken]
    return out


def _describe(classes: DataFrame, pivots: dict[int, np.ndarray], nearest: int) -> DataFrame:
    """``classes`` with ``near``, the nearest pivots in order, ties by number."""
    shared = classes.sparkSession.sparkContext.broadcast(pivots)
    columns = ["rep", "size", "label", "dim", "vector"]
    schema = T.StructType([*(classes.schema[c] for c in columns), T.StructField("near", T.ArrayType(T.IntegerType()))])

    def run(frames):
        for frame in frames:
            near = pd.Series([None] * len(frame), index=frame.index, dtype=object)
            for dim, part in frame.groupby("dim"):
                order = np.argsort(-(_units(part["vector"]) @ shared.value[dim].T), axis=1, kind="stable")
                near[part.index] = list(order[:, :nearest].astype(np.int32))
            yield frame.assign(near=near)

    return classes.select(columns).mapInPandas(run, schema)


def _compare(threshold: float, least: int):
    """Rows of one list, or of a pair of its blocks: (rep, other, links) with ``links`` the number
    of vectors linked in this list and ``other`` a linked vector, or the row itself."""

    def function(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rep", kind="stable")
        pivots = list(key[2])
        shared = min(least, len(rows["near"].iloc[0]))  # a table with fewer vectors has fewer pivots
        rep, size, block = (rows[c].to_numpy() for c in ("rep", "size", "block"))
        x = _units(rows["vector"])
        has = np.zeros((len(rows), 1 + max(max(n) for n in rows["near"])), np.float32)
        for i, n in enumerate(rows["near"]):
            has[i, n] = 1
        first = has[:, : max(pivots) + 1]
        links = np.zeros(len(rows), np.int64)
        root = np.arange(len(rows))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        other = rep.copy()
        across = key[3] != key[4]
        for at in range(0, len(rows), _ROWS):
            part = slice(at, at + _ROWS)
            near = x[part] @ x.T >= threshold
            near &= has[part] @ has.T >= shared
            near &= first[part] @ first.T == len(pivots)  # the smallest shared pivots are this list's
            near &= np.arange(len(rows)) != np.arange(at, at + len(near))[:, None]
            if across:
                near &= block != block[part][:, None]
            links[part] += near @ size
            for i in np.flatnonzero(near.any(axis=1)):
                for j in np.flatnonzero(near[i]):
                    a, b = find(at + int(i)), find(int(j))
                    if a != b:
                        low, high = min(a, b), max(a, b)
                        root[high] = low
        ends = np.array([find(i) for i in range(len(rows))], np.int64)
        other = rep[ends] if len(ends) else other
        keep = links > 0
        return pd.DataFrame({"rep": rep[keep], "other": other[keep], "links": links[keep]})

    return function


def _lists(described: DataFrame, least: int) -> DataFrame:
    """Rows of the inverted lists, with their list's pivots and the two blocks that meet."""
    spread = described.withColumn("pivots", F.explode(F.transform("near", lambda p: F.array(p))))
    key = ["label", "dim", "pivots"]
    long = stored(spread.groupBy(*key).count().where(F.col("count") > LIST).drop("count"), "long-lists")
    one = spread.withColumn("i", F.lit(0)).withColumn("j", F.lit(0)).withColumn("block", F.lit(0))
    if long.isEmpty():
        return one
    short = one.join(long, key, "left_anti")
    rest = spread.join(long, key, "left_semi")
    ordered = F.sort_array(F.filter("near", lambda p: p > F.element_at("pivots", 1)))

    def tails(n: int) -> F.Column:
        found = F.array(*[F.array(*[F.get(ordered, F.lit(i)) for i in c]) for c in combinations(range(NEAREST - 1), n)])
        return F.filter(found.cast("array<array<int>>"), lambda t: F.forall(t, lambda p: p.isNotNull()))

    # a table with fewer pivots has fewer to share, as in _compare
    shared = F.least(F.lit(least), F.size("near"))
    tails = F.coalesce(*[F.when(shared == n + 1, tails(n)) for n in range(least)])
    rest = rest.withColumn("tail", F.explode(tails)).withColumn("pivots", F.concat("pivots", "tail")).drop("tail")
    rest = stored(rest, "split-lists")
    sizes = stored(rest.groupBy(*key).agg(F.expr(f"(count(*) - 1) div {LIST} + 1").cast("int").alias("blocks")), "list-sizes")
    dealt = rest.join(sizes, key).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    met = dealt.withColumn("m", F.explode(F.expr("sequence(0, blocks - 1)")))
    met = met.withColumn("i", F.least("m", "block")).withColumn("j", F.greatest("m", "block")).drop("m", "blocks")
    return short.unionByName(met)


def near_duplicates(
    vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", group: str = "label", threshold: float = THRESHOLD
) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Vectors link when their groups are equal and not null, their lengths are equal and their cosine
    is at least ``threshold``. Vectors that are null, empty, zero or not finite link with nothing.
    Equal vectors of a group are one class that is compared once; each of its rows links with the
    other rows of the class and with all rows of the classes linked to it. A row without an id
    counts as a link but names no component.
    """
    rows = stored(
        vectors.select(
            F.col(f"`{vec_id}`").alias("id"),
            F.col(f"`{group}`").alias("label"),
            F.col(f"`{vector}`").alias("vector"),
            (_usable(f"`{vector}`") & F.col(f"`{group}`").isNotNull()).alias("ok"),
        ),
        "vectors",
    )
    # the class is numbered by the hash of its content; the content decides where hashes agree
    good = rows.where("ok").withColumn("dim", F.size("vector"))
    grouped = good.groupBy("label", "dim", "vector").agg(F.min("id").alias("least"), F.count("*").alias("size"))
    classes = stored(grouped.withColumn("rep", F.monotonically_increasing_id()), "classes")
    found = _lists(stored(_describe(classes, _pivots(classes), NEAREST), "described"), SHARED)
    compared = stored(
        found.groupBy("label", "dim", "pivots", "i", "j").applyInPandas(_compare(threshold, SHARED), "rep long, other long, links long"), "compared"
    )
    linked = stored(compared.groupBy("rep").agg(F.sum("links").alias("links")), "linked")
    labels = components(compared.selectExpr("rep AS a", "other AS b"))
    grouped = stored(labels.select(F.col("node").alias("rep"), "component"), "classes-of-components")
    smallest = stored(grouped.join(classes.select("rep", "least"), "rep").groupBy("component").agg(F.min("least").alias("smallest")), "smallest")
    facts = stored(
        classes.join(linked, "rep", "left")
        .join(grouped, "rep", "left")
        .join(smallest, "component", "left")
        .select(
            F.col("label").alias("l"),
            F.col("vector").alias("v"),
            (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("smallest", "least").alias("component_id"),
        ),
        "facts",
    )
    same = (F.col("label") == F.col("l")) & (F.col("vector") == F.col("v")) & F.col("ok")
    out = rows.join(facts, same, "left").select(
        F.col("id").alias(vec_id), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id")
    )
    return out.withColumn("kept", F.col(f"`{vec_id}`").eqNullSafe(F.col("component_id")))
