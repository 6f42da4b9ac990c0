"""Mixing sources to target weights by balanced sampling with the cube method.

Sources get shares of the total number of words by weight; a target stops at a multiple of its
source's size, and the excess goes to the others by weight. A document of a source with rate r is
taken floor(r) times, and once more with probability r - floor(r). These extra copies are chosen
by the cube method: the vector of probabilities moves at random through the null space of two
balancing constraints, documents and words, until it reaches a corner; both totals then stay as
they are. Blocks of documents do this in parallel; the few fractions that a block cannot settle
go on together in the next round, until a source has only a small landing problem left.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimgrade.llm.common import WORD, shuffle_parts, stored, unused

WEIGHTS = (5, 2, 1)
MOST = 3
# documents that settle their fractions together
BLOCK = 2048
_NEAR = 1e-9


def targets(docs: DataFrame, source: str, size: str, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, rank, source_size, n, target) per source; the target may be 0 to ``most`` times
    the source's size. Sources stand by code point, null last; weights repeat in that order."""
    sums = stored(
        docs.groupBy(F.col(f"`{source}`").alias("source")).agg(F.sum(size).alias("source_size"), F.count("*").alias("n")),
        "sources",
    )
    # ranks without one task for all sources: sorted parts, then what stands in the parts before
    dealt = stored(
        sums.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()),
        "sources",
    )
    per_part = sorted((r["part"], r["count"]) for r in dealt.groupBy("part").count().collect())
    before, offsets = 0, {}
    for part, count in per_part:
        offsets[part] = before
        before += count
    offset = F.lit(0)
    for part, value in offsets.items():
        offset = F.when(F.col("part") == part, F.lit(value)).otherwise(offset)
    rank = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) + offset
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("rank") - 1) % len(weights)).cast("int"))
    ranked = stored(dealt.withColumn("rank", rank.cast("long")).withColumn("weight", weight).drop("part"), "sources")

    level, total = 0.0, None
    while True:
        # words per unit of weight for those below their limit, until no more reach it
        open_ = F.col("weight") * level < F.col("source_size") * most
        row = ranked.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(~open_, F.col("source_size") * most)).alias("full"),
            F.sum(F.when(open_, F.col("weight"))).alias("weight"),
        ).first()
        total = row["total"] or 0
        raised = (total - (row["full"] or 0)) / row["weight"] if row["weight"] else level
        if raised <= level:
            break
        level = raised
    return stored(
        ranked.select(
            "source",
            "rank",
            "source_size",
            "n",
            F.least(F.col("source_size") * float(most), F.col("weight") * F.lit(level)).alias("target"),
        ),
        "targets",
    )


def flight(chance: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Moves ``chance`` to 0 and 1 with its sum and its sum weighted by ``size`` unchanged, as far
    as that goes: at most two entries stay fractions (exactly, those the constraints need)."""
    x = chance.astype(float).tolist()
    sizes = size.astype(float).tolist()
    todo = [i for i, c in enumerate(x) if _NEAR < c < 1 - _NEAR]
    held = todo[:3]
    at = 3
    coins = iter(rng.random(2 * len(todo) + 8).tolist())
    while len(held) == 3:
        a, b, c = held
        # the direction that keeps both sums
        u = (sizes[b] - sizes[c], sizes[c] - sizes[a], sizes[a] - sizes[b])
        if not any(u):
            u = (1.0, -1.0, 0.0)
        up = min((1 - x[i]) / d if d > 0 else -x[i] / d for i, d in zip(held, u, strict=True) if d)
        down = min(x[i] / d if d > 0 else -(1 - x[i]) / d for i, d in zip(held, u, strict=True) if d)
        step = up if next(coins) * (up + down) < down else -down
        for i, d in zip(held, u, strict=True):
            x[i] += step * d
            if x[i] < _NEAR:
                x[i] = 0.0
            elif x[i] > 1 - _NEAR:
                x[i] = 1.0
        held = [i for i in held if 0 < x[i] < 1]
        while len(held) < 3 and at < len(todo):
            held.append(todo[at])
            at += 1
    return np.array(x)


def land(chance: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The corner nearest to the words due, for the few entries a flight leaves."""
    x = chance.copy()
    open_ = np.flatnonzero((x > 0) & (x < 1))
    due = (x[open_] * size[open_]).sum()
    corners = np.array(np.meshgrid(*[[0.0, 1.0]] * len(open_))).reshape(len(open_), -1).T if len(open_) else np.zeros((1, 0))
    x[open_] = corners[np.abs(corners @ size[open_] - due).argmin()]
    return x


def mix(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    seed: int = 1,
    keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` with ``size`` (words), ``source_size``, ``target`` and ``copies`` (0 to ``most``).

    Null texts have size 0; a null source is a source. Choices depend on the seed, ids and sizes
    only, so reruns agree; rows that are equal in both stand in no order, which changes nothing.
    Documents are settled in falling size within a block, so the fractions that go on to the next
    round, and the two that land, are small ones: a source's words miss its target by less than
    two of its smallest documents that had a fraction.
    """
    added = ("size", "source_size", "target", "copies")
    own = [c for c in (docs.columns if keep is None else keep) if c.lower() not in added]
    measured = unused(docs, "size").withColumn("size", F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long"))
    narrow = stored(
        measured.select(
            F.col(f"`{doc_id}`").alias("id"), F.col(f"`{source}`").alias("source"), "size", F.xxhash64(F.col(f"`{doc_id}`"), "size", F.lit(seed)).alias("h")
        ),
        "sizes",
    )
    goals = targets(narrow, "source", "size", weights, most)
    rate = F.when(F.col("source_size") > 0, F.least(F.lit(float(most)), F.col("target") / F.col("source_size"))).otherwise(F.lit(0.0))
    rows = (
        narrow.join(goals.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        .withColumn("whole", F.floor(rate + F.lit(_NEAR)))
        .withColumn("chance", F.greatest(F.lit(0.0), rate - F.col("whole")))
        .select("id", "size", "h", "rank", "source_size", "target", "whole", "chance", F.expr(f"(n - 1) div {BLOCK} + 1").alias("blocks"))
    )
    shape = "id long, size long, h long, rank long, source_size long, target double, whole long, chance double, blocks long"
    settled: list[DataFrame] = []
    while True:
        rows = stored(
            rows.withColumn("block", F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("h", "blocks"), F.col("blocks"))).otherwise(F.lit(0)))
            .groupBy("rank", "block")
            .applyInPandas(_settle(seed), shape),
            "flight",
        )
        settled.append(rows.where("blocks = 0"))
        rows = rows.where("blocks > 0")
        if rows.isEmpty():
            break
    done = settled[0]
    for more in settled[1:]:
        done = done.unionAll(more)
    copies = done.select("id", "size", "source_size", "target", (F.col("whole") + F.col("chance").cast("long")).alias("copies"))
    if keep is not None and set(own) <= {doc_id}:
        return copies.select(*[F.col("id").alias(c) for c in own], *added)
    # Repeated rows of an id and size: their choices meet them in order of the source. The texts
    # move once, by the hash of both; that is never null, so window and join agree on it.
    given = unused(measured, "source_size", "target", "copies").withColumn("__key", F.xxhash64(F.col(f"`{doc_id}`"), "size"))
    order = Window.partitionBy("__key", F.col(f"`{doc_id}`"), "size").orderBy(F.col(f"`{source}`").asc_nulls_last())
    stated = given.repartition(shuffle_parts(docs.sparkSession), "__key").withColumn("__row", F.row_number().over(order))
    order = Window.partitionBy("id", "size").orderBy("rank", "copies")
    numbered = done.select("id", "size", "rank", "source_size", "target", (F.col("whole") + F.col("chance").cast("long")).alias("copies"))
    numbered = numbered.withColumn("__row", F.row_number().over(order)).withColumn("__key", F.xxhash64("id", "size"))
    numbered = numbered.select("__key", "__row", F.col("id").alias("__id"), F.col("size").alias("__size"), "source_size", "target", "copies")
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col("__id")) & (F.col("size") == F.col("__size"))
    matched = stated.join(stored(numbered, "copies"), ["__key", "__row"]).where(same)
    return matched.select(*[F.col(f"`{c}`") for c in own], "size", "source_size", "target", "copies")


def _settle(seed: int):
    def function(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop(columns="block").sort_values(["size", "h", "id"], ascending=[False, True, True], kind="stable")
        blocks = int(rows["blocks"].iloc[0])
        size = rows["size"].to_numpy(float)
        rng = np.random.default_rng([seed, int(key[0]), int(key[1]), blocks])
        chance = flight(rows["chance"].to_numpy(float), size, rng)
        if blocks == 1:
            chance = land(chance, size)
        open_ = (chance > 0) & (chance < 1)
        rows["chance"] = chance
        # fractions of all blocks meet in as many blocks as hold them, in the end in one
        rows["blocks"] = np.where(open_, max(1, -(-2 * blocks // BLOCK)) if blocks > 1 else 0, 0)
        return rows

    return function
