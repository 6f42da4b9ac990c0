"""Audit of how filters interact: what each filter removes in every order of application.

The states of the audit are the sets of filters applied so far; an edge applies one more. What an
edge removes depends only on its state, so all orders are read from one lattice:

* a forward pass counts the orders that reach a state, a backward pass those that leave it;
* an edge lies on (orders reaching its state) x (orders leaving its end) orders, and that number
  weights its removals in a filter's Shapley sum;
* step k of an order is the edge from the set of its first k - 1 filters.

The documents are read once and become one count per part and set of failed filters; the lattice
itself holds only constants of the number of filters.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimgrade.llm.common import SPACE

# orders grow with the factorial of the filters
MOST_FILTERS = 7


def paths(filters: int) -> tuple[list[int], list[int]]:
    """(orders reaching, orders leaving) by state, a bit mask of the applied filters."""
    states = 1 << filters
    reach, leave = [0] * states, [0] * states
    reach[0] = leave[-1] = 1
    for state in range(states):
        for f in range(filters):
            if not state >> f & 1:
                reach[state | 1 << f] += reach[state]
    for state in reversed(range(states)):
        for f in range(filters):
            if not state >> f & 1:
                leave[state] += leave[state | 1 << f]
    return reach, leave


def words(text: Column) -> Column:
    """The maximal runs without white space; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), lambda w: w != "")


def text_filters(text: Column) -> dict[str, Column]:
    """Letter -> failure condition of the filters that look at one text; null counts as empty."""
    whole = F.coalesce(text, F.lit(""))
    n, distinct = F.size("__words"), F.size(F.array_distinct("__words"))
    # letters are counted as what is left when everything else goes: bytes, as all are ASCII
    capitals = F.octet_length(F.regexp_replace(whole, "[^A-Z]+", ""))
    return {
        "A": n < 50,
        "B": distinct.cast("long") * 100 < n.cast("long") * 65,
        "C": capitals.cast("long") * 100 > F.char_length(whole).cast("long") * 5,
        "D": whole.rlike(r"[#$%&*|]"),
    }


def failures(docs: DataFrame, part: str = "source", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, part, mask) for every row: bit i of ``mask`` is set if filter i of ABCDE fails.

    E holds a row against the smallest id of an equal text: a larger id fails, and so does a null
    id next to a known one. Rows that repeat the smallest id do not fail. ``part`` is text; a null
    part is the empty one. The texts are read once and do not move: equal ones meet by digest, first
    combined to one row a task, then by a join that adaptive execution splits for a frequent text.
    """
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.col(f"`{text}`").alias("__text"),
        words(F.col(f"`{text}`")).alias("__words"),
    )
    checks = text_filters(F.col("__text"))
    mask = sum((F.when(failed, 1 << i).otherwise(0) for i, failed in enumerate(checks.values())), F.lit(0))
    digest = F.unhex(F.sha2(F.coalesce("__text", F.lit("")), 256))
    rows = rows.select("doc_id", "part", mask.alias("mask"), digest.alias("digest"))
    heads = rows.groupBy("digest").agg(F.min("doc_id").alias("head"))
    again = F.coalesce(F.col("doc_id") > F.col("head"), F.col("doc_id").isNull() & F.col("head").isNotNull())
    return rows.join(heads, "digest").select("doc_id", "part", (F.col("mask") + F.when(again, 1 << len(checks)).otherwise(0)).alias("mask"))


def audit(failed: DataFrame, filters: str = "ABCDE", good: str | None = None, toxic: str | None = None) -> DataFrame:
    """One row per part, order of all ``filters`` and step, from ``failed`` (part, mask, and the names
    of boolean columns for ``good`` and ``toxic`` rows; null is false).

    ``part``, ``filter_order``, ``step``, ``filter`` (its letter), and counts of rows within the part:
    ``kept`` after the step, ``removed`` by it, ``redundant`` (failing, removed earlier),
    ``unique_fails`` (failing no other filter), ``good_lost`` and ``toxic_lost`` (of the removed),
    ``shapley`` (removed by the filter, summed over all orders). A part with rows has all its rows,
    zeros included; no rows, no parts. Null parts are one part.
    """
    k = len(filters)
    if not 1 <= k <= MOST_FILTERS or len(set(filters)) != k:
        raise ValueError(f"one to {MOST_FILTERS} different letters are needed")
    spark = failed.sparkSession
    reach, leave = paths(k)
    edges = [(state, f) for state in range(1 << k) for f in range(k) if not state >> f & 1]
    # what a row that fails ``mask`` meets at each edge; a fixed table of the number of filters
    effects = [
        (mask, state, f, int(not mask & state and not mask >> f & 1), int(not mask & state and mask >> f & 1), int(bool(mask & state) and mask >> f & 1), int(mask == 1 << f))
        for mask in range(1 << k)
        for state, f in edges
    ]
    on_edges = spark.createDataFrame(effects, "mask int, state int, f int, keeps int, removes int, meets int, alone int")
    weights = spark.createDataFrame([(s, f, reach[s] * leave[s | 1 << f]) for s, f in edges], "state int, f int, orders long")
    steps = [
        ("".join(order), i + 1, sum(1 << filters.index(x) for x in order[:i]), filters.index(x), x)
        for order in permutations(filters)
        for i, x in enumerate(order)
    ]
    walks = spark.createDataFrame(steps, "filter_order string, step int, state int, f int, filter string")

    def rows_with(name: str | None) -> Column:
        return F.count_if(F.coalesce(F.col(f"`{name}`"), F.lit(False))) if name else F.lit(0).cast("long")

    counts = failed.groupBy("part", "mask").agg(F.count("*").alias("n"), rows_with(good).alias("g"), rows_with(toxic).alias("t"))

    def on(effect: str, n: str, name: str) -> Column:
        return F.sum(F.col(effect).cast("long") * F.col(n)).alias(name)

    found = (
        counts.join(F.broadcast(on_edges), "mask")
        .groupBy("part", "state", "f")
        .agg(
            on("keeps", "n", "kept"),
            on("removes", "n", "removed"),
            on("meets", "n", "redundant"),
            on("alone", "n", "unique_fails"),
            on("removes", "g", "good_lost"),
            on("removes", "t", "toxic_lost"),
        )
        .join(F.broadcast(weights), ["state", "f"])
        .withColumn("shapley", F.sum(F.col("removed") * F.col("orders")).over(Window.partitionBy("part", "f")))
    )
    return found.join(F.broadcast(walks), ["state", "f"]).select(
        "part", "filter_order", "step", "filter", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def interactions(docs: DataFrame, labels: DataFrame, part: str = "source", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``audit`` of the five filters over ``docs``, with ``labels`` (doc_id, quality, toxic).

    An id with several labels is good or toxic if one of them says so; an id that is null, or has no
    label, is neither.
    """
    known = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    failed = failures(docs, part, text, doc_id).join(known, "doc_id", "left")
    return audit(failed, good="good", toxic="toxic")
