"""Repeated passages: words covered by a window whose words stand earlier in the corpus too.

Windows of ``width`` words meet by content. The smallest hash among a window's runs of ``ANCHOR``
words is its anchor; consecutive windows with one place of the anchor form a segment. Equal windows
have equal anchors at different places, so only segments whose anchor occurs more than once matter,
and each anchor's segments go to one shard, where equal segments are one, kept at its first place. A shard is a
compressed FM-index over its segments (``fmindex``). Its segments stream through it backwards, and
an interval at the threshold length gives the first place of the same words. Segments of a very
frequent anchor are cut into single windows, which are dealt by their content. Hashes choose
anchors and shards, and a 128-bit hash names a segment's content when its other places are listed;
the index compares words as they are. What is stored and moved are places and digests; words are
rendered from the documents, once for each different segment that goes to a shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimgrade.llm.common import parts, release, shuffle_parts, stored
from claimgrade.llm.fmindex import FMIndex, window_intervals

WIDTH = 20
ANCHOR = 5
# segments of one anchor up to which they stay whole
FREQUENT = 1024
# words of a shard, about
SHARD = 400_000
# words of the texts that are looked at together
TOGETHER = 1 << 20
_PLACE = np.uint64((1 << 24) - 1)
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def split(text: str | None) -> list[bytes]:
    """The words of a text; null has none."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _runs(h: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` words."""
    out = np.zeros(len(h) - width + 1, np.uint64)
    for k in range(width):
        out = out * _K1 + h[k : len(h) - width + 1 + k]
    out ^= out >> np.uint64(31)
    out *= _K2
    return out ^ (out >> np.uint64(29))


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive entries."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = np.minimum(x[:-step], x[step:])
        done += step
    return x


def segments(h: np.ndarray, sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first window, windows, anchor) of the segments of texts with word hashes ``h``, the
    texts one after the other, with ``sizes`` words each, at most 2**24 together."""
    none = np.zeros(0, np.int64)
    if len(h) < width:
        return none, none, none, none
    run = min(ANCHOR, width)
    runs = _runs(h, run)
    # hash above, place below: the smallest hash wins, and of equal ones the leftmost
    placed = (runs & ~_PLACE) | np.arange(len(runs), dtype=np.uint64)
    place = (_least(placed, width - run + 1) & _PLACE).astype(np.int64)
    begin = np.cumsum(sizes) - sizes
    text = np.repeat(np.arange(len(sizes)), sizes)[: len(place)]
    at = np.arange(len(place)) - begin[text]
    # a window lies in one text; windows of one text that share the place of their anchor are a segment
    whole = at + width <= sizes[text]
    first = whole & np.r_[True, (place[1:] != place[:-1]) | (text[1:] != text[:-1])]
    starts = np.flatnonzero(first)
    ends = np.minimum(np.r_[starts[1:], len(place)], begin[text[starts]] + sizes[text[starts]] - width + 1)
    return text[starts], at[starts], ends - starts, runs[place[starts]].view(np.int64)


def _anchors(docs: DataFrame, width: int) -> DataFrame:
    """(id, tag, at, windows, anchor) for every segment of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, rows, before, size = [], [], [], 0
            for i, t in enumerate(batch.column(2)):
                text = split(t.as_py())
                # a very long text in parts that overlap by less than a window
                for at in range(0, max(1, len(text) - width + 1), TOGETHER):
                    words.append(text[at : at + TOGETHER + width - 1])
                    rows.append(i)
                    before.append(at)
                    size += len(words[-1])
                    if size >= TOGETHER:
                        yield record(batch, words, rows, before)
                        words, rows, before, size = [], [], [], 0
            yield record(batch, words, rows, before)

    def record(batch: pa.RecordBatch, words: list[list[bytes]], rows: list[int], before: list[int]) -> pa.RecordBatch:
        sizes = np.array([len(w) for w in words], np.int64)
        text, at, windows, anchor = segments(hashes(list(chain.from_iterable(words))), sizes, width)
        taken = pa.array(np.array(rows, np.int64)[text])
        at = at + np.array(before, np.int64)[text]
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(taken), batch.column(1).take(taken), pa.array(at.astype(np.int32)), pa.array(windows.astype(np.int32)), pa.array(anchor)],
            names=["id", "tag", "at", "windows", "anchor"],
        )

    return docs.select("id", "tag", "text").mapInArrow(run, "id long, tag int, at int, windows int, anchor long")


def _rendered(wanted: DataFrame, width: int, digest: bool) -> DataFrame:
    """The segments ``found`` (at, windows, bin, frequent) in each document (id, tag, text), frequent ones as a
    row per window with the hash of its words as ``bin``: (id, tag, at, windows, bin), and a digest of the
    words (``kind``) or the words themselves, joined by one space (``body``)."""
    last = "kind" if digest else "body"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            found, many = lists.flatten(), lists.value_lengths().to_numpy()
            at, windows, bin_, frequent = (found.field(f).to_numpy(zero_copy_only=False) for f in ("at", "windows", "bin", "frequent"))
            # a segment of a frequent anchor becomes a row per window
            times = np.where(frequent, windows, 1)
            start = np.repeat(np.cumsum(times) - times, times)
            row = np.repeat(np.repeat(np.arange(batch.num_rows), many), times)
            at, bin_, frequent = (np.repeat(x, times) for x in (at, bin_, frequent))
            windows = np.where(frequent, 1, np.repeat(windows, times))
            at = at + np.arange(len(at)) - start
            edge = np.searchsorted(row, np.arange(batch.num_rows + 1))
            words_of: list[bytes] = []
            for i, text in enumerate(batch.column(2)):
                words, own = split(text.as_py()), slice(edge[i], edge[i + 1])
                ends = (at[own] + windows[own] + width - 1).tolist()
                bodies = [b" ".join(words[a:b]) for a, b in zip(at[own].tolist(), ends, strict=True)]
                single = np.flatnonzero(frequent[own])
                bin_[own][single] = np.array([xxhash.xxh3_64_intdigest(bodies[k]) for k in single.tolist()], np.uint64).view(np.int64)
                words_of += map(xxhash.xxh3_128_digest, bodies) if digest else bodies
            row = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(row),
                    batch.column(1).take(row),
                    pa.array(at.astype(np.int32)),
                    pa.array(windows.astype(np.int32)),
                    pa.array(bin_),
                    pa.array(words_of, pa.binary()),
                ],
                names=["id", "tag", "at", "windows", "bin", last],
            )

    return wanted.select("id", "tag", "text", "found").mapInArrow(run, f"id long, tag int, at int, windows int, bin long, {last} binary")


def _matched(width: int):
    """Shard of distinct segments (id, tag, at: first place; body) to the windows in them that
    stand earlier: (id, tag, at, windows)."""

    def function(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["id", "tag", "at"], kind="stable")
        bodies = [b.split(b" ") for b in rows["body"]]
        length = np.array([len(b) for b in bodies])
        begin = np.cumsum(length + 1) - length - 1
        flat = np.zeros(length.sum() + len(length), np.int64)
        inside = np.ones(len(flat), bool)
        inside[begin + length] = False
        words = {w: i for i, w in enumerate(dict.fromkeys(chain.from_iterable(bodies)), 2)}
        flat[inside] = np.fromiter(map(words.__getitem__, chain.from_iterable(bodies)), np.int64)
        flat[~inside] = 1  # ends a segment; no window contains it
        # places in the order of document and word
        doc = np.repeat((rows["id"].ne(rows["id"].shift()) | rows["tag"].ne(rows["tag"].shift())).cumsum().to_numpy(), length + 1)
        word = np.arange(len(flat)) - np.repeat(begin, length + 1) + np.repeat(rows["at"].to_numpy(), length + 1)
        order = doc.astype(np.int64) * (int(word.max()) + 1) + word
        index = FMIndex(flat, len(words) + 2, width, order)
        low, high = window_intervals(index, flat, begin, length, width)
        later = high > low
        later[later] = order[index.places[low[later]]] < order[later]
        # runs of later windows, within a segment
        edge = np.diff(np.r_[0, later.astype(np.int8), 0])
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        of = np.searchsorted(begin, starts, side="right") - 1
        picked = rows.iloc[of]
        return pd.DataFrame(
            {"id": picked["id"].to_numpy(), "tag": picked["tag"].to_numpy(), "at": word[starts].astype(np.int32), "windows": (ends - starts).astype(np.int32)}
        )

    return function


def _listed(segments_: DataFrame) -> DataFrame:
    """The segments of each document as one list (id, tag, found), stored."""
    lists = segments_.groupBy("id", "tag").agg(F.collect_list(F.struct("at", "windows", "bin", "frequent")).alias("found"))
    out = stored(lists, "wanted")
    release(segments_.sparkSession)
    return out


def repeated_windows(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(id, tag, at, windows): runs of windows of ``docs`` (id, tag, text) that stand earlier as well."""
    spark = docs.sparkSession
    anchors = _anchors(docs, width)
    counts = anchors.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    counts = stored(counts.select("anchor", (F.col("n") > FREQUENT).alias("frequent")), "anchors")
    release(spark)
    wanted = _listed(anchors.join(counts, "anchor").withColumnRenamed("anchor", "bin"))
    places = stored(_rendered(docs.join(wanted, ["id", "tag"]), width, True), "places")
    del anchors, wanted
    release(spark)
    first = F.min(F.struct("id", "tag", "at", "windows")).alias("first")
    kinds = stored(places.groupBy("kind", "bin").agg(first, F.count("*").alias("n")), "segments")
    release(spark)
    # all places of a segment but the first repeat it whole
    many = kinds.where("n > 1").select("kind", "first")
    copies = (
        places.select("id", "tag", "at", "windows", "kind")
        .join(many, "kind")
        .where("NOT (id = first.id AND tag = first.tag AND at = first.at)")
        .select("id", "tag", "at", "windows")
    )
    # a window stands in another segment only if that has the same anchor: anchors of one segment
    # are done, the others go to the index, each different segment once
    words = F.sum(F.col("first.windows") + width).alias("words")
    several = stored(kinds.groupBy("bin").agg(F.count("*").alias("k"), words).where("k > 1").select("bin", "words"), "bins")
    met = _listed(kinds.join(several, "bin").select("first.*", "bin", F.lit(False).alias("frequent")))
    shards = parts(int(several.agg(F.sum("words")).first()[0] or 0), SHARD, shuffle_parts(spark))
    bodies = _rendered(docs.join(met, ["id", "tag"]), width, False)
    dealt = bodies.select("id", "tag", "at", "body", F.pmod(F.xxhash64("bin"), F.lit(shards)).alias("shard"))
    inner = stored(dealt.groupBy("shard").applyInPandas(_matched(width), "id long, tag int, at int, windows int"), "matched")
    # the texts that were moved for the index go before the copies are moved
    del met, bodies, dealt
    release(spark)
    return copies.unionAll(inner)


def kept_words(words: list[bytes], found: list[tuple[int, int]], width: int) -> tuple[list[bytes], list[tuple[int, int]]]:
    """Words outside the windows of the runs (first, windows), and the intervals removed."""
    if not found:
        return words, []
    edge = np.zeros(len(words) + 1, np.int64)
    for at, windows in found:
        edge[at] += 1
        edge[at + windows + width - 1] -= 1
    gone = np.cumsum(edge[:-1]) > 0
    change = np.diff(np.r_[0, gone.astype(np.int8), 0])
    spans = list(zip(np.flatnonzero(change == 1).tolist(), np.flatnonzero(change == -1).tolist(), strict=True))
    return [w for w, g in zip(words, gone.tolist(), strict=True) if not g], spans


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = WIDTH) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_removed``, ``removed`` (array of
    word intervals) and ``kept_sha256`` of the kept words joined by one space.

    A word goes if a window of ``width`` words that covers it also begins earlier: in a document
    with a smaller id, or further to the front of the same document. Null texts have no words.
    Rows that share an id are documents in the order of a hash of their texts; rows that share
    both are one document and get the same result. A null id counts as the smallest.
    """
    own = docs.select(F.col(f"`{doc_id}`").alias("given"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    own = own.withColumn("id", F.coalesce("given", F.lit(-(2**63)))).withColumn("tag", F.hash("text"))
    texts = own.select("id", "tag", "text")
    found = repeated_windows(texts, width)
    runs = stored(found.groupBy("id", "tag").agg(F.collect_list(F.struct("at", "windows")).alias("runs")), "runs")
    del found
    release(docs.sparkSession)
    # rows that share id and text have one result; the narrow results are made distinct, not the texts
    changed = stored(texts.join(runs, ["id", "tag"]).mapInArrow(_digests(width, True), _SCHEMA).dropDuplicates(["id", "tag"]), "changed")
    whole = own.select("id", "tag", "text").mapInArrow(_digests(width, False), _SCHEMA)
    renamed = changed.select("id", "tag", *[F.col(c).alias(f"{c}_") for c in _RESULT])
    out = whole.join(renamed, ["id", "tag"], "left")
    least = F.lit(-(2**63))
    return out.select(
        F.when(F.col("id") != least, F.col("id")).alias(doc_id),
        *[F.when(F.col("n_words_").isNotNull(), F.col(f"{c}_")).otherwise(F.col(c)).alias(c) for c in _RESULT],
    )


_RESULT = ["n_words", "n_removed", "removed", "kept_sha256"]
_SCHEMA = "id long, tag int, n_words long, n_removed long, removed array<struct<first:int,last:int>>, kept_sha256 string"


def _digests(width: int, with_runs: bool):
    spans_type = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, spans, digest = [], [], [], []
            runs = batch.column("runs").to_pylist() if with_runs else [[]] * batch.num_rows
            for text, found in zip(batch.column("text"), runs, strict=True):
                words = split(text.as_py())
                kept, gone = kept_words(words, [(r["at"], r["windows"]) for r in found], width)
                total.append(len(words))
                removed.append(len(words) - len(kept))
                spans.append([{"first": a, "last": b - 1} for a, b in gone])
                digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("tag"),
                    pa.array(total, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(spans, spans_type),
                    pa.array(digest, pa.string()),
                ],
                names=["id", "tag", "n_words", "n_removed", "removed", "kept_sha256"],
            )

    return run
