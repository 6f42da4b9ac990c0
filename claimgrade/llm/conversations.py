"""Faults of conversations and their cheapest repair (see ``auction`` for the method).

Most conversations are short: they are dealt by id, sorted, and repaired one after the other as they
stream through a task. A conversation of many rows or bytes is never one group: its rows are sorted
over all tasks by range and cut into pieces of ``ROWS`` rows. A piece becomes a small matrix of least costs
between the roles at its two ends; pieces are combined in a tree, its answers go back down, and every piece is then
repaired by itself, knowing the cost beyond it and the role before it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from claimgrade.llm import auction
from claimgrade.llm.common import shuffle_parts, stored

# rows and bytes of a conversation that one task repairs at a time; longer ones are cut into pieces
LONG_ROWS, LONG_BYTES = 4096, 4 << 20
# a piece has two to the power of this many rows, a node of the tree this power of children
PIECE_BITS, TREE_BITS = 8, 10
_BLANK = "\x20\x09\x0a\x0b\x0c\x0d"
_ENDS = ".!?"
_FLUSH_ROWS, _FLUSH_CHARS = 1024, 4 << 20

COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
RESULT = f"piece long, {', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired array<struct<role:string,text:string>>"


def damaged(rows: DataFrame, every: int = 20) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with faults put in by the CRC of ``conv_id:turn``.

    Of the remainders by ``every``: 0 drops the row (``there`` is false), 1 empties its text, 2 takes out
    its marks of an end, 3 repeats it, 4 makes its role user. A null id or turn counts as one space in
    the CRC, a null role or text becomes one space; id and turn stay null in the result.
    """
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    what = F.pmod(F.crc32(key), F.lit(every))
    text = F.coalesce("text", blank)
    return rows.select(
        "conv_id",
        "turn",
        F.when(what == 4, "user").otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(what == 1, "").when(what == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (what != 0).alias("there"),
        F.explode(F.when(what == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _initial(role: str) -> int:
    return auction.INITIALS.get(role[:1], auction.OTHER)


def _fault(text: str) -> int:
    end = text.rstrip(_BLANK)
    return auction.BAD if not end else auction.WHOLE if end[-1] in _ENDS else auction.CUT


def _illegal(initials: list[int], before: int | None = None) -> int:
    chain = initials if before is None else [before, *initials]
    return sum((a, b) not in auction.LEGAL for a, b in zip(chain, chain[1:], strict=False))


def whole(turns: list[int | None], rows: list[tuple[str, str]]) -> tuple:
    """Counts, edits and repaired rows of one conversation in order."""
    kinds, seen, faults, initials = [], set(), [0, 0, 0], []
    for row in rows:
        initials.append(_initial(row[0]))
        fault = _fault(row[1])
        if fault == auction.BAD:
            faults[0] += 1
        elif row in seen:
            fault = auction.BAD
            faults[1] += 1
        elif fault == auction.CUT:
            faults[2] += 1
        seen.add(row)
        kinds.append(auction.kind(initials[-1], fault))
    known = {t for t in turns if t is not None}
    gaps = max(known) - min(known) + 1 - len(known) if known else 0
    edits, cost = auction.best(kinds)
    return gaps, *faults, _illegal(initials), cost, edits, auction.apply(edits, rows)


def _lines(repaired: list[list[tuple[str, str]]]) -> pa.Array:
    offsets = [0]
    for rows in repaired:
        offsets.append(offsets[-1] + len(rows))
    flat = [line for rows in repaired for line in rows]
    struct = pa.StructArray.from_arrays([pa.array([r for r, _ in flat], pa.string()), pa.array([t for _, t in flat], pa.string())], ["role", "text"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), struct)


def _short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, turn, role, text, there) in order to one row per conversation."""
    ids: list[pa.Scalar] = []
    results: list[tuple] = []
    size = 0
    turns: list[int | None] = []
    rows: list[tuple[str, str]] = []
    current: pa.Scalar | None = None

    def batch_of(kind: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*results, strict=True))
        arrays = [pa.array([i.as_py() for i in ids], kind), pa.array([0] * len(ids), pa.int64())]
        arrays += [pa.array(c, pa.int64()) for c in columns[:6]] + [pa.array(columns[6], pa.string()), _lines(columns[7])]
        return pa.RecordBatch.from_arrays(arrays, names=["conv_id", "piece", *COUNTS, "audit", "repaired"])

    kind = None
    for batch in batches:
        kind = batch.schema.field(0).type
        keys, turn, role, text, there = batch.columns
        key_values = keys.to_pylist()
        for i, (t, r, x, here) in enumerate(zip(turn.to_pylist(), role.to_pylist(), text.to_pylist(), there.to_pylist(), strict=True)):
            if current is None or (key_values[i] != key_values[i - 1] if i else keys[i] != current):
                if current is not None:
                    ids.append(current)
                    results.append(whole(turns, rows))
                    if len(ids) >= _FLUSH_ROWS or size >= _FLUSH_CHARS:
                        yield batch_of(kind)
                        ids, results, size = [], [], 0
                current, turns, rows = keys[i], [], []
            if here:
                turns.append(t)
                rows.append((r, x))
                size += len(x)
    if current is not None:
        ids.append(current)
        results.append(whole(turns, rows))
        yield batch_of(kind)


def _per_row(df: DataFrame, schema: str, function: Callable[[dict], list[dict]]) -> DataFrame:
    """Rows that ``function`` makes of each row, batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [out for row in batch.to_pylist() for out in function(row)]
            yield pa.RecordBatch.from_pylist(made, schema=shape)

    shape = to_arrow_schema(T.StructType.fromDDL(schema))
    return df.mapInArrow(run, schema)


def _tree(leaves: DataFrame, kind: str, join: Callable[[list], list], spread: Callable[[list, list], list], start: list[int]) -> DataFrame:
    """What reaches each leaf (conv_id, node, v array<long>): (conv_id, node, carry array<long>).

    ``join`` makes one value of a node's values in order; ``spread`` takes what reaches a node and the
    values below it to what reaches each of them; ``start`` reaches the root. A node has at
    most two to the power of ``TREE_BITS`` children, so the levels are few whatever the length.
    """
    up = f"conv_id {kind}, node long, v array<long>"
    levels = [leaves]
    while True:
        below = levels[-1].withColumn("above", F.shiftright("node", TREE_BITS))
        groups = below.groupBy("conv_id", "above").agg(F.sort_array(F.collect_list(F.struct("node", "v"))).alias("below"))
        groups = stored(groups, "tree-groups")
        level = _per_row(groups, up, lambda row: [{"conv_id": row["conv_id"], "node": row["above"], "v": join([x["v"] for x in row["below"]])}])
        levels.append(stored(level, "tree-level"))
        levels[-2] = groups
        if levels[-1].groupBy("conv_id").count().where("count > 1").isEmpty():
            break
    reached = levels.pop().select("conv_id", "node", F.array(*[F.lit(x).cast("long") for x in start]).alias("carry"))
    down = f"conv_id {kind}, node long, carry array<long>"
    for groups in reversed(levels):
        at = reached.select(F.col("conv_id").alias("__id"), F.col("node").alias("above"), "carry")
        met = groups.alias("g").join(at.alias("a"), F.col("conv_id").eqNullSafe(F.col("__id")) & (F.col("g.above") == F.col("a.above")))

        def go(row: dict) -> list[dict]:
            carried = spread(row["carry"], [x["v"] for x in row["below"]])
            return [{"conv_id": row["conv_id"], "node": x["node"], "carry": c} for x, c in zip(row["below"], carried, strict=True)]

        reached = stored(_per_row(met.select("conv_id", "below", "carry"), down, go), "tree-carry")
    return reached


def _product(values: list[list[int]]) -> list[int]:
    out = values[0]
    for v in values[1:]:
        rows = [auction.through(_transposed(v), out[q * 4 : q * 4 + 4]) for q in range(auction.STATES)]
        out = [x for row in rows for x in row]
    return out


def _transposed(v: list[int]) -> list[int]:
    return [v[r * 4 + q] for q in range(auction.STATES) for r in range(auction.STATES)]


def _beyond(carry: list[int], values: list[list[int]]) -> list[list[int]]:
    out = [carry]
    for v in reversed(values[1:]):
        out.append(auction.through(v, out[-1]))
    return out[::-1]


def _follow(values: list[list[int]]) -> list[int]:
    """Maps of states, one after the other; the last initial goes along."""
    return [*(_then(q, values) for q in range(auction.STATES)), values[-1][4]]


def _then(state: int, values: list[list[int]]) -> int:
    for v in values:
        state = v[state]
    return state


def _before(carry: list[int], values: list[list[int]]) -> list[list[int]]:
    out = [carry]
    for v in values[:-1]:
        out.append([v[out[-1][0]], v[4]])
    return out


def _long(rows: DataFrame, kind: str) -> DataFrame:
    """``rows`` of long conversations to one row per piece. The first piece has the gaps."""
    spark = rows.sparkSession
    order = ["conv_id", F.col("turn").asc_nulls_first(), "tie", "salt"]
    # equal rows may lie in different tasks: a number of their own tells them apart
    salted = stored(rows.withColumn("tie", F.xxhash64("role", "text")).withColumn("salt", F.monotonically_increasing_id()), "long-rows")
    spread = salted.repartitionByRange(shuffle_parts(spark), *order).sortWithinPartitions(*order)
    # numbers rise over the tasks in their order, and within each: places in the order of all rows
    placed = stored(spread.drop("salt").withColumn("at", F.monotonically_increasing_id()), "long-order")
    placed = placed.withColumn("digest", F.when(F.col("there"), F.unhex(F.sha2(F.concat("role", F.lit("\0"), "text"), 256))))
    rows = placed.where("there")
    first = stored(rows.groupBy("conv_id", "digest").agg(F.min("at").alias("first")), "long-first").withColumnsRenamed({"conv_id": "__id", "digest": "__digest"})
    met = rows.join(first, F.col("conv_id").eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("__digest")))
    end = F.regexp_replace("text", r"[\x20\x09-\x0D]+\z", "")
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(auction.OTHER)
    facts = met.select("conv_id", "turn", "at", F.shiftright("at", PIECE_BITS).alias("node"), code.alias("initial"), (end == "").alias("blank"), (F.col("at") > F.col("first")).alias("again"), (~end.rlike(r"[.!?]\z")).alias("open"))
    fault = F.when(F.col("blank") | F.col("again"), auction.BAD).when(F.col("open"), auction.CUT).otherwise(auction.WHOLE)
    facts = stored(facts.withColumn("fault", fault).withColumn("kind", F.col("initial") * 3 + fault), "long-facts")
    pieces = facts.groupBy("conv_id", "node").agg(
        F.sort_array(F.collect_list(F.struct("at", "kind"))).alias("rows"),
        F.count_if("blank").alias("blank"),
        F.count_if(F.col("again") & ~F.col("blank")).alias("duplicate"),
        F.count_if(F.col("fault") == auction.CUT).alias("truncated"),
    )
    pieces = stored(pieces.withColumn("kinds", F.transform("rows", lambda r: r["kind"])).drop("rows"), "long-pieces")
    key = f"conv_id {kind}, node long"
    costs = _per_row(pieces.select("conv_id", "node", "kinds"), f"{key}, v array<long>", lambda r: [{**r, "v": auction.matrix(r["kinds"])}])
    reached = _tree(stored(costs, "long-matrices"), kind, _product, _beyond, list(auction.END)).withColumnsRenamed({"conv_id": "__id", "node": "__node"})

    def with_reached(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.join(right, F.col("conv_id").eqNullSafe(F.col("__id")) & (F.col("node") == F.col("__node"))).drop("__id", "__node")

    def ways(row: dict) -> list[dict]:
        found = auction.Piece(row["kinds"], row["carry"])
        paths = [found.path(q) for q in range(auction.STATES)]
        return [{"conv_id": row["conv_id"], "node": row["node"], "v": [*(p[1] for p in paths), row["kinds"][-1] // 3], "audits": [p[0] for p in paths], "costs": [p[2] for p in paths]}]

    shape = f"{key}, v array<long>, audits array<string>, costs array<long>"
    traced = stored(_per_row(with_reached(pieces.select("conv_id", "node", "kinds"), reached), shape, ways), "long-ways")
    entered = _tree(traced.select("conv_id", "node", "v"), kind, _follow, _before, [auction.NOTHING, -1]).withColumnsRenamed({"conv_id": "__id", "node": "__node"})
    chosen = with_reached(traced, entered).select("conv_id", "node", "v", "carry", F.expr("audits[carry[0]]").alias("audit"), F.expr("costs[carry[0]]").alias("cost"))
    gaps = placed.groupBy("conv_id").agg(F.coalesce(F.expr("max(turn) FILTER (WHERE there) - min(turn) FILTER (WHERE there) + 1 - count(DISTINCT turn) FILTER (WHERE there)"), F.lit(0)).alias("gaps"))
    span = pieces.groupBy("conv_id").agg(F.min("node").alias("first"), F.max("node").alias("last"), F.count("*").alias("pieces"))
    known = gaps.join(span.withColumnRenamed("conv_id", "__id"), F.col("conv_id").eqNullSafe(F.col("__id")), "left").drop("__id")
    known = stored(known, "long-known").withColumnRenamed("conv_id", "__id2")
    texts = rows.groupBy("conv_id", F.shiftright("at", PIECE_BITS).alias("node")).agg(F.sort_array(F.collect_list(F.struct("at", "role", "text"))).alias("rows"))
    texts = texts.withColumnsRenamed({"conv_id": "__id", "node": "__node"})
    parts = with_reached(chosen, pieces.withColumnsRenamed({"conv_id": "__id", "node": "__node"}))
    parts = stored(parts.join(known, F.col("conv_id").eqNullSafe(F.col("__id2"))).drop("__id2"), "long-parts")

    def finish(row: dict) -> list[dict]:
        edits, cost = row["audit"], row["cost"]
        state, before = row["carry"]
        if row["node"] == row["last"]:
            ended = row["v"][state]
            edits, cost = edits + auction.END_EDITS[ended], cost + auction.END[ended]
        lines = auction.apply(edits, [(r["role"], r["text"]) for r in row["rows"]], state)
        initials = [k // 3 for k in row["kinds"]]
        return [
            {
                "conv_id": row["conv_id"],
                "piece": row["node"],
                "gaps": row["gaps"] if row["node"] == row["first"] else 0,
                **{c: row[c] for c in ("blank", "duplicate", "truncated")},
                "illegal": _illegal(initials, None if before < 0 else before),
                "cost": cost,
                "audit": edits,
                "repaired": [{"role": r, "text": t} for r, t in lines],
                "pieces": row["pieces"],
            }
        ]

    done = _per_row(with_reached(parts, texts), f"conv_id {kind}, {RESULT}, pieces long", finish)
    zero = F.lit(0).cast("long")
    nothing = F.array().cast("array<struct<role:string,text:string>>")
    gone = known.where("first IS NULL").select(
        F.col("__id2").alias("conv_id"), zero.alias("piece"), *[zero.alias(c) for c in COUNTS], F.lit("").alias("audit"), nothing.alias("repaired"), F.lit(1).cast("long").alias("pieces")
    )
    return stored(done.unionAll(gone), "long-repaired")


def repair(rows: DataFrame, long_rows: int = LONG_ROWS, long_bytes: int = LONG_BYTES) -> DataFrame:
    """Faults and cheapest repair of every conversation of ``rows`` (conv_id, turn, role, text and, if it
    has one, boolean ``there``: a row that is not there only names its conversation).

    One row per conversation, or per piece of a long one: ``conv_id``, ``piece`` (in order), ``gaps``, ``blank``,
    ``duplicate``, ``truncated``, ``illegal``, ``cost`` (to be summed over pieces), ``audit`` (letters of the
    edits, in order) and ``repaired`` (role, text). Rows go by turn, null turns first; ties by a hash of role
    and text. Null roles and texts count as one space; null ids are one conversation. Other columns are
    left out. A conversation without rows has zeros, no edits and no rows.
    """
    blank = F.lit(" ")
    there = F.coalesce("there", F.lit(False)) if "there" in rows.columns else F.lit(True)
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), there.alias("there"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    sizes = rows.groupBy(F.col("conv_id").alias("__id")).agg(F.count("*").alias("n"), F.sum(F.octet_length("text") + F.octet_length("role")).alias("size"))
    long = stored(sizes.where((F.col("n") > long_rows) | (F.col("size") > long_bytes)).select("__id"), "long-conversations")
    is_long = F.col("conv_id").eqNullSafe(F.col("__id"))
    short = rows.join(long, is_long, "left_anti") if not (none := long.isEmpty()) else rows
    tie = F.xxhash64("role", "text")
    dealt = short.repartition(shuffle_parts(rows.sparkSession), "conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), tie, "role", "text")
    found = dealt.mapInArrow(_short, f"conv_id {kind}, {RESULT}").withColumn("pieces", F.lit(1).cast("long"))
    return found if none else found.unionAll(_long(rows.join(long, is_long, "left_semi"), kind))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, lines) in order to (conv_id, sha256 of the lines): texts stream, one line at a time."""
    current, digest, first = None, None, True
    kind = None
    for batch in batches:
        kind = batch.schema.field(0).type
        for key, lines in zip(batch.column(0), batch.column(1), strict=True):
            if current is None or key != current:
                if current is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([current.as_py()], kind), pa.array([digest.hexdigest()])], names=["conv_id", "sha256"])
                current, digest, first = key, hashlib.sha256(), True
            for line in lines:
                if not first:
                    digest.update(b"\n")
                first = False
                digest.update(line.as_py().encode("utf-8", "surrogatepass"))
    if current is not None:
        yield pa.RecordBatch.from_arrays([pa.array([current.as_py()], kind), pa.array([digest.hexdigest()])], names=["conv_id", "sha256"])


def line(x: Column) -> Column:
    return F.concat(x["role"], F.lit(":"), x["text"])


def digests(repaired: DataFrame) -> DataFrame:
    """One row per conversation of ``repaired`` (see ``repair``): counts summed, edits joined, and
    ``repaired_sha256``, lowercase hex over its ``role:text`` lines joined by newlines.

    Conversations of one piece stay where they are. The pieces of long ones meet by conversation and are
    hashed in order as a stream, as a digest needs them one after the other.
    """
    own = ["conv_id", *COUNTS, "audit"]
    lines = F.transform("repaired", line)
    alone = repaired.where("pieces = 1").select(*own, F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256"))
    cut = repaired.where("pieces > 1")
    kind = repaired.schema["conv_id"].dataType.simpleString()
    streams = cut.select("conv_id", "piece", lines.alias("lines")).repartition(shuffle_parts(repaired.sparkSession), "conv_id").sortWithinPartitions("conv_id", "piece")
    hashed = streams.select("conv_id", "lines").mapInArrow(_hashed, f"conv_id {kind}, sha256 string").withColumnRenamed("conv_id", "__id")
    audit = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("piece", "audit"))), lambda x: x["audit"]), "")
    counted = cut.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in COUNTS], audit.alias("audit"))
    met = counted.join(hashed, F.col("conv_id").eqNullSafe(F.col("__id")))
    return alone.unionAll(met.select(*own, F.col("sha256").alias("repaired_sha256")))
