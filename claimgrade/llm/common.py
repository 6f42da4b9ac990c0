"""Helpers shared by the operators: settings, stored tables, columns computed in Arrow batches."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimgrade import session
from claimgrade.session import materialise

# the white space and the words of every contract in this subpackage
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

SETTINGS = {
    # whole texts travel in these batches: bound their rows and bytes
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    # stored tables are read once or twice and then never again: small is better than fast
    "spark.sql.parquet.compression.codec": "zstd",
}


def tune(spark: SparkSession) -> SparkSession:
    session.tune(spark)
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage, survives lost executors."""
    return materialise(df, f"llm-{label}")


def release(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files of steps whose results are stored. It does so when their
    plans are collected as garbage, which may otherwise come after the disk is full."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


_KEPT: list[tuple[object, object]] = []


def kept(key: object, build: Callable[[], object]) -> object:
    """What ``build`` makes, remembered by this Python worker until it needs another thing.

    Workers live on from stage to stage: one model at a time bounds their memory.
    """
    if not _KEPT or _KEPT[0][0] != key:
        _KEPT.clear()
        _KEPT.append((key, build()))
    return _KEPT[0][1]


def parts(rows: int, per_part: int, least: int) -> int:
    """How many parts hold ``rows`` at ``per_part`` each, at least ``least``."""
    return max(least, -(-rows // per_part))


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unused(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns that an operator is about to add (any case)."""
    lower = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in lower])


def with_arrow_columns(
    df: DataFrame,
    column: str,
    added: list[tuple[str, T.DataType]],
    make: Callable[[], Callable[[pa.Array], list[pa.Array]]],
    keep: list[str] | None = None,
) -> DataFrame:
    """``df`` with columns computed from ``column`` batch by batch, without a shuffle.

    ``make`` is called once per task and returns the function from a column to the added
    columns. Columns of the input that carry an added name are replaced. ``keep`` names the
    columns to return besides the added ones (all by default).
    """
    names = [n for n, _ in added]
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in {n.lower() for n in names}]
    # positions, not names: names may be odd
    inner = df.select(F.col(f"`{column}`").alias("__value"), *[F.col(f"`{c}`").alias(f"__{i}") for i, c in enumerate(kept)])
    schema = T.StructType(
        [T.StructField(f"__{i}", df.schema[c].dataType) for i, c in enumerate(kept)]
        + [T.StructField(f"__new{i}", t) for i, (_, t) in enumerate(added)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            new = function(batch.column(0))
            arrays = [batch.column(i + 1) for i in range(len(kept))] + new
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    out = inner.mapInArrow(run, schema)
    return out.toDF(*kept, *names)
