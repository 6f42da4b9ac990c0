"""Distinct counts that merge: a HyperLogLog sketch per load and key, kept in a table.

A new load is read once and adds its rows to the table; what stands there is not read again from the raw data. Sketches
of any loads, in any order and overlapping or not, merge to the sketch of their union. ``profile.keys`` is the exact way.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimgrade.operators.profile import KEY_COLUMNS

# registers of a sketch, as a power of two: 16 KB a sketch
LOG_K = 14
# three standard errors, as a share of the true count
BOUND = 3 * 1.04 / 2 ** (LOG_K / 2)


def sketch(rows: DataFrame, load: Column, columns: Mapping[str, str] = KEY_COLUMNS, log_k: int = LOG_K) -> DataFrame:
    """(load, key, n_rows, n_present, sketch): one row per load and key column, from one scan.

    Nulls count in ``n_rows`` only. Sketches combine on the map side: a load of any size sends one row per task. A load
    without rows has none; a null load is a load of its own.
    """
    keys = list(columns.items())
    made = [agg for i, (_, c) in enumerate(keys) for agg in (F.count(c).alias(f"n{i}"), F.hll_sketch_agg(F.col(c).cast("string"), log_k).alias(f"s{i}"))]
    wide = rows.groupBy(load.cast("string").alias("load")).agg(F.count(F.lit(1)).alias("n_rows"), *made)
    each = [F.struct(F.lit(k).alias("key"), "n_rows", F.col(f"n{i}").alias("n_present"), F.col(f"s{i}").alias("sketch")) for i, (k, _) in enumerate(keys)]
    return wide.select("load", F.inline(F.array(*each)))


def add(sketches: DataFrame, path: str) -> None:
    """Writes the loads of ``sketches`` to the table at ``path``; a load that is there already is replaced, others stay."""
    one = sketches.repartition("load")
    one.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("key string, n_rows bigint, n_present bigint, sketch binary, load string").parquet(path)


def merged(sketches: DataFrame) -> DataFrame:
    """(key, loads, n_rows, n_present, distinct_estimate) over all loads.

    The estimate is within ``BOUND`` of the true count with a chance of 99.7 %, and nearly exact for small counts.
    """
    union = F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate")
    return sketches.groupBy("key").agg(F.count(F.lit(1)).alias("loads"), F.sum("n_rows").alias("n_rows"), F.sum("n_present").alias("n_present"), union)


def compared(estimates: DataFrame, exact: DataFrame) -> DataFrame:
    """``estimates`` beside the exact counts (key, distinct_values): ``within_bound`` says whether they agree."""
    near = F.abs(F.col("distinct_estimate") - F.col("distinct_values")) <= F.greatest(F.lit(1.0), F.col("distinct_values") * BOUND)
    return estimates.join(exact.select("key", "distinct_values"), "key").select("key", "loads", "n_rows", "n_present", "distinct_values", near.alias("within_bound"))
