"""Evaluate an expression once although many later expressions use it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns as the output of a generator that gives exactly one row.

    Unlike with ``withColumn``, the optimizer does not put a copy of the expression
    in every place, filters included, that refers to the column.
    """
    replaced = [n for n in columns if n in df.columns]
    one_row = F.inline_outer(F.array(F.struct(*[c.alias(f"_new_{n}") for n, c in columns.items()])))
    return (
        df.select("*", one_row)
        .drop(*replaced)
        .withColumnsRenamed({f"_new_{n}": n for n in columns})
    )


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, inside a larger expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
