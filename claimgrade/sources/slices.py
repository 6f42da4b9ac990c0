"""Stored tables in slices of a key: joins of two of them move nothing, and a few slices can be rewritten.

A slice is a hash bucket of the key and a partition of the table at the same time. As a bucket it tells the
planner where a key lies, so tables of one key and one number of slices join where they stand. As a
partition it can be read alone and replaced alone; the other slices' files are not touched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimgrade.session import materialise

SLICE = "slice"
_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
# property of a table: slices whose replacement has begun and not ended
_OPEN = "claimgrade.open"


class SlicedStore:
    """Tables sliced by one key, under one folder, named in the session's catalogue with a prefix.

    On a cluster the catalogue is the metastore, and ``prefix`` tells stores apart.
    """

    def __init__(self, spark: SparkSession, root: str, prefix: str, key: str = "unique_id", slices: int = 64):
        if not re.fullmatch(r"\w+", prefix):
            raise ValueError("a prefix is a word")
        if slices < 1:
            raise ValueError("at least one slice is needed")
        self.spark, self.root, self.prefix, self.key, self.slices = spark, root.rstrip("/"), prefix, key, slices

    def name(self, table: str) -> str:
        return f"{self.prefix}_{table}"

    def slice_of(self, key: Column | str | None = None) -> Column:
        """The number of a key's slice: what bucketing takes, so a slice is one bucket."""
        return F.pmod(F.hash(key if key is not None else F.col(self.key)), F.lit(self.slices))

    def _sliced(self, df: DataFrame) -> DataFrame:
        return df.select(*[c for c in df.columns if c != SLICE], self.slice_of().alias(SLICE))

    def _dealt(self, df: DataFrame) -> DataFrame:
        # the same hash deals rows to tasks: one task writes one file of one slice
        return self._sliced(df).repartition(self.slices, self.key)

    def write(self, df: DataFrame, table: str) -> DataFrame:
        """Store ``df`` as a whole and return it as read back."""
        writer = self._dealt(df).write.mode("overwrite").partitionBy(SLICE).bucketBy(self.slices, self.key)
        with self._set({_WRITERS: str(self.slices)}):
            # most bytes are fingerprints and sentences, which zstd halves
            writer.option("compression", "zstd").option("path", f"{self.root}/{table}").saveAsTable(self.name(table))
        return self.read(table)

    @contextmanager
    def _set(self, settings: dict[str, str]) -> Iterator[None]:
        """Settings for one write. A task holds the rows of one slice, so it needs one open file and no sort by
        slice: a few open files are allowed, and beyond them Spark sorts after all."""
        before = {k: self.spark.conf.get(k, None) for k in settings}
        for key, value in settings.items():
            self.spark.conf.set(key, value)
        try:
            yield
        finally:
            for key, value in before.items():
                self.spark.conf.unset(key) if value is None else self.spark.conf.set(key, value)

    def read(self, table: str, touched: Sequence[int] | None = None) -> DataFrame:
        """A table, or those of its slices that are named; others are not even listed."""
        rows = self.spark.table(self.name(table))
        return rows if touched is None else rows.where(F.col(SLICE).isin(list(touched)))

    def touched(self, changed: DataFrame) -> list[int]:
        """The slices that the keys of ``changed`` lie in; no more than there are slices."""
        return sorted(r[0] for r in changed.select(self.slice_of().alias(SLICE)).distinct().collect())

    def replace(self, df: DataFrame, table: str, touched: Sequence[int], like: str | None = None) -> DataFrame:
        """Put ``df``, all rows of the ``touched`` slices, in the place of what they hold.

        ``df`` may read the table itself: it is stored first. Not so with ``like``, another table of the store
        with rows in the same slices as ``df``, which comes from this store's tables: then ``df`` is computed and
        written once, and its rows are not moved, a union of tables neither. New slices take the place of old ones when all are written, so
        ``df`` may read the table then too, but a failure among the last steps can leave slices empty: see
        ``begin``. A slice that is left without rows is emptied. Repeating a replacement after a failure gives
        the same table if ``df`` does not read it.
        """
        columns = self.spark.table(self.name(table)).columns
        new = df.select(*[c for c in columns if c != SLICE])
        if like is None:
            new = materialise(new, f"slices-{table}")
        with self._set({_OVERWRITE: "dynamic", _WRITERS: str(self.slices)}):
            (self._dealt(new) if like is None else self._sliced(new)).write.insertInto(self.name(table), overwrite=True)
        rows = new.select(self.slice_of().alias(SLICE)) if like is None else self.read(like, touched).select(SLICE)
        filled = {r[0] for r in rows.distinct().collect()}
        for empty in sorted(set(touched) - filled):
            self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS PARTITION ({SLICE} = {int(empty)})")
        return self.read(table)

    def begun(self, table: str) -> list[int]:
        """The slices of a table whose replacement was begun and not ended: what they hold does not count."""
        properties = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}").collect()
        return [int(n) for k, v in map(tuple, properties) if k == _OPEN for n in v.split(",") if n]

    def begin(self, table: str, touched: Sequence[int]) -> None:
        """Note that slices are about to be replaced; no slices: that it is done."""
        noted = ",".join(map(str, touched))
        self.spark.sql(f"ALTER TABLE {self.name(table)} SET TBLPROPERTIES ('{_OPEN}' = '{noted}')")

    def drop(self) -> None:
        """Take the tables of this store out of the catalogue; files stay."""
        for row in self.spark.catalog.listTables(pattern=f"{self.prefix}_*"):
            self.spark.sql(f"DROP TABLE IF EXISTS {row.name}")
