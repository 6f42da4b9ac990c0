"""Raw sources, rebuilt stage tables, the append-only landing table and dead letters.

Stage tables are Parquet folders. Each rebuild writes a new version folder, and a
line in the catalogue makes it the present one, so a reader never meets a table
that is being replaced and a rebuild that fails leaves the old version in force.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimgrade import schemas
from claimgrade.session import path_exists

RAW_SCHEMAS = {
    "raw_facilities": schemas.RAW_FACILITIES,
    "raw_pincode_directory": schemas.RAW_PINCODE_DIRECTORY,
    "raw_district_indicators": schemas.RAW_DISTRICT_INDICATORS,
}
REVIEW_KEY = ["run_id", "unique_id", "capability"]
_CATALOGUE = T.StructType(
    [
        T.StructField("stage", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("seconds", T.DoubleType()),
        T.StructField("columns", T.StringType()),
        T.StructField("written_at", T.TimestampType()),
    ]
)


def read_raw(spark: SparkSession, name: str, path: str, file_format: str = "parquet", **options: str) -> DataFrame:
    """A raw source with its declared schema; nothing is inferred from the data."""
    return spark.read.schema(RAW_SCHEMAS[name]).options(**options).format(file_format).load(path)


class StageStore:
    """Versioned stage tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def write(self, df: DataFrame, stage: str, partition_by: tuple[str, ...] = (), dealt_by: str | None = None) -> DataFrame:
        """Rebuild a stage and return it as read back from storage.

        ``dealt_by`` is a column whose hash deals the rows to files. The version is known to the session's
        catalogue then, so stages dealt by one column are joined, and stages made of them written, without
        moving a row. Whoever reads it with another catalogue reads plain files.
        """
        version = uuid.uuid4().hex
        path = f"{self.root}/{stage}/version={version}"
        started = time.monotonic()
        # most bytes are fingerprints and sentences, which zstd halves
        if dealt_by is None:
            df.write.partitionBy(*partition_by).option("compression", "zstd").parquet(path)
        else:
            files = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            writer = df.repartition(files, dealt_by).write.partitionBy(*partition_by).bucketBy(files, dealt_by)
            writer.option("compression", "zstd").option("path", path).saveAsTable(_table(path))
        stored = self._stored(path, df.schema)
        line = [(stage, path, stored.count(), time.monotonic() - started, df.schema.json())]
        (
            self.spark.createDataFrame(line, "stage string, path string, n_rows bigint, seconds double, columns string")
            .withColumn("written_at", F.current_timestamp())
            .coalesce(1)
            .write.mode("append")
            .json(f"{self.root}/catalogue")
        )
        return stored

    def versions(self) -> DataFrame:
        return self.spark.read.schema(_CATALOGUE).json(f"{self.root}/catalogue")

    def read(self, stage: str) -> DataFrame:
        """The present version of a stage."""
        last = (
            self.versions()
            .where(F.col("stage") == stage)
            .orderBy(F.col("written_at").desc(), F.col("path"))
            .select("path", "columns")
            .first()
        )
        if last is None:
            raise LookupError(f"stage {stage!r} has not been written")
        return self._stored(last["path"], T.StructType.fromJson(json.loads(last["columns"])))

    def _stored(self, path: str, schema: T.StructType) -> DataFrame:
        if self.spark.catalog.tableExists(_table(path)):
            return self.spark.table(_table(path))
        # the schema is the written one: values of a partition column are not guessed
        return self.spark.read.schema(schema).parquet(path)


def _table(path: str) -> str:
    """The name of a version in the session's catalogue."""
    return f"stage_{path.rpartition('=')[2]}"


def create_landing(spark: SparkSession, path: str) -> DataFrame:
    """The landing table of reviews, in folders by run; created empty when there is none."""
    if not path_exists(spark, path):
        spark.createDataFrame([], schemas.REVIEWS_RAW).write.partitionBy("run_id").parquet(path)
    return spark.read.schema(schemas.REVIEWS_RAW).parquet(path)


def append_reviews(rows: DataFrame, path: str, run_id: str) -> DataFrame:
    """Append the rows of one run in one distributed write.

    Rows this run has already stored are left out, so a repeated append adds
    nothing. Only the folder of the run is read for that, not the history.
    """
    spark = rows.sparkSession
    stored = create_landing(spark, path).where(F.col("run_id") == run_id).select(*REVIEW_KEY)
    new = rows.where(F.col("run_id") == run_id).join(stored, REVIEW_KEY, "left_anti")
    new.select(*schemas.REVIEWS_RAW.names).write.mode("append").partitionBy("run_id").parquet(path)
    return spark.read.schema(schemas.REVIEWS_RAW).parquet(path)


def append_dead_letters(letters: DataFrame, path: str) -> None:
    letters.select(*schemas.DEAD_LETTERS.names).write.mode("append").json(path)


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.DEAD_LETTERS).json(path)
