"""Session settings, and stage boundaries that survive the loss of executors."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# Settings the plans in this package are written for. All are per-session SQL settings.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # data already partitioned by unique_id is not moved again for (unique_id, capability)
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # the virtual machine does not compile methods above this size, and long rule chains
    # make such methods: let Spark split them instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # timestamps are written and compared in UTC
    "spark.sql.session.timeZone": "UTC",
    # JSON answers that repeat a key: the last one counts
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# the folder that holds this package
_ROOT = str(Path(__file__).resolve().parent.parent)
# temporary folders of local sessions, by application
_LOCAL_FOLDERS: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    """Apply ``SETTINGS``, and let Python workers import this package from where it lies.

    On a cluster the package is installed on the nodes, or shipped with ``--py-files``.
    """
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for intermediate tables.

    Where the setting is missing, a temporary folder is used in local mode only: on
    a cluster a machine-local folder would be lost together with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if spark.sparkContext.master.startswith("local"):
        application = spark.sparkContext.applicationId
        if application not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="claimgrade-")
        return _LOCAL_FOLDERS[application]
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def materialise(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder, in folders by ``partition_by``, and read it back.

    Used where work must not be repeated when a later stage is recomputed, such as
    calls to an outside reviewer.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/claimgrade/{label}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever store its path names."""
    try:
        spark.read.format("binaryFile").load(path).schema
        return True
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
