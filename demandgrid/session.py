"""Session settings and the shared folder for written intermediate data."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

#: For wide rows of numbers. The JVM never compiles methods beyond 8,000 bytes, so generated code longer than that runs interpreted:
#: Spark then takes its split form instead. Shuffled rows compress well, so a task that reads 64 MB of them holds gigabytes.
PLAN_SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}

#: Bytes of a file that one task of a registered plan reads. Daily facts have nearly as many groups as there are lines, so the map of the
#: first aggregate holds all that a task reads. A value that the session was given stays.
FILE_BYTES, GIVEN_FILE_BYTES = "spark.sql.files.maxPartitionBytes", "134217728b"
PLAN_FILE_BYTES = "16m"

_LOCAL_FOLDERS: dict[str, str] = {}


#: On a cluster adaptive execution merges shuffle partitions but never adds any, so it starts from many.
CLUSTER_SETTINGS = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192"}


def build_session(app: str = "demandgrid", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    cluster = CLUSTER_SETTINGS if master and not master.startswith("local") else {}
    for key, value in {**SESSION_SETTINGS, **cluster, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str | None:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session, where driver and executors share one disk, gets a folder of its own when the
    setting is missing; on a cluster the answer is then None.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        return None
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="demandgrid-")
    return _LOCAL_FOLDERS[application]


def shared_path(spark: SparkSession, name: str) -> str:
    folder = shared_folder(spark)
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame) -> DataFrame:
    """Hold a result that several jobs read. Lost blocks are rebuilt from lineage."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts the lineage and survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
