"""Session settings and the shared folder that intermediate tables go to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot hosts and hot pages: split skewed join partitions even when that
    # costs one more exchange further up the plan.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Pages are wide rows; small Arrow batches bound the Python worker's memory.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # No call-site capture per column expression: it costs milliseconds each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(
    app: str = "webcorpus", master: str | None = None, **conf: str
) -> SparkSession:
    """Session with the engine's settings; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ddl(fields: Iterable[StructField]) -> str:
    """Schema string of some fields, to build a longer schema from."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor sees, as the cluster names it in spark.checkpoint.dir.

    Only a local master, where driver and executors are one process, gets a
    temporary folder when the setting is missing.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    sc = spark.sparkContext
    folder = sc.getCheckpointDir()
    if folder:
        return folder
    # local-cluster has executors of its own; only local and local[...] have not.
    if sc.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="webcorpus-"))
    return sc.getCheckpointDir()


#: Intermediate folders of each application.
_made: dict[str, list[str]] = {}


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def remove_intermediates(spark: SparkSession) -> int:
    """Delete the folders that this application's intermediate tables went to.

    For the end of a job, when its results are written: a DataFrame that still
    reads such a folder fails afterwards. Gives the number of folders.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    paths = _made.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)
    return len(paths)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Cuts the lineage so that a lost executor re-reads files instead of
    re-running the plan, and gives the planner real sizes for join choices.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def bucketed(
    df: DataFrame, columns: Sequence[str], label: str, buckets: int | None = None
) -> Iterator[DataFrame]:
    """`df` as a table bucketed and sorted by `columns`, for repeated joins on them.

    The rows move once, when the table is written; joins on the bucket columns
    then read it in place. The catalog entry lasts as long as the block.
    """
    spark = df.sparkSession
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = new_folder(spark, label)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    (
        df.repartition(count, *columns)
        .write.format("parquet")
        .bucketBy(count, *columns)
        .sortBy(*columns)
        .option("path", path)
        .saveAsTable(name)
    )
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
