"""Tables that grow by batches and are looked up by key.

Each batch is a folder of files bucketed and sorted by the key. Spark reads a
bucket of all batches as one partition, so a lookup or the choice of the newest
row per key moves nothing on the table's side. Writing a batch again replaces
it, also when it is empty.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _buckets(spark: SparkSession, path: str) -> int | None:
    """Buckets of the table, fixed by its first batch; none: nothing was written."""
    try:
        return spark.read.schema("buckets int").json(f"{path}-layout").first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def bucket_count(spark: SparkSession, path: str) -> int:
    """Buckets of the table, or those that its first batch will have."""
    return _buckets(spark, path) or int(spark.conf.get("spark.sql.shuffle.partitions"))


def write_batch(
    rows: DataFrame, path: str, batch: int, keys: Sequence[str], buckets: int | None = None
) -> None:
    """Add or replace one batch. Rows that are dealt by the keys already stay where they are.

    With `buckets` the caller keeps their number, and gives it to `read_batches`
    too; otherwise it is kept beside the table.
    """
    spark = rows.sparkSession
    known = buckets or _buckets(spark, path)
    count = known or bucket_count(spark, path)
    if known is None:
        layout = spark.range(1).select(F.lit(count).alias("buckets"))
        layout.coalesce(1).write.mode("overwrite").json(f"{path}-layout")
    name = f"batch_{uuid.uuid4().hex}"
    (
        rows.repartition(count, *keys)
        .write.format("parquet")
        .mode("overwrite")
        .bucketBy(count, *keys)
        .sortBy(*keys)
        .option("path", f"{path}/batch={batch}")
        .saveAsTable(name)
    )
    spark.sql(f"DROP TABLE {name}")  # the files stay


def read_batches(
    spark: SparkSession,
    path: str,
    schema: str,
    keys: Sequence[str],
    before: int | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """All rows with their `batch`, or those of the batches before one of them.

    The table stays in the session's catalog, under a name that its path gives.
    """
    count = buckets or _buckets(spark, path)
    if count is None:
        return spark.createDataFrame([], f"{schema}, batch long")
    name = "keyed_" + hashlib.md5(f"{path} {schema} {count}".encode()).hexdigest()
    by = ", ".join(f"`{key}`" for key in keys)
    location = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({schema}, batch long) USING parquet "
        f"PARTITIONED BY (batch) CLUSTERED BY ({by}) SORTED BY ({by}) INTO {count} BUCKETS "
        f"LOCATION '{location}'"
    )
    spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    rows = spark.table(name)
    return rows if before is None else rows.filter(F.col("batch") < before)
