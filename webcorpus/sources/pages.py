"""Scans of fetched pages and of page texts decoded elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Fetched pages. Columns not used later are never read from the files."""
    return spark.read.parquet(path)


def read_binary(
    spark: SparkSession, path: str, suffix: str | None = None, max_bytes: int | None = None
) -> DataFrame:
    """Files as (path, modificationTime, length, content).

    The size limit is part of the scan: larger files are never opened.
    """
    reader = spark.read.format("binaryFile")
    if suffix:
        reader = reader.option("pathGlobFilter", f"*.{suffix}")
    files = reader.load(path)
    return files if max_bytes is None else files.filter(F.col("length") <= max_bytes)


def size_cut(df: DataFrame, max_bytes: int, length: str = "length") -> DataFrame:
    """Drop documents larger than the limit; an unknown size is kept."""
    return df.filter(F.col(length).isNull() | (F.col(length) <= max_bytes))
