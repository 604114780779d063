"""Run reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_summary(visited: DataFrame, failed: DataFrame) -> DataFrame:
    """One row: status, visited, failed."""
    rows = visited.select(F.lit(True).alias("_v")).unionByName(
        failed.select(F.lit(False).alias("_v"))
    )
    return rows.agg(
        F.lit("ok").alias("status"),
        F.count_if("_v").alias("visited"),
        F.count_if(~F.col("_v")).alias("failed"),
    )


def emitted_urls(chunks: DataFrame, distinct: bool = False) -> DataFrame:
    """URL of every emitted chunk, once per chunk or once per URL."""
    urls = chunks.select("url")
    return urls.distinct() if distinct else urls


def emitted_docs(actions: DataFrame) -> DataFrame:
    """Chunks that the upsert wrote; skipped ones are left out."""
    return actions.filter("action <> 'skip'").drop("action")
