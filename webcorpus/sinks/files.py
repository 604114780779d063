"""Writers of records and logs, one row per record."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_chunks(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Chunk records or 404 records; JSON is one UTF-8 document per line."""
    df.write.mode("append").format(fmt).save(path)


def write_log(df: DataFrame, path: str) -> None:
    """Replace a log of the last run, also when there is nothing to report."""
    df.write.mode("overwrite").json(path)


def write_failures(df: DataFrame, path: str) -> None:
    write_log(df.select("url", "reason"), path)


def write_emitted_urls(df: DataFrame, path: str) -> None:
    write_log(df.select("url"), path)


def write_emitted_docs(df: DataFrame, path: str) -> None:
    write_log(df, path)
