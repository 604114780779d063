"""What earlier runs left: visited URLs and emitted chunks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webcorpus.operators import keyed

_SCHEMA = "url string, chunk_index int"


def read_seen(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """(url, chunk_index) of emitted chunks; no file means none were.

    Our logs hold one JSON record per line, which Spark splits. `multi_line`
    reads files that hold one JSON array each.
    """
    try:
        docs = spark.read.schema(_SCHEMA).json(path, multiLine=multi_line)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _SCHEMA)
    return seen_keys(docs)


def seen_keys(docs: DataFrame) -> DataFrame:
    """Distinct keys; a record without an index counts as a first chunk."""
    return docs.select(
        "url", F.coalesce("chunk_index", F.lit(1)).cast("int").alias("chunk_index")
    ).distinct()


# State that a run leaves for the next: one batch of each table per run, bucketed by key.
_VISITED, _VISITED_KEY = "norm_url string", ["norm_url"]
_SEEN_KEY = ["url", "chunk_index"]


def visited_before(spark: SparkSession, path: str, batch: int) -> DataFrame:
    """(norm_url) of the URLs that runs before this one visited."""
    return keyed.read_batches(spark, path, _VISITED, _VISITED_KEY, batch).select("norm_url")


def seen_before(spark: SparkSession, path: str, batch: int) -> DataFrame:
    """(url, chunk_index) of the chunks that runs before this one wrote."""
    return keyed.read_batches(spark, path, _SCHEMA, _SEEN_KEY, batch).select(*_SEEN_KEY)


def remember(
    frontier: DataFrame, written: DataFrame, visited: str, seen: str, batch: int
) -> None:
    """Keep what a run visited and wrote. A run that is repeated replaces its batch."""
    keyed.write_batch(frontier.select("norm_url"), visited, batch, _VISITED_KEY)
    keyed.write_batch(written.select(*_SEEN_KEY), seen, batch, _SEEN_KEY)
