"""Incremental runs: each trigger takes the pages that are new."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from webcorpus.operators import keyed, store
from webcorpus.session import ddl, materialize

# State is kept on the executors' disks, and what changed goes to the checkpoint.
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def keep_state_on_disk(spark: SparkSession) -> None:
    """Set the state store of the session's streams, unless the session names one."""
    for key, value in _STATE.items():
        if not spark.sparkContext.getConf().contains(key):
            spark.conf.set(key, value)


def ingest(
    spark: SparkSession,
    path: str,
    schema: str,
    pattern: str = "*.parquet",
    max_files: int = 1000,
) -> DataFrame:
    """Stream of the files that arrive in a folder."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", max_files)
        .parquet(path)
    )


def stream_dedup(
    df: DataFrame,
    keys: Sequence[str],
    event_time: str | None = None,
    delay: str | None = None,
) -> DataFrame:
    """First row of each key.

    With an event time the keys are forgotten after `delay`, which bounds the
    state, and rows that are later than that are left out; without one they are
    kept for ever. `stream_distinct` bounds the state and loses nothing.
    """
    if event_time is None:
        return df.dropDuplicates(list(keys))
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_distinct(
    df: DataFrame, keys: Sequence[str], path: str, checkpoint: str, arrived: str, delay: str
) -> StreamingQuery:
    """Add the first row of each key to a table that is bucketed by the keys.

    State remembers the keys of the last `delay` only. A key that comes again
    later passes it and meets the stored keys, which are read without an
    exchange. `arrived` is the time a row came in, which never runs backwards, so
    no row is too late; an event time would not do. Null keys are one key.
    """
    spark = df.sparkSession
    keep_state_on_disk(spark)
    schema = ddl(df.schema.fields)

    def write(rows: DataFrame, batch: int) -> None:
        # A batch that is run again sees the table as it was before.
        known = keyed.read_batches(rows.sparkSession, path, schema, keys, before=batch)
        known = known.select(*[F.col(k).alias(f"_{k}") for k in keys])
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        count = keyed.bucket_count(rows.sparkSession, path)
        fresh = rows.repartition(count, *keys).join(known, same, "left_anti")
        keyed.write_batch(fresh, path, batch, keys)

    return (
        stream_dedup(df, keys, arrived, delay)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_summary(df: DataFrame) -> DataFrame:
    """Running totals (outcome, pages) from rows with an `outcome`."""
    return df.groupBy("outcome").agg(F.count(F.lit(1)).alias("pages"))


def changed_versions(chunks: DataFrame, newest: Sequence[str] = ("last_modified",)) -> DataFrame:
    """The rows of a stream that change what is stored, with `_known`: stored before.

    State is the last version of each key, nothing else. Of several rows of a key
    in one batch the newest counts; it passes unless its version is not empty and
    the one that is stored.
    """
    names = chunks.columns

    def order(row: pd.Series) -> tuple:
        return tuple((row[c] is not None, row[c]) for c in newest)

    def settle(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        best = None
        for part in parts:
            for at in range(len(part)):
                row = part.iloc[at]
                if best is None or order(row) > order(best.iloc[0]):
                    best = part.iloc[at : at + 1]
        version = best.iloc[0]["last_modified"]
        known = state.exists
        if known and version and version == state.get[0]:
            return
        state.update((version,))
        yield best[names].assign(_known=known)

    keep_state_on_disk(chunks.sparkSession)
    return chunks.groupBy(store.KEY).applyInPandasWithState(
        settle,
        f"{ddl(chunks.schema.fields)}, _known boolean",
        "last_modified string",
        "append",
        GroupStateTimeout.NoTimeout,
    )


def stream_upsert(
    chunks: DataFrame,
    path: str,
    checkpoint: str,
    newest: Sequence[str] = ("last_modified",),
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    first: int = 0,
) -> StreamingQuery:
    """Upsert every micro-batch into a stored table.

    What is stored of a key is known from the stream's state, so a micro-batch
    reads nothing that earlier ones wrote. Only keys that are new to the stream
    are looked up among the batches before `first`, which is the number of the
    stream's first batch in the table. A batch that is run again after a failure
    gets its old state and replaces its own rows. `prepare` may add columns,
    such as vectors, to changed rows.
    """

    def write(rows: DataFrame, batch: int) -> None:
        rows = materialize(rows, "changed")
        fresh = rows.drop("_known")
        if first:
            earlier = store.read_index(rows.sparkSession, path, before=first)
            new = store.changed(store.upsert_actions(rows.filter("not _known"), earlier))
            fresh = rows.filter("_known").unionByName(new).drop("_known")
        store.write_batch(prepare(fresh) if prepare else fresh, path, first + batch)

    return (
        changed_versions(chunks, newest)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_table(
    df: DataFrame, path: str, checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    """Stream into a folder of parquet files; `complete` replaces it each time."""
    if mode == "append":
        writer = df.writeStream.format("parquet").option("path", path)
    else:
        writer = df.writeStream.outputMode(mode).foreachBatch(
            lambda rows, _: rows.write.mode("overwrite").parquet(path)
        )
    return (
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
