"""Keyed upsert of chunk records that leaves unchanged ones alone."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webcorpus.operators import keyed
from webcorpus.session import materialize

KEY = "blob_name"


def match_store(incoming: DataFrame, store: DataFrame, key: str = KEY) -> DataFrame:
    """Add what the store has for each key: `stored_modified`, `in_store`."""
    stored = store.select(
        key, F.col("last_modified").alias("stored_modified"), F.lit(True).alias("in_store")
    )
    return incoming.join(stored, key, "left").withColumn(
        "in_store", F.coalesce("in_store", F.lit(False))
    )


def _unchanged(incoming: Column, stored: Column) -> Column:
    """Equal and not empty. Values are compared as they are: an older one differs too."""
    return F.coalesce((incoming != "") & (incoming == stored), F.lit(False))


def upsert_actions(incoming: DataFrame, store: DataFrame, key: str = KEY) -> DataFrame:
    """Add `action`: insert, update, or skip for an unchanged `last_modified`."""
    action = (
        F.when(~F.col("in_store"), "insert")
        .when(_unchanged(F.col("last_modified"), F.col("stored_modified")), "skip")
        .otherwise("update")
    )
    return (
        match_store(incoming, store, key)
        .withColumn("action", action)
        .drop("stored_modified", "in_store")
    )


def changed(actions: DataFrame) -> DataFrame:
    """The rows an upsert writes."""
    return actions.filter("action <> 'skip'").drop("action")


def upsert(store: DataFrame, incoming: DataFrame, key: str = KEY) -> DataFrame:
    """The store after the upsert. Keys that are not incoming stay as they are.

    Keys are unique on both sides. One full join moves each side once and
    settles every key, whether it is stored, incoming or both.
    """
    columns = store.columns
    both = store.select(key, F.struct(*columns).alias("_old")).join(
        incoming.select(key, F.struct(*columns).alias("_new")), key, "full_outer"
    )
    stays = F.col("_new").isNull() | (
        F.col("_old").isNotNull()
        & _unchanged(F.col("_new.last_modified"), F.col("_old.last_modified"))
    )
    return both.select(F.when(stays, F.col("_old")).otherwise(F.col("_new")).alias("_row")).select(
        "_row.*"
    )


# A stored table has two parts: `records`, a folder of batches with the rows that
# changed, and `index`, the key, version and batch of these rows, bucketed by key.
# An upsert reads the index alone; contents are read for the keys that changed.

_INDEX = f"{KEY} string, last_modified string, since long, whole boolean"
#: Batches after which a batch of the index takes in all that came before it.
COMPACT_EVERY = 16


def _records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(f"{schema}, batch long").parquet(f"{path}/records")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{schema}, batch long")


def _index_batches(spark: SparkSession, path: str, before: int | None) -> DataFrame:
    """Rows of the index since the last batch that took in all before it."""
    rows = keyed.read_batches(spark, f"{path}/index", _INDEX, [KEY], before)
    whole = rows.filter("whole").agg(F.max("batch")).first()[0]
    return rows if whole is None else rows.filter(F.col("batch") >= whole)


def _newest(rows: DataFrame) -> DataFrame:
    """(key, last_modified, since): the newest row per key."""
    newest = F.max_by(F.struct("last_modified", "since"), F.struct("batch", "since"))
    return rows.groupBy(KEY).agg(newest.alias("_n")).select(KEY, "_n.last_modified", "_n.since")


def read_index(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """(key, last_modified, since) of every stored key; nothing is exchanged for it."""
    return _newest(_index_batches(spark, path, before))


def read_store(
    spark: SparkSession, path: str, schema: str, before: int | None = None
) -> DataFrame:
    """Current rows of a stored table, or as of the batches before one of them."""
    current = read_index(spark, path, before).select(KEY, F.col("since").alias("batch"))
    return _records(spark, path, schema).join(current, [KEY, "batch"], "left_semi").drop("batch")


def read_batch(spark: SparkSession, path: str, schema: str, batch: int) -> DataFrame:
    """The rows that one batch wrote."""
    return _records(spark, path, schema).filter(F.col("batch") == batch).drop("batch")


def write_batch(
    rows: DataFrame,
    path: str,
    batch: int,
    compact_every: int = COMPACT_EVERY,
    retry: str | None = None,
) -> None:
    """Add the changed rows of a run. Running a batch again replaces it.

    A row whose `retry` column is not null counts as one of no known version, so
    the next upsert writes it again though it did not change.

    After some batches the index is written whole, so that a lookup reads about
    one row per key however many batches there are.
    """
    spark = rows.sparkSession
    # The batch's own folder is replaced, so a repeat without rows leaves none.
    rows.drop("batch").write.mode("overwrite").parquet(f"{path}/records/batch={batch}")
    more = f", {retry} string" if retry else ""
    written = spark.read.schema(f"{KEY} string, last_modified string{more}").parquet(
        f"{path}/records/batch={batch}"
    )
    version = F.when(F.col(retry).isNull(), F.col("last_modified")) if retry else F.col("last_modified")
    fresh = written.select(
        KEY, version.alias("last_modified"), F.lit(batch).cast("long").alias("since")
    )
    earlier = _index_batches(spark, path, batch)
    whole = earlier.agg(F.count_distinct("batch")).first()[0] >= compact_every
    if whole:
        stays = _newest(earlier).join(fresh.select(KEY), KEY, "left_anti")
        # Written apart, as a table is not read while one of its folders is replaced.
        fresh = materialize(stays.unionByName(fresh), "index")
    keyed.write_batch(fresh.withColumn("whole", F.lit(whole)), f"{path}/index", batch, [KEY])


def newest_versions(incoming: DataFrame, *newest: str) -> tuple[DataFrame, DataFrame]:
    """`incoming` with `_version`, and (key, last_modified, _version) of its newest rows.

    Versions are told apart by the order columns and then by a hash of the row,
    so equal rows are one version and the choice needs no contents.
    """
    hashed = incoming.withColumn("_version", F.xxhash64(*incoming.columns))
    best = F.max(F.struct(*newest, "_version")).alias("_best")
    last = F.max_by("last_modified", F.struct(*newest, "_version")).alias("last_modified")
    chosen = hashed.groupBy(KEY).agg(best, last)
    return hashed, chosen.select(KEY, "last_modified", F.col("_best._version").alias("_version"))


def changed_rows(incoming: DataFrame, path: str, batch: int, *newest: str) -> DataFrame:
    """The rows of `incoming` that an upsert as this batch writes, one per key.

    The newest version per key is chosen, and compared with the index, on narrow
    rows. Contents move once, and only to the keys that changed. `incoming` is
    read twice: give a stored table.
    """
    spark = incoming.sparkSession
    count = keyed.bucket_count(spark, f"{path}/index")
    hashed, chosen = newest_versions(incoming, *newest)
    actions = upsert_actions(chosen.repartition(count, KEY), read_index(spark, path, batch))
    fresh = materialize(changed(actions).select(KEY, F.col("_version").alias("_chosen")), "changed")
    # Equal rows are one: the test on versions leaves the join and the choice on one key.
    same = hashed.join(fresh, KEY).filter(F.expr("(_version ^ _chosen) = 0"))
    return same.drop("_version", "_chosen").dropDuplicates([KEY])


def compact(spark: SparkSession, path: str, into: str, schema: str) -> None:
    """Write the current rows of a stored table as the first batch of a new one."""
    write_batch(read_store(spark, path, schema), into, 0)
