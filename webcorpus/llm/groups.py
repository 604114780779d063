"""Sorted groups inside tasks, and connected components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.session import materialize


def together(df: DataFrame, *keys: str, order: Sequence[str] = ()) -> DataFrame:
    """Rows dealt by `keys` and sorted by them, for `whole_groups` to read."""
    return df.repartition(*keys).sortWithinPartitions(*keys, *order)


def bounds_of(columns: Sequence[np.ndarray]) -> np.ndarray:
    """Bounds of the runs of equal rows in some columns of one length."""
    n = len(columns[0])
    new = np.zeros(n + 1, bool)
    new[0] = new[n] = True
    for column in columns:
        new[1:n] |= column[1:] != column[:-1]
    return np.flatnonzero(new) if n else np.zeros(1, np.int64)


def whole_groups(
    batches: Iterable[pa.RecordBatch], keys: Sequence[str]
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups with the groups' bounds, from rows sorted by numeric keys.

    A table holds the groups that end in one batch, so memory is bounded by a
    batch and the largest group.
    """
    waiting: list[pa.RecordBatch] = []

    def closed(parts: list[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray]:
        rows = pa.Table.from_batches(parts)
        return rows, bounds_of([rows.column(k).to_numpy() for k in keys])

    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        ends = [pa.Table.from_batches([b]) for b in (waiting[0], batch)]
        if all(ends[0].column(k)[0] == ends[1].column(k)[batch.num_rows - 1] for k in keys):
            continue  # one group so far
        rows, bounds = closed(waiting)
        last = int(bounds[-2])
        yield rows.slice(0, last), bounds[:-1]
        waiting = rows.slice(last).to_batches()
    if waiting:
        yield closed(waiting)


def linked(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row that each of `n` rows is connected to by the links a - b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    while (label != label[label]).any():
        label = label[label]
    return label


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id in `edges` (a, b): the smallest id it is connected to.

    Each round takes the smallest label among the neighbours and then the label
    of that label, so that long chains halve; labels are pre-aggregated before
    they move, whatever an id's number of edges. Each round is stored.
    """
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(both.distinct(), "edges")
    labels = materialize(
        both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("low")).select(
            "id", F.least("id", "low").alias("label")
        ),
        "labels",
    )
    while True:
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy("a").agg(
            F.min("label").alias("near")
        )
        lower = labels.join(near, F.col("id") == F.col("a")).select(
            "id", "label", F.least("label", "near").alias("low")
        )
        lower = materialize(lower, "labels")
        jump = lower.select(F.col("id").alias("at"), F.col("low").alias("jump"))
        moved = materialize(
            lower.join(jump, F.col("low") == F.col("at")).select(
                "id", F.least("low", "jump").alias("new"), (F.col("label") != F.least("low", "jump")).alias("changed"),
            ),
            "labels",
        )
        labels = moved.select("id", F.col("new").alias("label"))
        if moved.filter("changed").isEmpty():
            return labels.withColumnRenamed("label", "component")
