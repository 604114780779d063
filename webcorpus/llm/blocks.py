"""Blocks of documents, each with a list of the things its documents refer to.

What a document refers to, such as its words, is a number within its block, and
the block lists what its numbers stand for. To look things up in a table of any
size, only the lists are joined with it. A thing comes once per block, however
often its documents name it, and what was found returns to the block by one
exchange. No table is broadcast and no key gathers more rows than there are blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.session import ddl, materialize


def packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32, compressed."""
    return pa.compress(numbers.astype(np.uint32).tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, count: int) -> np.ndarray:
    raw = pa.decompress(data, decompressed_size=4 * count, codec="zstd", asbytes=True)
    return np.frombuffer(raw, np.uint32).astype(np.int64)


def sliced(names: list[str], *columns: np.ndarray, rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """Columns of one length as batches of bounded size."""
    for k in range(0, len(columns[0]), rows):
        yield pa.RecordBatch.from_arrays([pa.array(c[k : k + rows]) for c in columns], names=names)


def by_frequency(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(things, codes): the distinct keys, most frequent first, and each key's place there."""
    things, codes, counts = np.unique(keys, return_inverse=True, return_counts=True)
    order = np.argsort(-counts, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return things[order], place[codes.reshape(-1)]


def stored(blocks: DataFrame, label: str) -> DataFrame:
    """The blocks with a number `block`, written, so that the numbers stay."""
    return materialize(blocks.withColumn("block", F.monotonically_increasing_id()), label)


def listed(blocks: DataFrame, *names: str) -> DataFrame:
    """(block, at, *names): the entries of some list columns of one length, a row each."""
    fields = [blocks.schema[name] for name in names]
    schema = ", ".join(f"`{f.name}` {f.dataType.elementType.simpleString()}" for f in fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                lists = [batch.column(name)[k].values for name in names]
                if lists[0] is None or not len(lists[0]):
                    continue
                n = len(lists[0])
                block = np.full(n, batch.column("block")[k].as_py(), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block), pa.array(np.arange(n, dtype=np.int32)), *lists],
                    names=["block", "at", *names],
                )

    return blocks.select("block", *names).mapInArrow(run, f"block long, at int, {schema}")


def looked_up(
    blocks: DataFrame,
    things: str,
    values: DataFrame,
    key: str,
    function: Callable[[pa.Table, pa.Table], pa.Table],
    schema: str,
) -> DataFrame:
    """`function` of each block and the rows (at, ...) found in `values` for its things.

    `values` has one row per `key`; what it does not have gives no row.
    """
    entries = listed(blocks, things).withColumnRenamed(things, key)
    found = entries.join(values, key).drop(key)
    return (
        blocks.drop(things).groupBy("block").cogroup(found.groupBy("block")).applyInArrow(function, schema)
    )


def id_type(docs: DataFrame) -> str:
    """Type of `doc_id` as schema text."""
    return ddl([docs.schema["doc_id"]]).split(" ", 1)[1]
