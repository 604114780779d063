"""Arrays to rows, and rows in small batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exploded(
    df: DataFrame, keep: list[Column | str], array: Column, name: str, position: str | None = None
) -> DataFrame:
    """(*keep, [position], name): one row per element; elements are not null.

    An inner explode makes the optimizer add a size filter below it, which
    evaluates a computed array once more. The outer form does not, and the
    filter here is on the finished element.
    """
    if position:
        element = F.posexplode_outer(array).alias(position, name)
    else:
        element = F.explode_outer(array).alias(name)
    return df.select(*keep, element).filter(F.col(name).isNotNull())


def small_batches(
    batches: Iterable[pa.RecordBatch], column: str, size: int = 1 << 20, rows: int = 256
) -> Iterator[pa.RecordBatch]:
    """The rows in batches of at most `rows` whose `column` has about `size` bytes.

    A longer value is a batch of its own. What a task makes of its rows is then
    bounded whatever number of rows the session puts into a batch.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for k, more in enumerate(sizes):
            if k > start and (held + more > size or k - start >= rows):
                yield batch.slice(start, k - start)
                start, held = k, 0
            held += more
        if start < len(sizes):
            yield batch.slice(start)
