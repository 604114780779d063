"""Order-dependent operators that stay parallel inside one key.

A key may hold a large share of all rows, so none of these sorts a whole key in
one task: rows are worked on in blocks of consecutive positions, and only one
short row per block goes on to the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webcorpus.session import materialize

BLOCK = 4096


def _listagg(text: str, separator: str, order: Sequence[str]) -> Column:
    escaped = separator.replace("\\", "\\\\").replace("\n", "\\n").replace("'", "\\'")
    keys = ", ".join(f"`{name}`" for name in order)
    return F.expr(f"listagg(`{text}`, '{escaped}') within group (order by {keys})")


def _block(order: str, size: int) -> Column:
    return F.floor(F.col(order) / F.lit(size)).cast("long")


def ordered_concat(
    df: DataFrame,
    keys: Sequence[str],
    order: str | Sequence[str],
    text: str,
    separator: str,
    block: int = BLOCK,
) -> DataFrame:
    """Join the texts of each key in the order of integer columns; null is empty."""
    order = [order] if isinstance(order, str) else list(order)
    parts = df.select(
        *keys,
        *order,
        _block(order[0], block).alias("_block"),
        F.coalesce(F.col(text), F.lit("")).alias(text),
    )
    blocks = parts.groupBy(*keys, "_block").agg(
        _listagg(text, separator, order).alias(text)
    )
    return blocks.groupBy(*keys).agg(_listagg(text, separator, ["_block"]).alias(text))


def join_parts(parts: DataFrame, key: str = "url") -> DataFrame:
    """Paragraphs (key, part_no, text) to one text per document."""
    return ordered_concat(parts, [key], "part_no", "text", "\n")


def join_pages(pages: DataFrame, key: str = "url") -> DataFrame:
    """PDF page texts (key, page_no, text) to one text per document."""
    return ordered_concat(pages, [key], "page_no", "text", "")


def join_cells(cells: DataFrame, key: str = "url") -> DataFrame:
    """Cells (key, sheet_no, row_no, col_no, value) to one text per workbook.

    Row 0 of every sheet holds the column names and is left out.
    """
    body = cells.filter(F.col("row_no") > 0)
    rows = ordered_concat(body, [key, "sheet_no", "row_no"], "col_no", "value", " ")
    sheets = ordered_concat(rows, [key, "sheet_no"], "row_no", "value", "\n")
    return ordered_concat(sheets, [key], "sheet_no", "value", "\n").withColumnRenamed(
        "value", "text"
    )


def carry_forward(
    df: DataFrame,
    keys: Sequence[str],
    order: str | Sequence[str],
    event: str,
    into: str,
    block: int = BLOCK,
) -> DataFrame:
    """Add the last non-null `event` strictly before each row of its key.

    Every block hands its last event on to the blocks after it; within a block
    an ordinary window does the rest.
    """
    order = [order] if isinstance(order, str) else list(order)
    blocked = df.withColumn("_block", _block(order[0], block))
    strictly_before = (Window.unboundedPreceding, -1)
    tails = blocked.groupBy(*keys, "_block").agg(
        F.max_by(event, F.when(F.col(event).isNotNull(), F.struct(*order))).alias("_tail")
    )
    over_key = Window.partitionBy(*keys).orderBy("_block").rowsBetween(*strictly_before)
    carried = tails.select(
        *keys, "_block", F.last("_tail", ignorenulls=True).over(over_key).alias("_carried")
    )
    in_block = (
        Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(*strictly_before)
    )
    return (
        blocked.withColumn("_seen", F.last(event, ignorenulls=True).over(in_block))
        .join(carried, [*keys, "_block"])
        .withColumn(into, F.coalesce("_seen", "_carried"))
        .drop("_seen", "_carried", "_block")
    )


def positions(df: DataFrame, order: Sequence[str], into: str, first: int = 0) -> DataFrame:
    """Add each row's position in a total order, from `first`, without a sort in one task.

    Rows are sorted in ranges. Where a range begins is the number of rows in the
    ranges before it, so only one short row per range meets the others.
    """
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranges = materialize(ranges.withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_begin")
    )
    inside = Window.partitionBy("_range").orderBy(*order)
    place = F.col("_begin") + F.row_number().over(inside) - 1 + first
    return ranges.join(begins, "_range").withColumn(into, place.cast("long")).drop("_range", "_begin")
