"""Merkle fixity audit of WARC replicas.

A record is hashed with its place in its file. The records whose offset falls
into one range of SPAN bytes are hashed in order of offset into a leaf node;
FANOUT neighbouring ranges make the next node, up to one root for a file. Two
replicas are compared by their roots, and only below nodes that differ are the
children compared, down to the records. There records are matched by what they
hold, so that a lost or longer record, which shifts all that come after it in its
file, is found alone.

All of it is joins and grouping. A group holds the records of one range or the
children of one node, so a file of any size is hashed by many tasks; between
replicas only hashes of nodes move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webcorpus.session import materialize

#: Bytes of offset that a leaf node covers, and children of an inner node.
SPAN = 1 << 20
FANOUT = 16
FILE_RECORDS = 500
#: Names of a found record's place in the result.
FOUND = ("file", "file_offset", "record_id")
#: Leaf nodes that records without an offset are dealt to, by their hash.
UNPLACED = 1024


def warc_records(pages: DataFrame) -> DataFrame:
    """Pages as WARC response records: (record_id, length, record).

    A record is the header block and the html (empty for a null), as bytes.
    Repeated rows are repeated records.
    """
    body = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    name = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        name,
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce("url", F.lit("")),
        F.lit("\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    record = F.concat(F.encode(head, "UTF-8"), body, F.encode(F.lit("\r\n\r\n"), "UTF-8"))
    return pages.select(F.col("page_id").alias("record_id"), record.alias("record")).withColumn(
        "length", F.octet_length("record").cast("long")
    )


def hashed(records: DataFrame) -> DataFrame:
    """Replace `record` by its `hash`; a null record is hashed as an empty one."""
    digest = F.sha2(F.coalesce("record", F.lit(b"")), 256)
    return records.withColumn("hash", digest).drop("record")


def laid_out(hashes: DataFrame, file_records: int = FILE_RECORDS) -> DataFrame:
    """Lay records (record_id, length, hash) into files one after the other.

    A file has the records of `file_records` consecutive ids in order, so no
    window is longer than that but for repeated rows; null ids have their own.
    """
    number = F.floor(F.col("record_id") / file_records)
    file = F.when(number.isNull(), "none.warc").otherwise(F.format_string("%08d.warc", number))
    before = (
        Window.partitionBy("file")
        .orderBy("record_id", "length", "hash")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offset = F.coalesce(F.sum("length").over(before), F.lit(0).cast("long"))
    return hashes.withColumn("file", file).withColumn("offset", offset)


def _digest(lines: Column) -> Column:
    return F.sha2(F.array_join(lines, "\n"), 256)


def _counted(hashes: DataFrame) -> DataFrame:
    """One row for equal records at one place, with their number and leaf node."""
    offset = F.col("offset").cast("long")
    unplaced = F.pmod(F.xxhash64("hash"), F.lit(UNPLACED))
    return (
        hashes.select(
            F.coalesce("file", F.lit("")).alias("file"),
            F.coalesce(offset, F.lit(0)).alias("offset"),
            F.when(offset.isNull(), unplaced).otherwise(F.floor(offset / SPAN)).alias("node"),
            "record_id",
            F.coalesce(F.col("length"), F.lit(0)).cast("long").alias("length"),
            F.coalesce("hash", F.lit("")).alias("hash"),
        )
        .groupBy("file", "node", "offset", "record_id", "length", "hash")
        .agg(F.count("*").alias("n"))
    )


def merkle_levels(counted: DataFrame, height: int) -> list[DataFrame]:
    """Levels of (file, node, hash) from the leaf ranges to the roots, stored."""

    def line(row: Column, names: tuple[str, ...]) -> Column:
        return F.concat_ws(" ", *[row[n].cast("string") for n in names])

    names = ("offset", "length", "hash", "n")
    lines = F.transform(
        F.array_sort(F.collect_list(F.struct(*names))), lambda row: line(row, names)
    )
    leaves = counted.groupBy("file", "node").agg(_digest(lines).alias("hash"))
    levels = [materialize(leaves, "merkle")]
    for _ in range(height):
        lines = F.transform(
            F.array_sort(F.collect_list(F.struct("node", "hash"))),
            lambda row: line(row, ("node", "hash")),
        )
        parents = levels[-1].groupBy("file", F.floor(F.col("node") / FANOUT).alias("parent"))
        level = parents.agg(_digest(lines).alias("hash")).withColumnRenamed("parent", "node")
        levels.append(materialize(level, "merkle"))
    return levels


def _differing(a: DataFrame, b: DataFrame, under: DataFrame | None) -> DataFrame:
    """(file, node) that differ or that one side lacks, below the nodes of `under`."""
    if under is not None:
        below = under.withColumnRenamed("node", "up")
        a, b = (
            side.withColumn("up", F.floor(F.col("node") / FANOUT))
            .join(below, ["file", "up"], "left_semi")
            .drop("up")
            for side in (a, b)
        )
    joined = a.join(b.withColumnRenamed("hash", "other"), ["file", "node"], "full_outer")
    return joined.filter(~F.col("hash").eqNullSafe(F.col("other"))).select("file", "node")


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """Records in which two replicas differ, found from the roots down.

    Both sides have (file, offset, length, record_id, hash). Gives (file,
    file_offset, record_id, first_length, second_length, first_hash, second_hash);
    length and hash of a side without such a record are null, and the offset is
    that of the first side if it has the record. Records are matched by file and
    record_id (nulls match) and are equal when length and hash are, wherever they
    stand; a record that only moved is none. Of several that differ under one
    record_id the greatest length and hash are shown, and a lost repetition shows
    as a row with both hashes equal. A null file is the file with the empty name;
    records without an offset are compared as well. Empty replicas agree. Other
    columns are not read.
    """
    counted = [materialize(_counted(side), "records") for side in (first, second)]
    top = max(side.agg(F.max("node")).first()[0] or 0 for side in counted)
    height = 0
    while top:
        top, height = top // FANOUT, height + 1
    levels = [merkle_levels(side, height) for side in counted]
    under = None
    for a, b in zip(*(reversed(side) for side in levels)):
        under = materialize(_differing(a, b, under), "differing")
    keys = ["file", "record_id", "length", "hash"]
    a, b = (
        side.join(under, ["file", "node"], "left_semi")
        .groupBy(*keys)
        .agg(F.sum("n").alias("n"), F.min("offset").alias("offset"))
        for side in counted
    )
    joined = a.join(b, [a[k].eqNullSafe(b[k]) for k in keys], "full_outer")
    differ = joined.filter(~a["n"].eqNullSafe(b["n"])).select(
        *[F.coalesce(a[k], b[k]).alias(k) for k in ("file", "record_id")],
        a["offset"].alias("first_offset"),
        b["offset"].alias("second_offset"),
        *[side[c].alias(f"{name}_{c}") for c in ("length", "hash") for side, name in ((a, "first"), (b, "second"))],
    )
    shown = ("first_length", "second_length", "first_hash", "second_hash")
    found = differ.groupBy("file", "record_id").agg(
        F.coalesce(F.min("first_offset"), F.min("second_offset")).alias("file_offset"),
        *[F.max(c).alias(c) for c in shown],
    )
    return found.select(*FOUND, *shown)
