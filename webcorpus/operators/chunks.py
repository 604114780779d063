"""Documents to chunk records."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcorpus.functions.text import (
    _step,
    let,
    non_blank,
    token_count,
    token_windows,
    tokenize,
    window_count,
)
from webcorpus.functions.urls import blob_hash, blob_stem, title
from webcorpus.operators.rows import exploded, small_batches
from webcorpus.session import ddl


class Codec(Protocol):
    """A token codec such as a byte-pair encoding."""

    def encode(self, text: str) -> Sequence[int]: ...

    def decode(self, tokens: Sequence[int]) -> str: ...


def word_windows(docs: DataFrame, size: int, overlap: int, *keep: str) -> DataFrame:
    """(*keep, chunk_index, chunk_total, content) over word tokens, blank windows too."""
    return _rows(docs, token_windows(tokenize("text"), size, overlap), *keep)


def _rows(docs: DataFrame, windows: Column, *keep: str) -> DataFrame:
    """One row per window, numbered from 1, with the number of windows.

    Number and count are put into the array elements, so that the array itself
    does not travel along with every row it gives.
    """
    numbered = let(
        windows,
        lambda texts: F.transform(
            texts,
            lambda text, at: F.struct(
                (at + 1).alias("chunk_index"),
                F.size(texts).alias("chunk_total"),
                text.alias("content"),
            ),
        ),
    )
    return exploded(docs, list(keep), numbered, "_w").select(
        *keep, "_w.chunk_index", "_w.chunk_total", "_w.content"
    )


def codec_windows(
    docs: DataFrame, make_codec: Callable[[], Codec], size: int, overlap: int, *keep: str
) -> DataFrame:
    """The same over the tokens of a codec, made once per Python worker task.

    Token numbers never leave the worker: texts go in, windows come out. A null
    text has no window. A task holds the tokens of one text at a time.
    """
    step = _step(size, overlap)
    schema = ddl(docs.select(*keep).schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = make_codec()

        def windows(text: str | None) -> list[str]:
            tokens = codec.encode(text or "")
            return [codec.decode(tokens[at : at + size]) for at in range(0, len(tokens), step)]

        for batch in small_batches(batches, "text"):
            made = pa.array([windows(text.as_py()) for text in batch["text"]], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [*[batch[name] for name in keep], made], names=[*keep, "windows"]
            )

    windows = docs.select(*keep, "text").mapInArrow(run, f"{schema}, windows array<string>")
    return _rows(windows, F.col("windows"), *keep)


def chunk_total(docs: DataFrame, size: int, overlap: int) -> DataFrame:
    """(url, chunk_total): windows of each document, blank ones counted."""
    return docs.select(
        "url", window_count(token_count("text"), size, overlap).alias("chunk_total")
    )


def emit_chunks(
    docs: DataFrame,
    size: int,
    overlap: int,
    make_codec: Callable[[], Codec] | None = None,
) -> DataFrame:
    """Chunk records without ids and vectors, from (url, text, last_modified).

    Blank windows are dropped but counted and numbered. The parts of the record
    key that depend on the URL alone are worked out once per document.
    """
    keyed = docs.select(
        "url",
        "text",
        "last_modified",
        title("url").alias("title"),
        blob_stem("url").alias("_stem"),
        blob_hash("url").alias("_hash"),
    )
    keep = ("url", "last_modified", "title", "_stem", "_hash")
    if make_codec is None:
        windows = word_windows(keyed, size, overlap, *keep)
    else:
        windows = codec_windows(keyed, make_codec, size, overlap, *keep)
    return windows.filter(non_blank("content")).select(
        F.concat(
            F.concat_ws("_", "_stem", F.col("chunk_index").cast("string"), "_hash"),
            F.lit(".json"),
        ).alias("blob_name"),
        "url",
        "title",
        "chunk_index",
        "chunk_total",
        "content",
        "last_modified",
    )


def drop_seen(chunks: DataFrame, seen: DataFrame) -> DataFrame:
    """Chunks whose (url, chunk_index) no earlier run emitted."""
    return chunks.join(seen.select("url", "chunk_index"), ["url", "chunk_index"], "left_anti")


def with_ids(df: DataFrame, random: bool = False) -> DataFrame:
    """Add a 32-digit hex `id`; by default the same key always gets the same id."""
    if random:
        ident = F.replace(F.uuid(), F.lit("-"), F.lit(""))
    else:
        ident = F.md5(F.concat_ws("#", "url", F.col("chunk_index").cast("string")))
    return df.withColumn("id", ident)
