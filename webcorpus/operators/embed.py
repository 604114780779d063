"""Vectors for chunks through a client the caller gives."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcorpus.functions.text import non_blank, token_count
from webcorpus.operators.chunks import Codec
from webcorpus.session import ddl

Embedder = Callable[[Sequence[str]], Sequence[Sequence[float] | None]]


def embed_guard(text: Column | str, limit: int | None) -> Column:
    """Whether a text may be embedded: not blank and at most `limit` tokens, if set."""
    return non_blank(text) if limit is None else non_blank(text) & (token_count(text) <= limit)


Vector = Sequence[float] | None


def _vectors(embedder: Embedder, texts: list[str]) -> list[tuple[Vector, str | None]]:
    """(vector, error) per text; when the call fails, text by text."""
    try:
        return [(vector, None) for vector in embedder(texts)]
    except Exception as error:  # noqa: BLE001 - what a client raises becomes rows
        if len(texts) == 1:
            return [(None, f"{type(error).__name__}: {error}")]
        return [found for text in texts for found in _vectors(embedder, [text])]


def embed(
    chunks: DataFrame,
    make_embedder: Callable[[], Embedder],
    limit: int | None = None,
    batch_size: int = 64,
    text: str = "content",
    make_codec: Callable[[], Codec] | None = None,
    errors: str | None = None,
) -> DataFrame:
    """Add `embedding`, null for guarded texts and for errors.

    `errors` names a column that says why a call failed; it is null for texts
    that are blank or over the limit. With `make_codec` the limit counts the
    codec's tokens, else words. One client per task, `batch_size` texts per call.
    Put every filter and join that drops chunks before this operator: none is
    moved across it.
    """
    schema = ddl(chunks.schema.fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        embedder = make_embedder()
        codec = make_codec() if make_codec and limit is not None else None
        for batch in batches:
            texts = batch[text].to_numpy()
            wanted = batch["_embed"].to_numpy().nonzero()[0]
            if codec:
                wanted = [row for row in wanted if len(codec.encode(texts[row])) <= limit]
            results: list[tuple[Vector, str | None]] = [(None, None)] * len(batch)
            for at in range(0, len(wanted), batch_size):
                rows = wanted[at : at + batch_size]
                found = _vectors(embedder, [texts[row] for row in rows])
                for row, result in zip(rows, found, strict=True):
                    results[row] = result
            out = batch.drop(columns="_embed")
            out["embedding"] = [vector for vector, _ in results]
            if errors:
                out[errors] = [error for _, error in results]
            yield out

    guarded = chunks.withColumn("_embed", embed_guard(text, None if make_codec else limit))
    more = f", {errors} string" if errors else ""
    return guarded.mapInPandas(run, f"{schema}, embedding array<float>{more}")
