"""Importance resampling towards a target distribution, drawn by a distributed quickselect.

A document's features are its runs of words, hashed into buckets. A bucket's gain
is the log ratio of its smoothed share in the target to that in the raw corpus;
a document's weight is the mean gain, looked up in one array of all buckets.
Weight plus Gumbel noise, which depends on the doc_id only, is the score, and the
documents with the greatest scores are drawn without replacement.

No sort sees all documents. A few random documents per round are pivots; exact
counts before, at and after each of them say between which two the k-th document
lies, and only that stretch goes on to the next round. Then the documents that
are not behind the k-th, and no others, are sorted and ranked.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcorpus.llm.ranks import numbered
from webcorpus.llm.texts import chunks, sums
from webcorpus.session import ddl, materialize

#: Buckets of features, words in the longest feature, seed of the noise.
BUCKETS, LONGEST, SEED = 10_000, 1, 2024
#: A draw takes PERCENT of the documents that have at least MIN_WORDS words.
PERCENT, MIN_WORDS = 10, 20
#: Random pivots in a round of the selection.
PIVOTS = 15

#: Words of the UTF-8 bytes of a text whose letters A-Z are lower-cased.
_words = re.compile(rb"[0-9a-z\x80-\xff]+").findall


class Buckets(dict):
    """feature bytes -> bucket, remembered up to a bound."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[feature] = zlib.crc32(feature) % BUCKETS
        return value


def feature_buckets(
    texts: list[str], table: Buckets, longest: int = LONGEST
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features, the bounds of each text's, and its number of words."""
    found: list[int] = []
    bounds, words = np.zeros(len(texts) + 1, np.int64), np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        own = _words(text.encode("utf-8", "surrogatepass").lower())
        found += map(table.__getitem__, own)
        for size in range(2, longest + 1):
            runs = (b" ".join(own[i : i + size]) for i in range(len(own) - size + 1))
            found += map(table.__getitem__, runs)
        bounds[k + 1], words[k] = len(found), len(own)
    return np.array(found, np.int64), bounds, words


def bucket_counts(docs: DataFrame, longest: int = LONGEST) -> np.ndarray:
    """Features by bucket over all texts; at most BUCKETS rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, counts = Buckets(), np.zeros(BUCKETS, np.int64)
        for _, texts in chunks(batches):
            counts += np.bincount(feature_buckets(texts, table, longest)[0], minlength=BUCKETS)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(counts[used])], names=["bucket", "n"]
        )

    parts = docs.select("text").mapInArrow(run, "bucket long, n long")
    rows = parts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS, np.int64)
    out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 log(target share / raw share) of each bucket, floored."""
    s, t = raw.astype(np.float64), target.astype(np.float64)
    above = (t + 1) * (s.sum() + BUCKETS)
    below = (s + 1) * (t.sum() + BUCKETS)
    return np.floor(1000 * np.log(above / below)).astype(np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST) -> DataFrame:
    """(doc_id, n_features, weight, n_words): the floored mean gain of each text's features."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Buckets()
        for rows, texts in chunks(batches):
            buckets, bounds, words = feature_buckets(texts, table, longest)
            n = np.diff(bounds)
            weight = sums(shared.value[buckets], bounds) // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(n), pa.array(weight), pa.array(words)],
                names=["doc_id", "n_features", "weight", "n_words"],
            )

    source = docs.select("doc_id", "text")
    made = "n_features long, weight long, n_words long"
    return source.mapInArrow(run, f"{ddl([source.schema['doc_id']])}, {made}")


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """1000 times the Gumbel noise of a document, floored; a null id counts as ''."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))


def _after(key: dict, pivot: dict) -> Column:
    """Whether a row's composite key comes after a pivot's.

    The order is: greater scores, then smaller ids (null last), fewer features,
    and the row number, so that no two keys are equal.
    """
    tied = (key["n_features"] > pivot["n_features"]) | (
        (key["n_features"] == pivot["n_features"]) & (key["_row"] > pivot["_row"])
    )
    if pivot["doc_id"] is None:
        later, same = F.lit(False), key["doc_id"].isNull()
    else:
        later = key["doc_id"].isNull() | (key["doc_id"] > pivot["doc_id"])
        same = key["doc_id"].isNotNull() & (key["doc_id"] == pivot["doc_id"])
    behind = (key["score"] < pivot["score"]) | (
        (key["score"] == pivot["score"]) & (later | (same & tied))
    )
    return F.coalesce(behind, F.lit(False))


_KEY = ("score", "doc_id", "n_features", "_row")


def _place(row: dict) -> tuple:
    """A pivot's place in the order, for sorting the few pivots of a round."""
    return (-row["score"], row["doc_id"] is None, row["doc_id"] or 0, row["n_features"], row["_row"])


def kth_key(rows: DataFrame, k: int, pivots: int = PIVOTS) -> dict:
    """The composite key at position `k` (from 1) of `rows`, which has that many.

    Every round leaves about 1 / `pivots` of the rows; it is stored, so the rounds
    together read little more than the first one.
    """
    left, before, turn = rows.select(*_KEY), 0, 0
    while True:
        turn += 1
        random = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in _KEY], F.lit(turn))
        chosen = [r.asDict() for r in left.orderBy(random, "_row").limit(pivots).collect()]
        chosen.sort(key=_place)
        column = {c: F.col(c) for c in _KEY}
        # Position among the pivots: 2 j + 1 at pivot j, 2 j between pivots j - 1 and j.
        place = F.lit(0)
        for pivot in chosen:
            place = place + F.when(_after(column, pivot), 2).when(
                column["_row"] == pivot["_row"], 1
            ).otherwise(0)
        placed = left.withColumn("_place", place)
        counts = dict(placed.groupBy("_place").count().collect())
        for at in range(2 * len(chosen) + 1):
            if before + counts.get(at, 0) >= k:
                break
            before += counts.get(at, 0)
        if at % 2:
            return chosen[at // 2]
        left = materialize(placed.filter(F.col("_place") == at).drop("_place"), "stretch")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    longest: int = LONGEST,
    seed: int = SEED,
    pivots: int = PIVOTS,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank), a row per row of `docs`; rank null: not drawn.

    `docs` has doc_id (of any type that can be ordered) and text, `target` has text.
    A null text has no words and weight 0. Of repeated rows each counts on its
    own; equal keys get consecutive ranks. Rows with a null doc_id share one
    noise and come last among ties. An empty table gives no row; an empty
    target makes all gains follow the smoothing. Other columns are not read.
    """
    gain = gains(bucket_counts(docs, longest), bucket_counts(target, longest))
    scored = materialize(
        weighted(docs, gain, longest)
        .withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
        .withColumn("_row", F.monotonically_increasing_id()),
        "scored",
    )
    able = F.col("n_words") >= min_words
    k = math.floor(percent * scored.filter(able).count() / 100)
    made = ("doc_id", "n_features", "weight", "score")
    none = F.lit(None).cast("long").alias("rank")
    if not k:
        return scored.select(*made, none)
    last = kth_key(scored.filter(able), k, pivots)
    drawn = able & ~_after({c: F.col(c) for c in _KEY}, last)
    order = F.struct(-F.col("score"), F.col("doc_id").isNull(), "doc_id", "n_features", "_row")
    winners = numbered(scored.filter(drawn), order, "_at")
    return winners.select(*made, (F.col("_at") + 1).cast("long").alias("rank")).unionAll(
        scored.filter(~drawn).select(*made, none)
    )
