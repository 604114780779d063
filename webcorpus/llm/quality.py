"""Quality rules: base rules, then a hashed n-gram log-likelihood ratio.

Two multinomials are counted over hashed one- and two-word n-grams: `trusted`
from documents labelled good, `raw` from the whole corpus. A document's score is
the mean over its n-grams of log(trusted / raw). The logarithms are rounded to
2^-16, so that scores are sums of whole numbers and do not depend on the order
of rows or tasks; every document gets a verdict from the same threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.llm.texts import WordHashes, chunks, flat_words, sums
from webcorpus.session import ddl

#: Hash buckets for each n-gram length; a prime.
BUCKETS = 10_007
SCALE = 65_536
#: Words that are counted at once.
WORDS = 300_000
#: Added to the count of each bucket in both multinomials.
SMOOTHING = 10.0
#: Mean log ratio from which a document is kept.
THRESHOLD = -0.1
MIN_WORDS = 50
MAX_REPEATED = 50

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per text, the words inside three-word windows that the text has twice or more."""
    n = len(hashes)
    covered = np.zeros(n, bool)
    if n >= 3:
        owner = np.repeat(np.arange(len(bounds) - 1, dtype=np.uint64), np.diff(bounds))
        mixed = hashes * np.uint64(0x9E3779B97F4A7C15)
        code = (
            (mixed[:-2] ^ (mixed[:-2] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            + (mixed[1:-1] ^ (mixed[1:-1] >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
            + mixed[2:]
            + owner[:-2] * np.uint64(0xD6E8FEB86659FD93)
        )
        inside = np.flatnonzero(owner[:-2] == owner[2:])
        order = inside[np.argsort(code[inside], kind="stable")]
        same = code[order[1:]] == code[order[:-1]]
        twice = np.zeros(len(order), bool)
        twice[1:] |= same
        twice[:-1] |= same
        hit = order[twice]
        for shift in range(3):
            covered[hit + shift] = True
    return sums(covered, bounds)


def base_stats(
    texts: list[str], flat: list[str], bounds: np.ndarray, hashes: np.ndarray
) -> dict[str, np.ndarray]:
    """The columns of STATS for some whole texts."""
    word_chars = [
        len("".join(flat[a:b])) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())
    ]
    n_dup = []
    for text in texts:
        worded = [line for line in text.split("\n") if line.strip(BLANKS)]
        n_dup.append(len(worded) - len(set(worded)))
    return {
        "n_words": np.diff(bounds),
        "word_chars": np.array(word_chars, np.int64),
        "n_symbols": np.array([sum(map(text.count, SYMBOLS)) for text in texts], np.int64),
        "n_dup_lines": np.array(n_dup, np.int64),
        "n_repeat_words": repeated_words(hashes, bounds),
    }


def ngram_buckets(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every word, and of the word pair that starts there (-1: none)."""
    size = np.uint64(BUCKETS)
    one = (hashes % size).astype(np.int64)
    two = np.full(len(hashes), -1, np.int64)
    if len(hashes) > 1:
        two[:-1] = BUCKETS + ((hashes[:-1] * np.uint64(31) + hashes[1:]) % size).astype(np.int64)
    last = bounds[1:][np.diff(bounds) > 0] - 1
    two[last] = -1
    return one, two


def coded(docs: DataFrame) -> DataFrame:
    """(doc_id, n, codes): each text's words as 2-byte buckets, compressed.

    The bucket of a word pair follows from those of its words, so this is all
    that the counts need of a text, and far less to move.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordHashes(4)
        for rows, texts in chunks(batches):
            flat, bounds = flat_words(texts)
            codes = (table.array(flat) % np.uint64(BUCKETS)).astype(np.uint16)
            parts = [
                pa.compress(codes[a:b].tobytes(), codec="zstd", asbytes=True)
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())
            ]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(np.diff(bounds)), pa.array(parts, pa.binary())],
                names=["doc_id", "n", "codes"],
            )

    source = docs.select("doc_id", "text")
    return source.mapInArrow(run, f"{ddl([source.schema['doc_id']])}, n long, codes binary")


def ngram_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(bucket, raw, trusted): n-grams of all texts, and of those labelled good.

    The texts are read once. Their codes meet the labels by one exchange, with
    the same plan at every size; each task sends every bucket at most once.
    """
    good = labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull())
    good = good.select("doc_id", F.lit(True).alias("trusted")).distinct()
    judged = coded(docs).hint("merge").join(good, "doc_id", "left")

    def add(counts: np.ndarray, codes: list[bytes], n: list[int], trusted: list[bool]) -> None:
        words = np.frombuffer(b"".join(codes), np.uint16).astype(np.uint64)
        one, two = ngram_buckets(words, np.append(0, np.cumsum(n)))
        good = np.repeat(trusted, n)
        for total, some in ((counts[0], slice(None)), (counts[1], good)):
            paired = two[some]
            total += np.bincount(one[some], minlength=2 * BUCKETS)
            total += np.bincount(paired[paired >= 0], minlength=2 * BUCKETS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 2 * BUCKETS), np.int64)
        for batch in batches:
            held, words = ([], [], []), 0
            columns = (batch.column(c) for c in ("codes", "n", "trusted"))
            for data, n, trusted in zip(*columns):
                size = n.as_py()
                raw = pa.decompress(data.as_buffer(), 2 * size, codec="zstd", asbytes=True)
                for kept, value in zip(held, (raw, size, bool(trusted.as_py()))):
                    kept.append(value)
                words += size
                if words >= WORDS:
                    add(counts, *held)
                    held, words = ([], [], []), 0
            if held[1]:
                add(counts, *held)
        used = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(counts[0][used]), pa.array(counts[1][used])],
            names=["bucket", "raw", "trusted"],
        )

    parts = judged.select("n", "codes", "trusted").mapInArrow(
        run, "bucket long, raw long, trusted long"
    )
    return parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted"))


def log_ratios(trusted: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """SCALE * log(trusted / raw) of each bucket, rounded to whole numbers."""
    a, size = SMOOTHING, len(raw)
    target = (trusted + a) / (trusted.sum() + a * size)
    corpus = (raw + a) / (raw.sum() + a * size)
    return np.rint(SCALE * np.log(target / corpus)).astype(np.int64)


def fit_ratios(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Log ratios by bucket. Without labelled good documents all are zero.

    At most 2 * BUCKETS rows reach the driver.
    """
    raw, trusted = np.zeros((2, 2 * BUCKETS), np.int64)
    rows = ngram_counts(docs, labels).toArrow()
    at = rows.column("bucket").to_numpy()
    raw[at], trusted[at] = rows.column("raw").to_numpy(), rows.column("trusted").to_numpy()
    return log_ratios(trusted if trusted.any() else raw, raw)


def verdicts(
    texts: list[str], table: WordHashes, ratios: np.ndarray
) -> dict[str, np.ndarray]:
    """The made columns of `score_quality` for some whole texts."""
    flat, bounds = flat_words(texts)
    hashes = table.array(flat)
    out = base_stats(texts, flat, bounds, hashes)
    one, two = ngram_buckets(hashes, bounds)
    paired = two >= 0
    out["base_failed"] = (out["n_words"] < MIN_WORDS) | (
        100 * out["n_repeat_words"] > MAX_REPEATED * out["n_words"]
    )
    out["llr_sum"] = sums(ratios[one] + np.where(paired, ratios[two], 0), bounds)
    out["n_ngrams"] = out["n_words"] + sums(paired, bounds)
    out["kept"] = ~out["base_failed"] & (out["llr_sum"] >= THRESHOLD * SCALE * out["n_ngrams"])
    return out


def score_quality(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """doc_id, STATS, `base_failed`, `llr_sum` (in 1 / SCALE), `n_ngrams` and `kept`.

    One row per row of `docs`, repeated rows included. Null and empty texts have
    no words and fail the base rules. Other columns of `docs` are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordHashes(4)
        for rows, texts in chunks(batches):
            made = verdicts(texts, table, shared.value)
            columns = [rows.column("doc_id"), *map(pa.array, made.values())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *made])

    source = docs.select("doc_id", "text")
    counts = ", ".join(f"{c} long" for c in STATS)
    return source.mapInArrow(
        run,
        f"{ddl([source.schema['doc_id']])}, {counts}, "
        "base_failed boolean, llr_sum long, n_ngrams long, kept boolean",
    )


def select_kept(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """The rows of `docs` that pass, with all their columns whatever their names."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordHashes(4)
        for rows, texts in chunks(batches):
            yield rows.filter(pa.array(verdicts(texts, table, shared.value)["kept"]))

    return docs.mapInArrow(run, docs.schema)
