"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

A seed is a pair of neighbouring words of a test item. It is looked up in the texts
among neighbouring words and among words with one other word between them. A copy
whose alignment scores MIN_SCORE holds a certain number of its item's seeds close
together, whatever words were changed, lost or added (see `seeds_needed`). So the
commonest seeds of an item can be left out, here half of that number, and a copy
still holds the rest of it: only rare seeds are searched, and nothing is lost. How
common a seed is, is counted in the texts that are searched at once.

Where enough seeds gather, the words of the passage and of the item are aligned
locally. The score is the alignment's share of the best possible one, so edits,
insertions and lost words lower it smoothly.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField

from webcorpus.llm.texts import WordHashes, chunks, flat_words, words_of
from webcorpus.session import ddl

#: Words from which an item can be edited; shorter ones must stand as they are.
SHORT = 4
#: Alignment: a matching word, another word, a word on one side only.
MATCH, MISMATCH, GAP = 2, -1, -1
#: Share of the best score from which a passage counts as a copy.
MIN_SCORE = 0.5
#: Words of test items that one scan of the texts looks for; more items, more scans.
SCAN_WORDS = 2_000_000
#: Cells of one batch of alignments.
CELLS = 4_000_000


class Items(NamedTuple):
    """Test items of one scan: ids, words as hashes, and their sorted seeds."""

    ids: list
    bounds: np.ndarray
    words: np.ndarray
    seed: np.ndarray  # sorted hashes of the word pairs
    item: np.ndarray  # item number of each
    at: np.ndarray  # its word position in the item
    short: dict[int, tuple[np.ndarray, np.ndarray]]  # by words: sorted hashes, item numbers


def seeds_needed(size: np.ndarray) -> np.ndarray:
    """Seeds that any copy of an item of `size` words holds, one at least from SHORT words.

    With s words changed or lost, i added and u cut off at the ends, a score of
    half the best means 3 s + 2 u + i <= size. Each of the s breaks two pairs of
    neighbours at most, each of the u one, and a pair is out of reach if two words
    were added between its words. That leaves size - 1 - 2 s - u - i / 2 pairs,
    which is least for s = size / 3.
    """
    return -((2 - size + size // 3) // 2)


def _mixed(words: np.ndarray, size: int, step: int = 1) -> np.ndarray:
    """Hash of every `size` words that are `step` apart."""
    n = max(0, len(words) - (size - 1) * step)
    out = np.zeros(n, np.uint64)
    for k in range(0, size * step, step):
        out = (out ^ words[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def pack_items(ids: list, texts: list[str]) -> Items:
    """Items with their seeds. An item without words has none."""
    flat, bounds = flat_words(texts)
    words = WordHashes(8).array(flat)
    size = np.diff(bounds)
    seed = _mixed(words, 2)
    item = np.repeat(np.arange(len(ids)), size)
    at = np.arange(len(words)) - bounds[:-1][item]
    inside = np.flatnonzero(item[: len(seed)] == item[1 : len(seed) + 1])
    inside = inside[size[item[inside]] >= SHORT]
    order = inside[np.argsort(seed[inside], kind="stable")]
    short = {}
    for n in range(1, SHORT):
        some = np.flatnonzero(size == n)
        if len(some):
            grams = _mixed(words, n)[bounds[:-1][some]]
            by = np.argsort(grams, kind="stable")
            short[n] = grams[by], some[by]
    return Items(ids, bounds, words, seed[order], item[order], at[order], short)


def sieve_of(seeds: np.ndarray) -> np.ndarray:
    """Which values the low bits of the seeds have; most n-grams have none of them."""
    size = 1 << min(26, max(16, int(len(seeds) * 16).bit_length()))
    sieve = np.zeros(size, bool)
    sieve[seeds & np.uint64(size - 1)] = True
    return sieve


def _hits(
    grams: np.ndarray, seeds: np.ndarray, sieve: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(place, row) for every place whose n-gram is among the sorted seeds."""
    some = np.flatnonzero(sieve[grams & np.uint64(len(sieve) - 1)])
    left = np.searchsorted(seeds, grams[some], "left")
    inside = np.flatnonzero(left < len(seeds))
    inside = inside[seeds[left[inside]] == grams[some[inside]]]
    found, left = some[inside], left[inside]
    many = np.searchsorted(seeds, grams[found], "right") - left
    place = np.repeat(found, many)
    row = np.repeat(left - (np.cumsum(many) - many), many) + np.arange(many.sum())
    return place, row


def smith_waterman(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local score of each row of `a` with that of `b`, and where it ends in `a`.

    Rows are word hashes, padded with 0 in `a` and 1 in `b`. One row of the
    table is computed at a time for all pairs; gaps along it are a running
    maximum, as their cost is linear.
    """
    pairs, width = b.shape
    ramp = np.arange(width + 1, dtype=np.int32) * GAP
    last = np.zeros((pairs, width + 1), np.int32)
    best = np.zeros(pairs, np.int32)
    end = np.zeros(pairs, np.int64)
    for i in range(a.shape[1]):
        row = np.zeros_like(last)
        step = np.where(b == a[:, i : i + 1], MATCH, MISMATCH)
        np.maximum(last[:, :-1] + step, last[:, 1:] + GAP, out=row[:, 1:])
        np.maximum(row, 0, out=row)
        # H[j] = max over k <= j of row[k] + GAP * (j - k)
        row = np.maximum.accumulate(row - ramp, axis=1) + ramp
        top = row.max(axis=1)
        better = top > best
        best[better], end[better] = top[better], i + 1
        last = row
    return best, end


def _owned(place: np.ndarray, width: int, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which places lie inside one text with `width` words from them on, their texts)."""
    owner = np.searchsorted(bounds, place, "right") - 1
    inside = np.flatnonzero(place + width <= bounds[owner + 1])
    return inside, owner[inside]


def _rare(items: Items, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(seeds to search, seeds an item's copy then holds), from the hits of some texts.

    Of each item the commonest seeds go, half as many as its copies hold.
    """
    need = seeds_needed(np.diff(items.bounds))
    hits = np.bincount(row, minlength=len(items.seed))
    order = np.lexsort((-hits, items.item))
    first = np.searchsorted(items.item[order], np.arange(len(items.ids)))
    rank = np.arange(len(order)) - first[items.item[order]]
    searched = np.zeros(len(order), bool)
    searched[order] = rank >= (need // 2)[items.item[order]]
    return searched, need - need // 2


def _passages(
    items: Items, words: np.ndarray, bounds: np.ndarray, sieve: np.ndarray
) -> np.ndarray:
    """(text, item, from, to) of the places where an item's rare seeds gather."""
    parts = []
    for step in (1, 2):
        place, row = _hits(_mixed(words, 2, step), items.seed, sieve)
        inside, owner = _owned(place, step + 1, bounds)
        parts.append((place[inside], row[inside], owner))
    place, row, owner = (np.concatenate(x) for x in zip(*parts))
    searched, need = _rare(items, row)
    kept = searched[row]
    place, row, owner = place[kept], row[kept], owner[kept]
    item, at = items.item[row], items.at[row]
    start = place - at  # where the item would begin if no word was added or lost
    order = np.lexsort((start, item, owner))
    owner, item, start = (x[order] for x in (owner, item, start))
    size, need = np.diff(items.bounds)[item], need[item]
    # In a copy the starts differ by as many words as were added and lost, the
    # item's size at most. A hit counts where the hits it needs are as close.
    k = np.arange(len(order))
    last = np.minimum(k + need - 1, len(order) - 1)
    dense = (
        (k + need - 1 < len(order))
        & (owner[last] == owner) & (item[last] == item) & (start[last] - start <= size)
    )
    cover = np.zeros(len(order) + 1, np.int64)
    np.add.at(cover, k[dense], 1)
    np.add.at(cover, last[dense] + 1, -1)
    kept = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
    if not len(kept):
        return np.zeros((0, 4), np.int64)
    owner, item, start, size = owner[kept], item[kept], start[kept], size[kept]
    new = np.ones(len(kept), bool)
    new[1:] = (
        (owner[1:] != owner[:-1]) | (item[1:] != item[:-1]) | (start[1:] - start[:-1] > size[1:])
    )
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(kept)) - 1
    begin = np.maximum(start[first] - size[first], bounds[owner[first]])
    stop = np.minimum(start[last] + 2 * size[first], bounds[owner[first] + 1])
    return np.stack([owner[first], item[first], begin, stop], axis=1)


def _exact(items: Items, words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(text, item, from, to) of the items that are too short to be edited."""
    out = [np.zeros((0, 4), np.int64)]
    for size, (grams, numbers) in items.short.items():
        place, row = _hits(_mixed(words, size), grams, sieve_of(grams))
        inside, owner = _owned(place, size, bounds)
        place = place[inside]
        out.append(np.stack([owner, numbers[row[inside]], place, place + size], axis=1))
    return np.concatenate(out)


def align(items: Items, words: np.ndarray, passages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(score, end) of each passage: the score's share of the best, its last word."""
    share, end = np.zeros(len(passages)), np.zeros(len(passages), np.int64)
    height = passages[:, 3] - passages[:, 2]
    width = np.diff(items.bounds)[passages[:, 1]]
    order = np.lexsort((height, width))
    k = 0
    while k < len(order):
        some = order[k : k + 1024]
        while len(some) > 1 and width[some].max() * height[some].max() * len(some) > CELLS:
            some = some[: len(some) // 2]
        a = np.zeros((len(some), height[some].max()), np.uint64)
        b = np.ones((len(some), width[some].max()), np.uint64)
        for j, p in enumerate(some):
            _, item, begin, stop = passages[p]
            a[j, : stop - begin] = words[begin:stop]
            b[j, : width[p]] = items.words[items.bounds[item] : items.bounds[item + 1]]
        best, last = smith_waterman(a, b)
        share[some] = best / (MATCH * width[some])
        end[some] = passages[some, 2] + last
        k += len(some)
    return share, end


def _leaks(
    texts: list[str], table: WordHashes, items: Items, sieve: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, item, from, to) of the copies in some texts, their scores, ends, and bounds."""
    flat, bounds = flat_words(texts)
    words = table.array(flat)
    found = _passages(items, words, bounds, sieve)
    score, end = align(items, words, found)
    good = score >= MIN_SCORE
    whole = _exact(items, words, bounds)
    return (
        np.concatenate([found[good], whole]),
        np.concatenate([score[good], np.ones(len(whole))]),
        np.concatenate([end[good], whole[:, 3]]),
        bounds,
    )


def _scan(docs: DataFrame, items: Items, item_field: StructField) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)
    doc_field = docs.schema["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, wanted = WordHashes(8), shared.value
        sieve = sieve_of(wanted.seed)
        for rows, texts in chunks(batches):
            found, score, end, bounds = _leaks(texts, table, wanted, sieve)
            base = bounds[found[:, 0]]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id").take(pa.array(found[:, 0])),
                    pa.array([wanted.ids[k] for k in found[:, 1]], item_arrow),
                    pa.array(score),
                    pa.array(found[:, 2] - base),
                    pa.array(end - base),
                ],
                names=["doc_id", "item_id", "score", "word_from", "word_to"],
            )

    item_arrow = to_arrow_type(item_field.dataType)
    return docs.select("doc_id", "text").mapInArrow(
        run, f"{ddl([doc_field, item_field])}, score double, word_from long, word_to long"
    )


def _scans(benchmark: DataFrame) -> Iterator[Items]:
    """Items in lots of about SCAN_WORDS words, streamed from the table."""
    ids, texts, words = [], [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        size = len(words_of(row["text"] or ""))
        if not size:
            continue
        ids.append(row["item_id"])
        texts.append(row["text"])
        words += size
        if words >= SCAN_WORDS:
            yield pack_items(ids, texts)
            ids, texts, words = [], [], 0
    if ids:
        yield pack_items(ids, texts)


def select_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` whose text holds no copy of an item, with all their columns.

    A text is judged where it is read, so no text moves between tasks.
    """
    for items in _scans(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            table, wanted = WordHashes(8), shared.value
            sieve = sieve_of(wanted.seed)
            for rows, texts in chunks(batches):
                clean = np.ones(len(texts), bool)
                clean[_leaks(texts, table, wanted, sieve)[0][:, 0]] = False
                yield rows.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, word_from, word_to): the copies of items in texts.

    One row for a document and item, with the best score; of equal ones the
    first place. Only lots of at most SCAN_WORDS words of items are broadcast; a
    larger benchmark takes several scans. Null and empty texts hold nothing, and
    null and empty items are nowhere. An item of fewer than SHORT words is held by
    a text that has these words in a row, and no edits. Item ids may be of any
    type. Repeated rows are the same document. Other columns are not
    read. Empty tables give an empty result.
    """
    item_field = benchmark.schema["item_id"]
    out = None
    for items in _scans(benchmark):
        part = _scan(docs, items, item_field)
        out = part if out is None else out.unionAll(part)
    if out is None:
        empty = pack_items([], [])
        return _scan(docs.limit(0), empty, item_field)
    place = (-F.col("word_from")).alias("early")
    best = F.max(F.struct("score", place, "word_to")).alias("best")
    return out.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id",
        "item_id",
        F.col("best.score").alias("score"),
        (-F.col("best.early")).alias("word_from"),
        F.col("best.word_to").alias("word_to"),
    )
