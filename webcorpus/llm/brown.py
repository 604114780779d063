"""Language-model scores from Brown classes of words.

Every training word gets one of a few classes. The probability of a word is that
of its class after the class before it, times its share of the class; unseen
words share the mass that words seen once have, as Good and Turing estimate it.

- The texts are read once, into blocks of word numbers (see `blocks`).
- The counts of all training words are one aggregate over the blocks' lists.
- Exchange clustering moves the TOP most frequent words between classes. Their
  pair counts are one row per word; each turn is a scan of these rows against the
  class map and the class matrix, both of fixed size. The gain of a move is exact;
  a turn moves every EVERY-th word, and only moves that raise the likelihood stay.
- Every other word, however rare, takes the class that the classes of the top
  words beside it speak for. Words that never stand beside one are a class of
  their own.
- Classes and counts of all words go back to the blocks, where the transitions of
  all training text are counted and every text is scored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcorpus.llm.blocks import (
    by_frequency,
    id_type,
    listed,
    looked_up,
    packed,
    sliced,
    stored,
    unpacked,
)
from webcorpus.llm.rules import held_out
from webcorpus.llm.texts import chunks
from webcorpus.session import materialize

#: Classes that words are exchanged between, and words that are exchanged.
CLASSES, TOP = 64, 16_384
#: Turns of the exchange; a turn may move every EVERY-th word.
TURNS, EVERY = 9, 3
#: Weight of the classes' own shares in the transitions after each class.
ALPHA = 64.0
#: Tokens from which a block is closed.
BLOCK_TOKENS = 1_500_000
#: Distinct pairs that a task holds before it sends their counts.
PAIRS = 1_500_000
#: Folds of the documents, and the one that is never learnt from.
FOLDS, HELD = 7, 2

_words = re.compile(rb"[^ \t-\r]+").findall
#: The end of a text; no word holds a line break.
_END = b"\n"


def word_number(word: bytes) -> int:
    """64 bits of a word's MD5, as a signed number."""
    return int.from_bytes(hashlib.md5(word).digest()[:8], "big", signed=True)


END = word_number(_END)


class Numbers(dict):
    """word -> its number, remembered up to a bound."""

    def __init__(self, limit: int = 150_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = word_number(word)
        return value


def tokens(texts: list[str], table: Numbers) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all texts, an end after each, and the number of tokens of each."""
    flat: list[bytes] = []
    sizes = np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        own = _words(text.encode("utf-8", "surrogatepass").lower())
        flat += own
        flat.append(_END)
        sizes[k] = len(own) + 1
    return np.fromiter(map(table.__getitem__, flat), np.int64, len(flat)), sizes


def encode(docs: DataFrame, held: Column, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks (docs, held, sizes, codes, words, train) of whole documents.

    `codes` numbers the block's `words`; `train` counts them in the documents that
    are learnt from. A document is in one block whatever its length.
    """

    def block(parts: list[tuple]) -> pa.RecordBatch:
        ids, helds, flats, sizes = zip(*parts)
        held, sizes = np.concatenate(helds), np.concatenate(sizes)
        words, codes = by_frequency(np.concatenate(flats))
        train = np.bincount(codes[~np.repeat(held, sizes)], minlength=len(words))
        ids = pa.concat_arrays(ids)
        whole = [pa.array([0, len(ids)], pa.int32())]
        return pa.RecordBatch.from_arrays(
            [
                pa.ListArray.from_arrays(*whole, ids),
                pa.array([held.tolist()]),
                pa.array([sizes.tolist()], pa.list_(pa.int64())),
                pa.array([packed(codes)], pa.binary()),
                pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pa.array(words)),
                pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pa.array(train)),
            ],
            names=["docs", "held", "sizes", "codes", "words", "train"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, parts, size = Numbers(), [], 0
        for rows, texts in chunks(batches, 500_000):
            flat, sizes = tokens(texts, table)
            mine = rows.column("_held").to_numpy(zero_copy_only=False)
            parts.append((rows.column("doc_id"), mine, flat, sizes))
            size += len(flat)
            if size >= block_tokens:
                yield block(parts)
                parts, size = [], 0
        if parts:
            yield block(parts)

    source = docs.select("doc_id", "text", held.alias("_held"))
    schema = (
        f"docs array<{id_type(docs)}>, held array<boolean>, sizes array<long>, "
        "codes binary, words array<long>, train array<long>"
    )
    return source.mapInArrow(run, schema)


def _numpy(batch, name: str, k: int) -> np.ndarray:
    """A list of numbers of row `k`."""
    return batch.column(name)[k].values.to_numpy(zero_copy_only=False)


def _opened(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of a block, and which of its tokens are learnt from."""
    sizes = _numpy(batch, "sizes", k)
    codes = unpacked(batch.column("codes")[k].as_py(), int(sizes.sum()))
    return codes, ~np.repeat(_numpy(batch, "held", k), sizes)


def _before(values: np.ndarray, first) -> np.ndarray:
    """Each token's predecessor. An end stands before every text, also the first."""
    return np.concatenate([np.array([first], values.dtype), values[:-1]])


# -- exchange clustering of the top words --------------------------------------------


class Top:
    """The most frequent words, by number; the end is always one of them."""

    def __init__(self, words: DataFrame, top: int):
        rows = words.orderBy(F.desc("n"), "h").limit(top).toArrow()
        numbers = rows.column("h").to_numpy()
        if END not in numbers:
            numbers = np.append(numbers[: top - 1], END)
        self.rank = np.argsort(numbers, kind="stable")
        self.sorted = numbers[self.rank]
        self.numbers = numbers
        self.end = int(np.flatnonzero(numbers == END)[0])

    def ids(self, words: np.ndarray) -> np.ndarray:
        """Place by frequency of each word, -1 for the others."""
        at = np.minimum(np.searchsorted(self.sorted, words), len(self.sorted) - 1)
        return np.where(self.sorted[at] == words, self.rank[at], -1)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their counts."""
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    counts = np.bincount(at.reshape(-1), np.concatenate([n for _, n in parts]), len(keys))
    return keys, counts.astype(np.int64)


def _lists(w: np.ndarray, at: np.ndarray, n: np.ndarray, rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """(w, at, n): one row of lists per word, from entries sorted by word."""
    starts = np.flatnonzero(np.diff(w, prepend=-1))
    bounds = pa.array(np.append(starts, len(w)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(bounds, pa.array(x)) for x in (at, n)]
    batch = pa.RecordBatch.from_arrays([pa.array(w[starts]), *lists], names=["w", "at", "n"])
    for k in range(0, len(starts), rows):
        yield batch.slice(k, rows)


def top_pairs(blocks: DataFrame, top: Top) -> DataFrame:
    """(w, beside): the neighbours of each top word among the top words, one row per word.

    `beside` lists (at, n): 2 k for word k after it, 2 k + 1 for word k before it. A
    list holds at most two entries per top word.
    """
    shared = blocks.sparkSession.sparkContext.broadcast(top)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top, parts, held = shared.value, [], 0
        size = len(top.numbers)

        def given() -> Iterator[pa.RecordBatch]:
            pairs, n = _merged(parts)
            left, right = (pairs // size).astype(np.int32), (pairs % size).astype(np.int32)
            yield from _lists(left, 2 * right, n)
            order = np.argsort(right, kind="stable")
            yield from _lists(right[order], 2 * left[order] + 1, n[order])

        for batch in batches:
            for k in range(batch.num_rows):
                codes, learnt = _opened(batch, k)
                ids = top.ids(_numpy(batch, "words", k))[codes]
                left = _before(ids, top.end)
                some = learnt & (ids >= 0) & (left >= 0)
                parts.append(np.unique(left[some] * size + ids[some], return_counts=True))
                held += len(parts[-1][0])
                if held > PAIRS:
                    yield from given()
                    parts, held = [], 0
        if held:
            yield from given()

    source = blocks.select("sizes", "held", "codes", "words")
    # One exchange for the sums and the lists. A word's neighbours of one task move as
    # one row, which takes about half the room of a row for each.
    lists = (
        source.mapInArrow(run, "w int, at array<int>, n array<long>")
        .repartition("w").select("w", F.inline(F.arrays_zip("at", "n")))
        .groupBy("w", "at").agg(F.sum("n").alias("n"))
        .groupBy("w").agg(F.collect_list(F.struct("at", "n")).alias("beside"))
    )
    return materialize(lists, "pairs")


def _phi(x: np.ndarray) -> np.ndarray:
    """x log x, 0 at 0."""
    return x * np.log(np.maximum(x, 1.0))


def likelihood(matrix: np.ndarray) -> float:
    """What the classes contribute to the log likelihood of the training text."""
    return float(_phi(matrix).sum() - _phi(matrix.sum(1)).sum() - _phi(matrix.sum(0)).sum())


def move_gains(matrix: np.ndarray, own: int, after: np.ndarray, before: np.ndarray, self_: float) -> np.ndarray:
    """Change of the likelihood when a word of class `own` goes to each of the classes.

    `after` and `before` count its neighbours by class, `self_` its pairs with itself.
    """
    rest = matrix.copy()
    rest[own] -= after
    rest[:, own] -= before
    rest[own, own] += self_
    after, before = after.copy(), before.copy()
    after[own] -= self_
    before[own] -= self_
    plain = _phi(rest)
    gain = (_phi(rest + after) - plain).sum(1) + (_phi(rest + before[:, None]) - plain).sum(0)
    corner, a, b = np.diag(rest), after, before
    gain += _phi(corner + a + b + self_) - _phi(corner + a) - _phi(corner + b) + _phi(corner)
    row, column = rest.sum(1) + before, rest.sum(0) + after
    gain -= _phi(row + after.sum() + self_) - _phi(row)
    gain -= _phi(column + before.sum() + self_) - _phi(column)
    return gain - gain[own]


def _by_class(batch, k: int, classes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, float]:
    """What follows and precedes the word of row `k`, by class, and its pairs with itself."""
    beside = batch.column("beside")[k].values
    at, n = (beside.field(c).to_numpy() for c in ("at", "n"))
    cell = classes[at >> 1] * 2 + (at & 1)
    counts = np.bincount(cell, n, 2 * size).reshape(size, 2)
    return counts[:, 0], counts[:, 1], float(n[at == 2 * batch.column("w")[k].as_py()].sum())


def _class_matrix(pairs: DataFrame, classes: np.ndarray, size: int) -> np.ndarray:
    """Class pair counts under a class map. Every task sends its sums as one row.

    The pairs are at most TOP rows of bounded lists, so their tasks are few.
    """
    shared = pairs.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            for k, word in enumerate(batch.column("w").to_pylist()):
                total[shared.value[word]] += _by_class(batch, k, shared.value, size)[0]
        yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tobytes()], pa.binary())})

    rows = pairs.mapInArrow(run, "sums binary").toArrow().column("sums").to_pylist()
    parts = [np.frombuffer(row).reshape(size, size) for row in rows]
    return sum(parts, np.zeros((size, size)))


def _matrix(cells: DataFrame, height: int, width: int) -> np.ndarray:
    rows = cells.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(height * width)
    out[rows.column("cell").to_numpy()] = rows.column("n").to_numpy()
    return out.reshape(height, width)


def _proposals(
    pairs: DataFrame, classes: np.ndarray, matrix: np.ndarray, turn: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, classes, gains) of this turn's words that would gain by a move, best first."""
    shared = pairs.sparkSession.sparkContext.broadcast((classes, matrix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, matrix = shared.value
        for batch in batches:
            out = []
            for k, word in enumerate(batch.column("w").to_pylist()):
                beside = _by_class(batch, k, classes, len(matrix))
                gain = move_gains(matrix, int(classes[word]), *beside)
                best = int(np.argmax(gain))
                if gain[best] > 1e-6:
                    out.append((word, best, float(gain[best])))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in zip(*out)], names=["w", "class", "gain"]
                )

    some = pairs.filter(F.col("w") % EVERY == turn % EVERY)
    rows = some.mapInArrow(run, "w long, class long, gain double").toArrow()
    word, best, gain = (rows.column(c).to_numpy() for c in ("w", "class", "gain"))
    order = np.lexsort((word, -np.round(gain, 6)))
    return word[order], best[order], gain[order]


def exchange(pairs: DataFrame, n_words: int, size: int = CLASSES, turns: int = TURNS) -> tuple[np.ndarray, np.ndarray]:
    """(class of each top word, class pair counts) after some turns.

    Words start in turn by frequency. When the moves of a turn together do not
    raise the likelihood, the better half of them is tried, and so on.
    """
    classes = np.arange(n_words) % size
    matrix = _class_matrix(pairs, classes, size)
    value = likelihood(matrix)
    for turn in range(turns):
        words, best, _ = _proposals(pairs, classes, matrix, turn)
        while len(words):
            tried = classes.copy()
            tried[words] = best
            moved = _class_matrix(pairs, tried, size)
            if likelihood(moved) > value:
                classes, matrix, value = tried, moved, likelihood(moved)
                break
            words, best = words[: len(words) // 2], best[: len(best) // 2]
    return classes, matrix


# -- the other words ------------------------------------------------------------------


def rest_classes(blocks: DataFrame, top: Top, classes: np.ndarray, matrix: np.ndarray) -> DataFrame:
    """(h, class) of the words beside top words that are not top words themselves.

    A word's neighbours are summed by the classes to its left and right, at most
    (CLASSES + 1)^2 rows for a word, which Spark sums before they meet.
    """
    size = len(matrix)
    none, wide = size, size + 1
    shared = blocks.sparkSession.sparkContext.broadcast((top, np.append(classes, none)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top, classes = shared.value
        for batch in batches:
            for k in range(batch.num_rows):
                codes, learnt = _opened(batch, k)
                words = _numpy(batch, "words", k)
                ids = top.ids(words)
                own = classes[ids][codes]
                left = _before(own, classes[top.end])
                right = np.append(own[1:], none)
                some = learnt & (ids[codes] < 0) & ((left < none) | (right < none))
                key = (codes[some] * wide + left[some]) * wide + right[some]
                key, n = np.unique(key, return_counts=True)
                beside = (key % wide**2).astype(np.int32)
                yield from sliced(["h", "beside", "n"], words[key // wide**2], beside, n)

    row, column = matrix.sum(1), matrix.sum(0)
    smooth = matrix + 0.5
    after_log = np.vstack([(np.log(smooth) - np.log(row + 0.5 * size)[:, None]).T, np.zeros(size)])
    before_log = np.vstack([np.log(smooth) - np.log(column + 0.5 * size), np.zeros(size)])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("l")
            n = np.diff(lists.offsets.to_numpy())
            owner = np.repeat(np.arange(batch.num_rows), n)
            flat = lists.flatten()
            beside, count = (flat.field(c).to_numpy() for c in ("beside", "n"))
            score = np.zeros((batch.num_rows, size))
            for side, logs in ((beside // wide, before_log), (beside % wide, after_log)):
                counts = np.bincount(owner * wide + side, count, batch.num_rows * wide)
                score += counts.reshape(-1, wide) @ logs
            best = np.argmax(np.round(score, 6), axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("h"), pa.array(best)], names=["h", "class"])

    source = blocks.select("sizes", "held", "codes", "words")
    beside = source.mapInArrow(count, "h long, beside int, n long")
    lists = (
        beside.repartition("h").groupBy("h", "beside").agg(F.sum("n").alias("n"))
        .groupBy("h").agg(F.collect_list(F.struct("beside", "n")).alias("l"))
    )
    return lists.mapInArrow(choose, "h long, class long")


# -- scores ---------------------------------------------------------------------------


def _valued(
    left: pa.Table, right: pa.Table, n_tokens: int, n_words: int, none: int, log_sizes: np.ndarray
) -> pa.Table:
    """A block's documents with the classes of their tokens and what needs no neighbour."""
    block = left.combine_chunks().to_batches()[0]
    sizes = _numpy(block, "sizes", 0)
    codes = unpacked(block.column("codes")[0].as_py(), int(sizes.sum()))
    width = int(codes.max()) + 1
    count, class_ = np.zeros(width), np.full(width, none)
    at = right.column("at").to_numpy()
    count[at], class_[at] = right.column("n").to_numpy(), right.column("class").to_numpy()
    base = np.log10((count + 1) / (n_tokens + n_words + 1))
    share = np.where(count > 0, np.log10(np.maximum(count, 1)) - np.append(log_sizes, 0)[class_], 0)
    starts = np.cumsum(sizes) - sizes

    def summed(values: np.ndarray) -> pa.Array:
        return pa.array([np.add.reduceat(values[codes], starts)])

    return pa.Table.from_arrays(
        [
            block.column("docs"),
            block.column("held"),
            block.column("sizes"),
            pa.array([packed(class_[codes])], pa.binary()),
            summed((count > 0).astype(np.int64)),
            summed(base),
            summed(share),
        ],
        names=["docs", "held", "sizes", "codes", "known", "base", "share"],
    )


def transitions(valued: DataFrame, end_class: int, size: int) -> np.ndarray:
    """Class pair counts of all training text; size^2 rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for batch in batches:
            for k in range(batch.num_rows):
                codes, learnt = _opened(batch, k)
                pair = _before(codes, end_class) * size + codes
                total += np.bincount(pair[learnt], minlength=size * size)
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total[cell])], names=["cell", "n"])

    rows = valued.select("sizes", "held", "codes").mapInArrow(run, "cell long, n long")
    return _matrix(rows, size, size)


def transition_logs(counts: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """log10 P(class | class before), the classes' own shares after an unknown word."""
    size = len(counts)
    out = (counts + ALPHA * shares) / (counts.sum(1, keepdims=True) + ALPHA)
    out = np.vstack([out, shares[None]])
    logs = np.zeros((size + 1, size + 1))
    logs[:, :size] = np.log10(np.where(out > 0, out, 1))
    return logs


def score_texts(
    docs: DataFrame,
    held: Column | None = None,
    classes: int = CLASSES,
    top: int = TOP,
    turns: int = TURNS,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity).

    One row per row of `docs`. `held` tells the documents that are not learnt
    from; by default fold HELD of FOLDS by doc_id, null ids being learnt from. A
    null, empty or blank text is one end token. Words are lower-cased in A-Z only
    and told apart by 64 bits of a hash. Repeated rows are learnt from and scored
    each. With nothing to learn from every token is unknown and has probability
    1/2. An empty table gives no row; other columns are not read.
    """
    spark = docs.sparkSession
    held = held_out(F.col("doc_id"), FOLDS, HELD) if held is None else held
    blocks = stored(encode(docs, held, block_tokens), "blocks")
    words = materialize(
        listed(blocks, "words", "train").filter("train > 0")
        .groupBy(F.col("words").alias("h")).agg(F.sum("train").alias("n")),
        "words",
    )
    found = words.agg(F.sum("n"), F.count("*"), F.count_if(F.col("n") == 1)).first()
    n_tokens, n_words, n_once = (int(x or 0) for x in found)
    most = Top(words, min(top, max(n_words, 1)))
    pairs = top_pairs(blocks, most)
    class_of, matrix = exchange(pairs, len(most.numbers), classes, turns)
    ids = pa.table({"h": most.numbers, "class": class_of.astype(np.int64)})
    chosen = spark.createDataFrame(ids).unionAll(rest_classes(blocks, most, class_of, matrix))
    # Words that stand beside no top word are the class after the last.
    size = classes + 1
    table = materialize(
        words.join(chosen, "h", "left").withColumn("class", F.coalesce("class", F.lit(classes))),
        "classes",
    )
    sizes = _matrix(table.select(F.col("class").alias("cell"), "n"), 1, size)[0]
    value = partial(
        _valued, n_tokens=n_tokens, n_words=n_words, none=size,
        log_sizes=np.log10(np.maximum(sizes, 1)),
    )
    ids = id_type(docs)
    valued = materialize(
        looked_up(
            blocks.drop("train"), "words", table, "h", value,
            f"docs array<{ids}>, held array<boolean>, sizes array<long>, codes binary, "
            "known array<long>, base array<double>, share array<double>",
        ),
        "valued",
    )
    end_class = int(class_of[most.end])
    counts = transitions(valued, end_class, size)
    logs = transition_logs(counts, sizes / max(n_tokens, 1))
    # Good-Turing: unseen words come as often as words seen once.
    unseen = (n_once + 1) / (n_tokens + n_once + 2)
    return _scored(valued, logs, end_class, unseen, n_tokens, ids)


def _scored(
    valued: DataFrame, logs: np.ndarray, end_class: int, unseen: float, n_tokens: int, ids: str
) -> DataFrame:
    shared = valued.sparkSession.sparkContext.broadcast(logs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = shared.value
        for batch in batches:
            for k in range(batch.num_rows):
                sizes = _numpy(batch, "sizes", k)
                codes, _ = _opened(batch, k)
                starts = np.cumsum(sizes) - sizes
                steps = np.add.reduceat(logs[_before(codes, end_class), codes], starts)
                known = _numpy(batch, "known", k)
                score = (
                    steps + _numpy(batch, "share", k)
                    + known * np.log10(1 - unseen) + (sizes - known) * np.log10(unseen)
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("docs")[k].values,
                        batch.column("held")[k].values,
                        pa.array(sizes),
                        pa.array(known),
                        pa.array(np.full(len(sizes), n_tokens)),
                        batch.column("base")[k].values,
                        pa.array(score),
                        pa.array(np.power(10.0, -score / sizes)),
                    ],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens",
                           "base_score", "score", "perplexity"],
                )

    return valued.mapInArrow(
        run,
        f"doc_id {ids}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double, perplexity double",
    )
