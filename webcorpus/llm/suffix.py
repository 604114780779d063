"""Exact substring de-duplication with the interval tree of a suffix array.

Every byte that lies in a string of LENGTH bytes which also starts earlier (in a
smaller doc_id, or further to the left in the same text) is removed. A text is
told from others by doc_id and `key`, a hash of the text.

A window of LENGTH bytes is owned by one anchor: its leftmost substring of
ANCHOR bytes with the smallest hash. Equal windows have equal anchors at the
same place, so repeats need only be searched among the occurrences of one
anchor. An occurrence is the stretch of text that its windows cover.

1. One pass writes (anchor hash, stretch hash, doc_id, key, place) of all occurrences;
   equal stretches of one task are reduced to the first before anything moves.
2. Sorted by anchor and stretch: of equal stretches all but the first are
   removed; anchors with several different stretches go on.
3. The bytes of those stretches are fetched and all suffixes that begin in an
   owned window are sorted. A stack scan over the common prefixes of neighbours
   gives the tree of intervals; an interval of at least LENGTH bytes whose
   occurrences are preceded by different bytes is a maximal repeat, with all its
   occurrences. All but the first are removed.
4. The removed intervals of a text are merged and the text is cut.

An anchor with very many stretches is split into single windows, dealt by their
content, so it is searched by many tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.llm.groups import bounds_of, together, whole_groups
from webcorpus.llm.texts import chunks
from webcorpus.session import ddl, materialize

LENGTH, ANCHOR = 100, 24
#: Anchors that a window looks at.
_SPAN = LENGTH - ANCHOR + 1
#: Different stretches of an anchor from which it is split into single windows.
HOT = 4_096
#: Texts whose equal stretches are reduced together, in bytes.
LOCAL_BYTES = 32 << 20

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _B
    return x ^ (x >> np.uint64(29))


class Hasher:
    """Polynomial hashes modulo 2^64 of substrings of one byte string."""

    def __init__(self, data: np.ndarray):
        # sum of h(byte) * A^k, so that a substring's hash is a difference, scaled.
        n = len(data)
        self.power = _powers(n + 1)
        salted = _mix(data.astype(np.uint64) + np.uint64(1))
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(salted * self.power[:n], out=self.total[1:])
        self.inverse = _powers(n + 1, back=True)

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return _mix((self.total[stop] - self.total[start]) * self.inverse[start])


_POWERS: dict[bool, np.ndarray] = {}


def _powers(n: int, back: bool = False) -> np.ndarray:
    """Powers of A (or of its inverse) modulo 2^64, remembered and doubled at need."""
    base = int(_A) if not back else pow(int(_A), -1, 1 << 64)
    known = _POWERS.get(back)
    if known is None:
        known = np.array([1], np.uint64)
    while len(known) < n:
        known = np.concatenate([known, known * np.uint64(pow(base, len(known), 1 << 64))])
    _POWERS[back] = known
    return known[:n]


def owners(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, stretch hash, first window, number of windows) of a text's anchors."""
    n = len(data)
    if n < LENGTH:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none
    hasher = Hasher(data)
    at = np.arange(n - ANCHOR + 1)
    grams = hasher.of(at, at + ANCHOR)
    # Sliding minimum with its place in the low bits, so that the leftmost wins. A
    # window lies in two blocks: it has the end of one and the start of the next.
    size = _SPAN
    padded = np.full(-(-len(grams) // size) * size, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(grams)] = grams
    blocks = padded.reshape(-1, size) & ~np.uint64(127) | np.arange(size, dtype=np.uint64)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - LENGTH + 1
    left, right = behind[:windows], ahead[size - 1 : size - 1 + windows]
    from_left = left >> np.uint64(7) <= right >> np.uint64(7)
    low = np.where(from_left, left, right)
    begin = np.arange(windows)
    block = np.where(from_left, begin, begin + size - 1) // size
    place = block * size + (low & np.uint64(127)).astype(np.int64)
    # No window is equal to another that has the same anchor at the same place.
    cuts = bounds_of([place])
    first, stop = cuts[:-1], cuts[1:]
    return low[first] >> np.uint64(7), hasher.of(first, stop - 1 + LENGTH), first, stop - first


def _text_bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)


def occurrences(docs: DataFrame) -> DataFrame:
    """(anchor, stretch, doc_id, key, first, windows, known): the anchors of all texts.

    `known` marks stretches whose equal came earlier in the same task: they are
    removed whatever comes from elsewhere, so they get random anchors and are
    dealt evenly. Only one of a task's equal stretches meets those of others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for rows, texts in chunks(batches):
            ids, keys = (rows.column(c).to_numpy() for c in ("doc_id", "key"))
            for doc_id, key, text in zip(ids, keys, texts):
                data = _text_bytes(text)
                anchor, stretch, first, windows = owners(data)
                if len(anchor):
                    doc, own = (np.full(len(anchor), x) for x in (doc_id, key))
                    held.append((anchor, stretch, doc, own, first, windows))
                    size += len(data)
            if size >= LOCAL_BYTES:
                yield _reduced(held)
                held, size = [], 0
        if held:
            yield _reduced(held)

    return docs.select("doc_id", "key", "text").mapInArrow(
        run,
        "anchor long, stretch long, doc_id long, key long, first long, windows long, known boolean",
    )


def _reduced(held: list[tuple]) -> pa.RecordBatch:
    anchor, stretch, doc, key, first, windows = (np.concatenate(x) for x in zip(*held))
    order = np.lexsort((first, key, doc, stretch, anchor))
    anchor, stretch, doc, key, first, windows = (
        x[order] for x in (anchor, stretch, doc, key, first, windows)
    )
    later, again = _later(anchor, stretch, doc, key, first)
    place = _mix(_mix(doc.view(np.uint64)) + key.view(np.uint64)) + first.view(np.uint64)
    anchor = np.where(later, _mix(place), anchor)
    anchor, stretch, doc, key, first, windows, known = (
        x[~again] for x in (anchor, stretch, doc, key, first, windows, later)
    )
    names = ["anchor", "stretch", "doc_id", "key", "first", "windows", "known"]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(anchor.view(np.int64)),
            pa.array(stretch.view(np.int64)),
            pa.array(doc),
            pa.array(key),
            pa.array(first),
            pa.array(windows),
            pa.array(known),
        ],
        names=names,
    )


def _later(anchor, stretch, doc, key, first) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted occurrences: those after the first equal one, and repeated rows of it."""
    starts = bounds_of([anchor, stretch])[:-1]
    head = np.repeat(starts, np.diff(np.append(starts, len(anchor))))
    same_place = (doc == doc[head]) & (key == key[head]) & (first == first[head])
    at_head = np.zeros(len(anchor), bool)
    at_head[starts] = True
    return ~same_place, same_place & ~at_head


def _sorted_out(found: DataFrame) -> DataFrame:
    """(doc_id, key, first, windows, anchor, hot, removed), from the occurrences.

    Stretches that are not the first of their kind are `removed`; the others are
    given where their anchor has several stretches, and `hot` where very many.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _ in whole_groups(batches, ("anchor",)):
            column = {c: rows.column(c).to_numpy() for c in rows.column_names}
            known = column.pop("known")
            names = ("doc_id", "key", "first", "windows", "anchor")
            spread = [column[c][known] for c in names]
            column = {c: v[~known] for c, v in column.items()}
            sort = [column[c] for c in ("anchor", "stretch", "doc_id", "key", "first")]
            later, again = _later(*sort) if len(sort[0]) else (np.zeros(0, bool),) * 2
            new = np.zeros(len(later), bool)
            new[bounds_of(sort[:2])[:-1]] = True
            bounds = bounds_of(sort[:1])
            kinds = np.add.reduceat(new, bounds[:-1]) if len(new) else np.zeros(0, np.int64)
            kinds = np.repeat(kinds, np.diff(bounds))
            give = np.flatnonzero((later | (kinds > 1)) & ~again)
            out = [np.concatenate([x, column[c][give]]) for x, c in zip(spread, names)]
            hot = np.concatenate([np.zeros(known.sum(), bool), kinds[give] >= HOT])
            removed = np.concatenate([np.ones(known.sum(), bool), later[give]])
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, out), pa.array(hot), pa.array(removed)],
                names=[*names, "hot", "removed"],
            )

    sorted_ = together(found, "anchor", order=("stretch", "doc_id", "key", "first"))
    return sorted_.mapInArrow(
        run,
        "doc_id long, key long, first long, windows long, anchor long, hot boolean, removed boolean",
    )


def _stretches(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(part, doc_id, key, first, windows, bytes) of the wanted stretches."""
    lists = wanted.groupBy(F.col("doc_id").alias("_doc"), F.col("key").alias("_key")).agg(
        F.collect_list(F.struct("first", "windows", "anchor", "hot")).alias("wanted")
    )
    same = (F.col("doc_id") == F.col("_doc")) & (F.col("key") == F.col("_key"))
    joined = docs.select("doc_id", "key", "text").join(lists, same)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in chunks(batches):
            out = []
            ids, keys, wanted = (rows.column(c).to_pylist() for c in ("doc_id", "key", "wanted"))
            for doc_id, key, text, places in zip(ids, keys, texts, wanted):
                data = text.encode("utf-8", "surrogatepass")
                for place in places:
                    first, windows, part = place["first"], place["windows"], place["anchor"]
                    if not place["hot"]:
                        cut = data[first : first + windows - 1 + LENGTH]
                        out.append((part, doc_id, key, first, windows, cut))
                        continue
                    for k in range(first, first + windows):
                        cut = data[k : k + LENGTH]
                        own = hashlib.blake2b(cut, digest_size=8).digest()
                        part = int.from_bytes(own, "big", signed=True)
                        out.append((part, doc_id, key, k, 1, cut))
            if out:
                part, doc, key, first, windows, cut = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(x, pa.int64()) for x in (part, doc, key, first, windows)],
                     pa.array(cut, pa.binary())],
                    names=["part", "doc_id", "key", "first", "windows", "bytes"],
                )

    return joined.mapInArrow(
        run, "part long, doc_id long, key long, first long, windows long, bytes binary"
    )


def suffix_array(stretches: list[bytes], windows: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted suffixes that begin in an owned window: (stretch, offset, common prefix).

    The last says how many bytes a suffix shares with the one before it, up to
    the end of the shorter, and is 0 below LENGTH.
    """
    sizes = np.fromiter(map(len, stretches), np.int64, len(stretches))
    starts = np.cumsum(sizes) - sizes
    text = np.frombuffer(b"".join(stretches) + bytes(LENGTH + 8), np.uint8)
    owner = np.repeat(np.arange(len(stretches)), windows)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    place = starts[owner] + offset
    ends = (starts + sizes)[owner]
    # Eight bytes at every place as one number.
    wide = np.zeros(len(text) - 7, np.uint64)
    for k in range(8):
        wide = (wide << np.uint64(8)) | text[k : len(text) - 7 + k]
    order = np.argsort(wide[place], kind="stable")
    rank = np.cumsum(np.append(True, np.diff(wide[place][order]) != 0)) - 1
    # Most suffixes differ early: only those still tied are sorted further, up to
    # the end of their stretches, after which bytes count as 0.
    near = rank
    for at in range(8, int(sizes.max()), 8):
        if at == LENGTH - LENGTH % 8:
            near = rank
        tied = np.zeros(len(order), bool)
        equal = rank[1:] == rank[:-1]
        tied[1:] |= equal
        tied[:-1] |= equal
        rows = np.flatnonzero(tied)
        if not len(rows):
            near = rank if at < LENGTH - LENGTH % 8 else near
            break
        some = order[rows]
        lost = np.clip(place[some] + at + 8 - ends[some], 0, 8).astype(np.uint64)
        value = wide[np.minimum(place[some] + at, len(wide) - 1)]
        cut = (value >> np.minimum(lost * np.uint64(8), np.uint64(63))) << lost * np.uint64(8)
        value = np.where(lost < 8, cut, np.uint64(0))
        again = np.lexsort((value, rank[rows]))
        order[rows] = some[again]
        value = value[again]
        new = np.append(True, rank[1:] != rank[:-1])
        new[rows] |= np.append(True, value[1:] != value[:-1])
        rank = np.cumsum(new) - 1
    shared = np.zeros(len(order), np.int64)
    same = np.flatnonzero(near[1:] == near[:-1]) + 1
    if len(same):
        a, b = place[order[same - 1]], place[order[same]]
        room = np.minimum(ends[order[same - 1]] - a, ends[order[same]] - b)
        length = np.full(len(same), LENGTH - LENGTH % 8)
        open_ = np.arange(len(same))
        while len(open_):
            equal = text[a[open_] + length[open_]] == text[b[open_] + length[open_]]
            open_ = open_[equal]
            length[open_] += 1
            open_ = open_[length[open_] < room[open_]]
        shared[same] = np.where(length >= LENGTH, length, 0)
    return owner[order], offset[order], shared


def maximal_repeats(
    stretches: list[bytes], windows: np.ndarray
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, stretches, offsets) of the maximal repeats of at least LENGTH bytes.

    A stack scan over the common prefixes opens an interval where they rise and
    closes it where they fall. An interval is maximal to the left when its
    suffixes follow different bytes; one at the start of its stretch counts as
    different, because the byte before it is not owned.
    """
    owner, offset, shared = suffix_array(stretches, windows)
    inside = np.flatnonzero(shared >= LENGTH)
    if not len(inside):
        return
    # Runs of suffixes that share LENGTH bytes are the roots of the tree here.
    runs = bounds_of([inside - np.arange(len(inside))])
    before = _bytes_before(stretches, owner, offset)
    for a, b in zip(runs[:-1], runs[1:]):
        low, high = inside[a] - 1, inside[b - 1] + 1  # suffixes low .. high - 1
        left = before[low:high]
        if (left == left[0]).all():
            continue  # all go on to the left: a longer repeat has them
        depths = shared[low + 1 : high].tolist()
        stack = [(min(depths), low)]
        for k, depth in enumerate([*depths, 0], low + 1):
            begin = k - 1
            while stack and stack[-1][0] > depth:
                length, begin = stack.pop()
                some = before[begin:k]
                if (some != some[0]).any():
                    yield length, owner[begin:k], offset[begin:k]
            if depth and (not stack or stack[-1][0] < depth):
                stack.append((depth, begin))


def _bytes_before(stretches, owner, offset) -> np.ndarray:
    sizes = np.fromiter(map(len, stretches), np.int64, len(stretches))
    starts = np.cumsum(sizes) - sizes
    text = np.frombuffer(b"".join(stretches), np.uint8)
    before = text[np.maximum(starts[owner] + offset - 1, 0)].astype(np.int64)
    return np.where(offset > 0, before, -1 - owner)


def merged(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Intervals without overlap; touching ones become one."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(stops[order])
    new = np.append(True, starts[1:] > reach[:-1])
    return starts[new], reach[np.append(np.flatnonzero(new)[1:], len(starts)) - 1]


def merged_by_doc(doc, key, starts, stops) -> tuple[np.ndarray, ...]:
    """`merged` for each document; repeats inside repeats leave one interval."""
    order = np.lexsort((key, doc))
    heads = bounds_of([doc[order], key[order]])
    number = np.empty(len(order), np.int64)
    number[order] = np.repeat(np.arange(len(heads) - 1), np.diff(heads))
    heads = order[heads[:-1]]
    # Documents side by side on one line, with a gap between them.
    step = int(stops.max()) + 2
    starts, stops = merged(starts + number * step, stops + number * step)
    number = starts // step
    text = heads[number]
    return doc[text], key[text], starts - number * step, stops - number * step


def _repeat_spans(found: DataFrame) -> DataFrame:
    """(doc_id, key, start, stop): occurrences of maximal repeats other than the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, bounds in whole_groups(batches, ("part",)):
            if len(bounds) < 2 or len(rows) < 2:
                continue
            doc, first = rows.column("doc_id").to_numpy(), rows.column("first").to_numpy()
            key, windows = rows.column("key").to_numpy(), rows.column("windows").to_numpy()
            spans = []
            # Equal windows are in one part, so the parts of a table are one array.
            for length, owner, offset in maximal_repeats(rows.column("bytes").to_pylist(), windows):
                docs, keys, at = doc[owner], key[owner], first[owner] + offset
                head = np.lexsort((at, keys, docs))[0]
                other = (docs != docs[head]) | (keys != keys[head]) | (at != at[head])
                order = np.flatnonzero(other)
                spans.append((docs[order], keys[order], at[order], at[order] + length))
            if spans:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in merged_by_doc(*map(np.concatenate, zip(*spans)))],
                    names=["doc_id", "key", "start", "stop"],
                )

    return together(found, "part").mapInArrow(
        run, "doc_id long, key long, start long, stop long"
    )


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, key, spans): arrays of (start, stop) in bytes that are to be removed."""
    out = materialize(_sorted_out(occurrences(docs)), "anchors")
    wanted = out.filter("not removed").drop("removed")
    searched = _repeat_spans(_stretches(docs, wanted))
    equal = out.filter("removed").select(
        "doc_id",
        "key",
        F.col("first").alias("start"),
        (F.col("first") + F.col("windows") - 1 + LENGTH).alias("stop"),
    )
    return equal.unionAll(searched).groupBy("doc_id", "key").agg(
        F.collect_list(F.struct("start", "stop")).alias("spans")
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), a row per row of `docs`.

    A null text is an empty one. Texts shorter than LENGTH bytes keep all. The
    order of texts is that of doc_id, an integer; a null doc_id comes first, and
    different texts of one doc_id, null too, are in order of a hash. Rows with one
    doc_id and equal texts are one text, of which none is the earlier. Other
    columns are not read.
    """
    key = F.xxhash64("text").alias("key")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key, "text")
    keyed = source.withColumn("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63))))
    spans = repeated_spans(keyed).withColumnsRenamed({"doc_id": "_doc", "key": "_key"})
    same = (F.col("doc_id") == F.col("_doc")) & (F.col("key") == F.col("_key"))
    joined = keyed.join(spans, same, "left").drop("key", "_doc", "_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in chunks(batches):
            out = []
            column = rows.column("spans")
            for k, text in enumerate(texts):
                data = text.encode("utf-8", "surrogatepass")
                begin = end = np.zeros(0, np.int64)
                if column[k].is_valid:
                    flat = column[k].values
                    begin, end = merged(
                        flat.field("start").to_numpy(), flat.field("stop").to_numpy()
                    )
                digest, at = hashlib.sha256(), 0
                for a, b in zip(begin.tolist(), end.tolist()):
                    digest.update(data[at:a])
                    at = b
                digest.update(data[at:])
                out.append((len(data), int((end - begin).sum()), len(begin), digest.hexdigest()))
            size, gone, n, sha = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    *[pa.array(x, pa.int64()) for x in (size, gone, n)],
                    pa.array(sha),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    result = joined.mapInArrow(
        run, f"{ddl([keyed.schema['doc_id']])}, n_bytes long, n_removed long, n_spans long, "
        "kept_sha256 string",
    )
    return result.withColumn("doc_id", F.nullif("doc_id", F.lit(-(1 << 63))))
