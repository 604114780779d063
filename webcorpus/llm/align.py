"""Alignment of two tokenizers' tokens by the bytes they cover.

Both tokenizers cut the same bytes. Where tokens of both end, a group ends; a
token of one is linked to each token of the other that shares a byte with it.

A text of usual length is aligned in the task that reads it. A longer one is cut
into byte ranges that are dealt to tasks as fragments: what is open up to the
first common end, the groups closed inside, what is open after the last common
end. Two neighbours compose to a fragment again and close at most one group
between them. Composition is associative, so a tree of pairs reduces a text of
any length; only open ends move up the tree, closed groups stay where they arose.

How many documents link a pair of ids is one aggregate over all of them. The
texts are read and tokenised once, into blocks that keep their links as numbers of
the block's own pairs (see `blocks`); the counts return to the blocks, so that
every link gets its exact count whatever the number of pairs.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.llm.blocks import (
    by_frequency,
    id_type,
    listed,
    looked_up,
    packed,
    stored,
    unpacked,
)
from webcorpus.llm.groups import together, whole_groups
from webcorpus.llm.texts import chunks, sums
from webcorpus.session import materialize

#: Where the vocabularies are; their files.
VOCABULARIES = "/opt/tokenizers"
FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Characters of the texts that are aligned at once, and make a block.
BLOCK_CHARS = 600_000
#: Bytes of a range of a long text; a text of at most as many is not cut.
RANGE = 1 << 16

#: Fixed value: the pattern that splits a text before the merges of FILE_A.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


# -- the tokenizers -------------------------------------------------------------------


def byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Tokenizers:
    """Both tokenizers and the bytes of their tokens, from the files' contents.

    The merges of the first rank as its ids do, which the vocabulary's own
    library gives the same tokens for (tests compare them).
    """

    def __init__(self, file_a: bytes, file_b: bytes):
        model, byte = json.loads(file_a), byte_characters()
        special = {entry["id"] for entry in model["added_tokens"]}
        ranks = {
            bytes(map(byte.__getitem__, entry)): number
            for entry, number in model["model"]["vocab"].items()
            if number not in special
        }
        self.first = tiktoken.Encoding(
            "byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.second = sentencepiece.SentencePieceProcessor(model_proto=file_b)
        self.bytes_a = [b""] * (max(model["model"]["vocab"].values()) + 1)
        for entry, number in ranks.items():
            self.bytes_a[number] = entry
        self.bytes_b = [
            bytes([int(piece[3:5], 16)]) if self.second.is_byte(k)
            else piece.replace("▁", " ").encode()
            for k, piece in enumerate(map(self.second.id_to_piece, range(len(self.second))))
        ]
        self.sizes_a, self.sizes_b = (
            np.fromiter(map(len, entries), np.int64, len(entries))
            for entries in (self.bytes_a, self.bytes_b)
        )
        # What a token adds to the text of the groups, by (number, last of its side).
        self.written = [b"%d%s" % (k, e) for k in range(len(self.bytes_a)) for e in (b",", b"|")]
        self.written += [b"%d%s" % (k, e) for k in range(len(self.bytes_b)) for e in (b",", b";")]

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Tokens of both for each text; none where their bytes are not the text's."""
        out = []
        for text, b in zip(texts, self.second.encode(texts, num_threads=1)):
            whole = f" {text}"
            data = whole.encode()
            a = self.first.encode_ordinary(whole) if text else []
            same = all(
                b"".join(map(entries.__getitem__, ids)) == data
                for ids, entries in ((a, self.bytes_a), (b, self.bytes_b))
            )
            out.append((a, b) if text and same else ([], []))
        return out

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a * len(self.bytes_b) + b



class Files(NamedTuple):
    a: bytes
    b: bytes


def read_files(folder: str) -> Files:
    with open(f"{folder}/{FILE_A}", "rb") as a, open(f"{folder}/{FILE_B}", "rb") as b:
        return Files(a.read(), b.read())


# -- tokens, links and groups of a stretch of bytes -----------------------------------


class Tokens(NamedTuple):
    """Consecutive tokens of both sides: ids and the bytes they end at."""

    a: np.ndarray
    a_ends: np.ndarray
    b: np.ndarray
    b_ends: np.ndarray

    def cut(self, low: int, high: int) -> Tokens:
        """The tokens that end after `low` and up to `high`."""
        i, j = np.searchsorted(self.a_ends, [low, high], "right")
        k, m = np.searchsorted(self.b_ends, [low, high], "right")
        return Tokens(self.a[i:j], self.a_ends[i:j], self.b[k:m], self.b_ends[k:m])

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(*(np.concatenate(x) for x in zip(self, other)))

    def packed(self) -> bytes:
        sizes = np.array([len(self.a), len(self.b)], np.int64)
        return np.concatenate([sizes, *self]).tobytes()

    @classmethod
    def unpacked(cls, data: bytes) -> Tokens:
        flat = np.frombuffer(data, np.int64)
        n, m = flat[:2].tolist()
        return cls(*np.split(flat[2:], [n, 2 * n, 2 * n + m]))


NONE = Tokens(*[np.zeros(0, np.int64)] * 4)


def common_ends(tokens: Tokens) -> np.ndarray:
    return np.intersect1d(tokens.a_ends, tokens.b_ends, assume_unique=True)


def links(tokens: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ends, a, b): the places of the linked tokens, and the byte each link ends at.

    Between two ends of either side lies one stretch that one token of each side
    covers, and two tokens share at most one such stretch.
    """
    ends = np.concatenate([tokens.a_ends, tokens.b_ends])
    ends.sort(kind="stable")
    ends = ends[np.append(ends[1:] != ends[:-1], True)] if len(ends) else ends
    return ends, np.searchsorted(tokens.a_ends, ends), np.searchsorted(tokens.b_ends, ends)


def written_order(tokens: Tokens, cuts: np.ndarray, n_a: int) -> np.ndarray:
    """Numbers into `Tokenizers.written` of all tokens, group by group, A before B."""
    group_a = np.searchsorted(cuts, tokens.a_ends)
    group_b = np.searchsorted(cuts, tokens.b_ends)
    last_a = np.append(group_a[1:] != group_a[:-1], True) if len(group_a) else group_a > 0
    last_b = np.append(group_b[1:] != group_b[:-1], True) if len(group_b) else group_b > 0
    out = np.empty(len(group_a) + len(group_b), np.int64)
    out[np.arange(len(group_a)) + np.searchsorted(group_b, group_a, "left")] = 2 * tokens.a + last_a
    out[np.arange(len(group_b)) + np.searchsorted(group_a, group_b, "right")] = (
        2 * (n_a + tokens.b) + last_b
    )
    return out


class Fragment(NamedTuple):
    """A byte range: open before its first common end, closed groups, open after the last.

    Without a common end (`cut` false) everything is in `prefix`.
    """

    cut: bool
    prefix: Tokens
    closed: tuple[Tokens, ...]
    suffix: Tokens

    @classmethod
    def of(cls, tokens: Tokens) -> Fragment:
        cuts = common_ends(tokens)
        if not len(cuts):
            return cls(False, tokens, (), NONE)
        first, last = int(cuts[0]), int(cuts[-1])
        inside = tokens.cut(first, last)
        top = 1 << 62
        closed = (inside,) if len(inside.a) else ()
        return cls(True, tokens.cut(-1, first), closed, tokens.cut(last, top))

    def __add__(self, other: Fragment) -> Fragment:
        """This fragment and the one that follows it."""
        if not self.cut:
            return Fragment(other.cut, self.prefix + other.prefix, other.closed, other.suffix)
        if not other.cut:
            return self._replace(suffix=self.suffix + other.prefix)
        between = (self.suffix + other.prefix,)
        return Fragment(True, self.prefix, self.closed + between + other.closed, other.suffix)


# -- texts of usual length ------------------------------------------------------------


def _flat(encoded: list[tuple[list[int], list[int]]], made: Tokenizers) -> tuple[Tokens, np.ndarray]:
    """Tokens of all texts one after the other, and the byte that each text ends at."""
    a = np.concatenate([np.array(x, np.int64) for x, _ in encoded])
    b = np.concatenate([np.array(y, np.int64) for _, y in encoded])
    a_ends, b_ends = np.cumsum(made.sizes_a[a]), np.cumsum(made.sizes_b[b])
    sizes = np.cumsum([len(x) for x, _ in encoded])
    stops = np.append(0, a_ends)[sizes]
    return Tokens(a, a_ends, b, b_ends), stops


_DOC = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_MADE = [field.split(" ")[0] for field in _DOC.split(", ")]
_KEPT = ("n_a", "n_b", "n_groups", "n_links")


def _blocks(docs: DataFrame, files) -> DataFrame:
    """Blocks of aligned documents: what is known of each, and their links.

    `codes` numbers the block's `pairs`, `holders` counts the documents of the
    block that link a pair.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Tokenizers(*files.value)
        for rows, texts in chunks(batches, BLOCK_CHARS):
            encoded = made.encode(texts)
            tokens, stops = _flat(encoded, made)
            ends, a, b = links(tokens)
            cuts = common_ends(tokens)
            pairs, codes = by_frequency(made.pair(tokens.a[a], tokens.b[b]))
            # A document has many links of one pair; it holds the pair once.
            once = np.unique(np.searchsorted(stops, ends) * len(pairs) + codes) % max(len(pairs), 1)
            n_a = [len(x) for x, _ in encoded]
            n_b = [len(y) for _, y in encoded]
            shown = written_order(tokens, cuts, len(made.bytes_a)).tolist()
            shas, start = [], 0
            for size in map(sum, zip(n_a, n_b)):
                text = b"".join(map(made.written.__getitem__, shown[start : start + size]))
                shas.append(hashlib.sha256(text[:-1]).hexdigest() if size else "")
                start += size
            counts = (
                n_a,
                n_b,
                np.diff(np.append(0, np.searchsorted(cuts, stops, "right"))),
                np.diff(np.append(0, np.searchsorted(ends, stops, "right"))),
            )
            columns = {"docs": rows.column("doc_id"), "groups_sha256": pa.array(shas, pa.string())}
            columns |= {c: pa.array(x, pa.int64()) for c, x in zip(_KEPT, counts)}
            columns |= {"pairs": pa.array(pairs), "holders": pa.array(np.bincount(once, minlength=len(pairs)))}
            lists = {c: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for c, x in columns.items()}
            yield pa.RecordBatch.from_pydict({"codes": pa.array([packed(codes)], pa.binary()), **lists})

    numbers = ", ".join(f"{c} array<long>" for c in (*_KEPT, "pairs", "holders"))
    schema = f"codes binary, docs array<{id_type(docs)}>, groups_sha256 array<string>, {numbers}"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _counted(left: pa.Table, right: pa.Table) -> pa.Table:
    """A row per document of a block, from the block and its pairs' counts."""
    block = left.combine_chunks().to_batches()[0]
    lists = {c: block.column(c)[0].values for c in ("docs", "groups_sha256", *_KEPT)}
    bounds = np.append(0, np.cumsum(lists["n_links"].to_numpy()))
    codes = unpacked(block.column("codes")[0].as_py(), int(bounds[-1]))
    at = right.column("at").to_numpy()
    n, best = np.zeros((2, int(codes.max(initial=0)) + 1), np.int64)
    n[at], best[at] = right.column("n").to_numpy(), right.column("best").to_numpy()
    sums_ = {"n_best": pa.array(sums(best[codes], bounds)), "count_sum": pa.array(sums(n[codes], bounds))}
    lists["doc_id"] = lists.pop("docs")
    return pa.table({c: (lists | sums_)[c] for c in ("doc_id", *_MADE)})


# -- long texts -----------------------------------------------------------------------


def _ranges(docs: DataFrame, files, size: int) -> DataFrame:
    """(row, doc_id, at, ranges, n_a, n_b, tokens): the tokens that end in each byte range."""
    source = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Tokenizers(*files.value)
        for rows, texts in chunks(batches, BLOCK_CHARS):
            for k, encoded in enumerate(made.encode(texts)):
                tokens, stops = _flat([encoded], made)
                n = max(1, -(-int(stops[0]) // size))
                parts = [tokens.cut(at * size, (at + 1) * size) for at in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([rows.column("row")[k].as_py()] * n, pa.int64()),
                        rows.column("doc_id").take(pa.array([k] * n)),
                        pa.array(np.arange(n)),
                        pa.array([n] * n, pa.int64()),
                        pa.array([len(p.a) for p in parts], pa.int64()),
                        pa.array([len(p.b) for p in parts], pa.int64()),
                        pa.array([p.packed() for p in parts], pa.binary()),
                    ],
                    names=["row", "doc_id", "at", "ranges", "n_a", "n_b", "tokens"],
                )

    return source.mapInArrow(
        run,
        f"row long, doc_id {id_type(docs)}, at long, ranges long, n_a long, n_b long, tokens binary",
    )


#: Open ends of a fragment, and what it closed: the first byte's place, the groups as
#: numbers of written tokens, and the pairs with their number of links.
_PART = (
    "row long, at long, cut boolean, prefix binary, suffix binary, start long, n_groups long, "
    "n_written long, written binary, pairs array<long>, times array<long>"
)
_PART_NAMES = [field.split(" ")[0] for field in _PART.split(", ")]


def _part(row: int, at: int, fragment: Fragment, made: Tokenizers) -> tuple:
    """A fragment as a row of _PART."""
    tokens = sum(fragment.closed, NONE)
    cuts, (ends, a, b) = common_ends(tokens), links(tokens)
    pairs, times = np.unique(made.pair(tokens.a[a], tokens.b[b]), return_counts=True)
    shown = written_order(tokens, cuts, len(made.bytes_a))
    # Every closed group starts where the open prefix ends.
    start = int(ends[0]) if len(ends) else 0
    return (
        row, at, fragment.cut, fragment.prefix.packed(), fragment.suffix.packed(),
        start, len(cuts), len(shown), packed(shown), pairs.tolist(), times.tolist(),
    )


def _parts(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"row": pa.int64(), "at": pa.int64(), "cut": pa.bool_(), "prefix": pa.binary(),
             "suffix": pa.binary(), "start": pa.int64(), "n_groups": pa.int64(),
             "n_written": pa.int64(), "written": pa.binary(), "pairs": pa.list_(pa.int64()),
             "times": pa.list_(pa.int64())}
    columns = [pa.array(x, kinds[c]) for c, x in zip(_PART_NAMES, zip(*rows))]
    return pa.RecordBatch.from_arrays(columns, names=_PART_NAMES)


def _fragments(ranges: DataFrame, files) -> DataFrame:
    """The fragment of each byte range, its closed groups already aligned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Tokenizers(*files.value)
        for batch in batches:
            for row, at, data in zip(*(batch.column(c).to_pylist() for c in ("row", "at", "tokens"))):
                yield _parts([_part(row, at, Fragment.of(Tokens.unpacked(data)), made)])

    dealt = ranges.select("row", "at", "tokens").repartition("row", "at")
    return dealt.mapInArrow(run, _PART)


def _composed(level: DataFrame, files) -> DataFrame:
    """Each two neighbours as one fragment; what they close between them is new."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = None
        for rows, bounds in whole_groups(batches, ("row", "pair")):
            made = made or Tokenizers(*files.value)
            column = {c: rows.column(c).to_pylist() for c in ("row", "pair", "cut", "prefix", "suffix")}
            for start, stop in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                whole = None
                for k in range(start, stop):
                    ends = (Tokens.unpacked(column[c][k]) for c in ("prefix", "suffix"))
                    prefix, suffix = ends
                    own = Fragment(column["cut"][k], prefix, (), suffix)
                    whole = own if whole is None else whole + own
                yield _parts([_part(column["row"][start], column["pair"][start], whole, made)])

    open_ = level.select(
        "row", F.shiftright("at", 1).alias("pair"), "at", "cut", "prefix", "suffix"
    )
    return together(open_, "row", "pair", order=("at",)).mapInArrow(run, _PART)


def _first_groups(root: DataFrame, files) -> DataFrame:
    """What is open at the start of a text is closed, because nothing comes before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = None
        for batch in batches:
            made = made or Tokenizers(*files.value)
            for row, prefix in zip(batch.column("row").to_pylist(), batch.column("prefix").to_pylist()):
                tokens = Tokens.unpacked(prefix)
                closed = (tokens,) if len(tokens.a) else ()
                yield _parts([_part(row, 0, Fragment(True, NONE, closed, NONE), made)])

    return root.select("row", "prefix").mapInArrow(run, _PART)


def _hashes(parts: DataFrame, files) -> DataFrame:
    """(row, groups_sha256): the groups of a text hashed in order, a part at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, row, digest, last = None, None, None, b""
        for batch in batches:
            made = made or Tokenizers(*files.value)
            columns = (batch.column(c).to_pylist() for c in ("row", "n_written", "written"))
            for own, n, data in zip(*columns):
                if own != row:
                    if row is not None:
                        digest.update(last[:-1])
                        yield pa.RecordBatch.from_pylist([{"row": row, "groups_sha256": digest.hexdigest()}])
                    row, digest, last = own, hashlib.sha256(), b""
                digest.update(last)
                last = b"".join(map(made.written.__getitem__, unpacked(data, n).tolist()))
        if row is not None:
            digest.update(last[:-1])
            yield pa.RecordBatch.from_pylist([{"row": row, "groups_sha256": digest.hexdigest()}])

    dealt = parts.filter("n_written > 0").select("row", "start", "n_written", "written")
    return together(dealt, "row", order=("start",)).mapInArrow(run, "row long, groups_sha256 string")


def _long(docs: DataFrame, files, size: int) -> tuple[DataFrame, DataFrame]:
    """(rows, links): a row per long text without its pairs' counts, and (row, pair, times)."""
    ranges = materialize(_ranges(docs, files, size), "ranges")
    most = ranges.agg(F.max("ranges")).first()[0] or 1
    level = materialize(_fragments(ranges, files), "fragments")
    parts = level
    while most > 1:
        level = materialize(_composed(level, files), "fragments")
        parts = parts.unionAll(level)
        most = -(-most // 2)
    parts = parts.unionAll(materialize(_first_groups(level, files), "fragments"))
    linked = parts.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).groupBy(
        "row", F.col("l.pairs").alias("pair")
    ).agg(F.sum("l.times").alias("times"))
    linked = materialize(linked, "long-links")
    sizes = ranges.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b")
    )
    groups = parts.groupBy("row").agg(F.sum("n_groups").alias("n_groups"))
    total = linked.groupBy("row").agg(F.sum("times").alias("n_links"))
    none = F.lit(0).cast("long")
    rows = (
        sizes.join(groups, "row").join(total, "row", "left").join(_hashes(parts, files), "row", "left")
        .select(
            "row", "doc_id", "n_a", "n_b", "n_groups", F.coalesce("n_links", none).alias("n_links"),
            F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
        )
    )
    return rows, linked


# -- all texts ------------------------------------------------------------------------


def align(docs: DataFrame, vocabularies: str = VOCABULARIES, size: int = RANGE) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), a row per row.

    `docs` has doc_id and text. Null and empty texts, and texts that a tokenizer's
    tokens do not give back byte for byte, have no tokens: zeros and an empty hash.
    Repeated rows are documents of their own. An empty table gives no row. Other
    columns are not read. The vocabularies are read on the driver and sent along.
    """
    spark = docs.sparkSession
    contents = read_files(vocabularies)
    files = spark.sparkContext.broadcast(contents)
    n_b = len(sentencepiece.SentencePieceProcessor(model_proto=contents.b))
    short = docs.filter(F.coalesce(F.octet_length("text"), F.lit(0)) <= size)
    blocks = stored(_blocks(short, files), "blocks")
    long_rows, long_links = _long(docs.filter(F.octet_length("text") > size), files, size)
    counts = materialize(
        listed(blocks, "pairs", "holders").select(F.col("pairs").alias("pair"), "holders")
        .unionAll(long_links.select("pair", F.lit(1).cast("long")))
        .groupBy("pair").agg(F.sum("holders").alias("n")),
        "pairs",
    )
    of_a = F.floor(F.col("pair") / F.lit(n_b)).alias("a")
    # One row per id of the first vocabulary.
    highest = counts.groupBy(of_a).agg(F.max("n").alias("highest"))
    values = materialize(
        counts.withColumn("a", of_a).join(F.broadcast(highest), "a")
        .select("pair", "n", (F.col("n") == F.col("highest")).cast("long").alias("best")),
        "pairs",
    )
    rows = looked_up(
        blocks.drop("holders"), "pairs", values, "pair", _counted, f"doc_id {id_type(docs)}, {_DOC}"
    )
    settled = long_links.join(values, "pair").groupBy("row").agg(
        F.sum(F.col("times") * F.col("best")).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"),
    )
    none = F.lit(0).cast("long")
    long_rows = long_rows.join(settled, "row", "left").withColumns(
        {c: F.coalesce(c, none) for c in ("n_best", "count_sum")}
    )
    return rows.unionByName(long_rows.select("doc_id", *_MADE))
