"""N-gram Jaccard join by chosen paths.

Texts are sets of word 5-grams. Texts with equal sets are one class; a class is
embedded as T tokens, one minimum hash each. In every run a class follows the
tokens whose hash, given the path so far, is small: about 1 / (LAMBDA * T) of
them, so that two similar classes share one on average. Classes with the same
path share a bucket. A bucket of at most LIMIT classes is searched by brute
force on 1-byte sketches, a larger one is split on further tokens. Runs repeat
until a pair at the threshold is missed with a probability below 1 - RECALL.

Near copies of one text share their tokens, so no token splits them. They are
compared with a few members of their bucket instead; a bucket whose classes are
all connected by that needs no search and is closed. Where few pairs are left that
are not connected, these are searched at once, in blocks, and so are all that are
left after DEPTH tokens.

Pairs that the sketches let pass only connect classes. Inside a connected part
the links are exact. The classes at a distance of at most half the threshold from
the part's first class, the core, are linked to each other by the triangle
inequality, which the Jaccard distance obeys; they are counted, not compared. The
other classes are compared with all, set by set, in blocks. Only counts and a
spanning forest leave a block.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webcorpus.llm.groups import components, linked, together, whole_groups
from webcorpus.llm.texts import WordHashes, chunks, flat_words
from webcorpus.session import ddl, materialize

#: Words in a shingle; a shorter text is one shingle.
SHINGLE = 5
#: Similarity from which two texts are linked: SIMILAR / OF.
SIMILAR, OF = 4, 5
#: Tokens of the embedding; share of them that similar texts have at least; recall.
T, LAMBDA, RECALL = 128, 0.7, 0.999
#: Classes in a bucket that is not split further, and tokens in a path.
LIMIT, DEPTH = 512, 4
#: Share of equal sketch bytes from which two classes are compared exactly: five
#: standard deviations below the threshold.
SKETCH = 0.63
#: Classes, and shingles of their texts, in a block of a brute-force search.
BLOCK, BLOCK_SHINGLES = 2_048, 1_000_000

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xBF58476D1CE4E5B9)


def runs_needed() -> int:
    """Runs until a pair at the threshold is missed less often than 1 - RECALL."""
    shared, found = SIMILAR / OF / LAMBDA, 1.0
    for _ in range(DEPTH):
        found = 1 - math.exp(-shared * found)
    return math.ceil(math.log(1 - RECALL) / math.log(1 - found))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str], table: WordHashes) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; none for a text without words."""
    flat, bounds = flat_words(texts)
    words = table.array(flat)
    size = max(0, len(words) - SHINGLE + 1)
    rolled = np.zeros(size, np.uint64)
    for k in range(SHINGLE):
        rolled = (rolled + words[k : k + size]) * _A
        rolled ^= rolled >> np.uint64(32)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= SHINGLE:
            out.append(np.unique(rolled[a : b - SHINGLE + 1]))
        elif b > a:
            short = np.array([b - a], np.uint64)
            for k in range(a, b):
                short = _mix(short + words[k : k + 1])
            out.append(short)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def class_number(shingles: np.ndarray) -> int:
    """The same for equal sets; 63 bits of a hash of the set."""
    digest = hashlib.blake2b(shingles.tobytes(), digest_size=8).digest()
    return int.from_bytes(digest, "little") >> 1


class Embedder:
    """T minimum hashes of a set, its sketch and its first path tokens."""

    def __init__(self, runs: int):
        rng = np.random.default_rng(11)
        self.flip = rng.integers(0, 1 << 32, T, np.uint32)
        self.odd = rng.integers(0, 1 << 32, T, np.uint32) | np.uint32(1)
        self.runs = runs
        self.place = np.arange(T, dtype=np.uint64) << np.uint64(32)

    def tokens(self, shingles: np.ndarray) -> np.ndarray:
        low = (shingles & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        best = np.full(T, 0xFFFFFFFF, np.uint32)
        for k in range(0, len(low), 2048):
            part = low[k : k + 2048, None] ^ self.flip
            part *= self.odd
            np.minimum(best, part.min(axis=0), out=best)
        return best

    def sketch(self, tokens: np.ndarray) -> np.ndarray:
        return ((tokens * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)

    def paths(self, tokens: np.ndarray) -> list[np.ndarray]:
        """First path keys of each row of tokens, over all runs."""
        out = [[] for _ in tokens]
        whole = tokens.astype(np.uint64) + self.place
        for run in range(self.runs):
            rows, keys = chosen(_mix(whole + _mix(np.array([run + 1], np.uint64))))
            for row, key in zip(rows.tolist(), keys.tolist()):
                out[row].append(key)
        return out


def chosen(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of the small hashes in rows of T; a key has 63 bits."""
    row, at = np.nonzero(hashes < np.uint64(int(2**64 / (LAMBDA * T))))
    return row, (_mix(hashes[row, at]) >> np.uint64(1)).astype(np.int64)


def row_key() -> Column:
    """The same for rows of one doc_id and text, whatever else they hold."""
    return F.xxhash64("doc_id", "text").alias("row_key")


def embed(docs: DataFrame) -> DataFrame:
    """(doc_id, row_key, cid, n, sketch, keys): one row for a text with words, in one pass."""
    runs = runs_needed()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, embedder = WordHashes(8), Embedder(runs)
        for rows, texts in chunks(batches):
            sets = shingle_sets(texts, table)
            some = [k for k, s in enumerate(sets) if len(s)]
            if not some:
                continue
            tokens = np.stack([embedder.tokens(sets[k]) for k in some])
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id").take(pa.array(some)),
                    rows.column("row_key").take(pa.array(some)),
                    pa.array([class_number(sets[k]) for k in some], pa.int64()),
                    pa.array([len(sets[k]) for k in some], pa.int64()),
                    pa.array([r.tobytes() for r in embedder.sketch(tokens)], pa.binary()),
                    pa.array(embedder.paths(tokens), pa.list_(pa.int64())),
                ],
                names=["doc_id", "row_key", "cid", "n", "sketch", "keys"],
            )

    source = docs.select("doc_id", "text", row_key())
    return source.mapInArrow(
        run,
        f"{ddl([source.schema['doc_id']])}, row_key long, cid long, n long, sketch binary, "
        "keys array<long>",
    )


def _longer(rows: DataFrame) -> DataFrame:
    """(key, cid): paths longer by one token, from (key, cid, sketch)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.arange(T, dtype=np.uint64) << np.uint64(8)
        for batch in batches:
            cids = batch.column("cid").to_numpy()
            paths = _mix(batch.column("key").to_numpy().astype(np.uint64))
            sketch = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint8)
            for k in range(0, len(cids), 8192):
                part = sketch[k * T : (k + 8192) * T].reshape(-1, T).astype(np.uint64) + place
                row, keys = chosen(_mix(part + paths[k : k + 8192, None]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(cids[k + row])], names=["key", "cid"]
                )

    return rows.select("key", "cid", "sketch").mapInArrow(run, "key long, cid long")


def _stars(large: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): links that connect classes of large buckets to members that their sketch
    agrees with, of three of each bucket."""
    some = large.groupBy("key").agg(
        F.array(F.min("cid"), F.max("cid"), F.min_by("cid", F.xxhash64("cid"))).alias("some")
    )
    # A class is in few buckets, whose members of choice are mostly the same.
    chosen = F.array_distinct(F.flatten(F.collect_list("some"))).alias("some")
    pairs = (
        large.join(some, "key")
        .groupBy(F.col("cid").alias("a"))
        .agg(chosen)
        .select("a", F.explode("some").alias("b"))
        .filter("a <> b")
    )
    own = classes.select(F.col("cid").alias("a"), F.col("sketch").alias("left"))
    other = classes.select(F.col("cid").alias("b"), F.col("sketch").alias("right"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, T)
                for c in ("left", "right")
            )
            near = (left == right).sum(axis=1) >= math.ceil(SKETCH * T)
            ends = np.concatenate([batch.column(c).to_numpy()[near] for c in ("a", "b")])
            cid, at = np.unique(ends, return_inverse=True)
            # A forest connects the same classes.
            label = linked(len(cid), *np.split(at.reshape(-1), 2))
            away = np.flatnonzero(label != np.arange(len(label)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cid[away]), pa.array(cid[label[away]])], names=["a", "b"]
            )

    return pairs.join(own, "a").join(other, "b").select("a", "b", "left", "right").mapInArrow(
        run, "a long, b long"
    )


def _leaves(classes: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(leaves, edges): the buckets to search, and the links that settle large ones.

    `leaves` has (key, cid, label, major, outer, inner), each set of classes once.
    Classes of one label are connected by `edges`. In a large bucket the classes
    of its most frequent label are `major` and need to meet the others only. The
    others are searched in `outer` blocks and the major ones in `inner` blocks.
    """
    level = classes.select(F.explode("keys").alias("key"), "cid")
    leaves = edges = labels = None
    for depth in range(1, DEPTH + 1):
        level = materialize(level, "paths")
        # Two hashes of the members tell buckets of the same classes.
        size = level.groupBy("key").agg(
            F.count("*").alias("n"),
            F.bit_xor(F.xxhash64("cid")).alias("x"),
            F.bit_xor(F.xxhash64("cid", F.lit(1))).alias("y"),
        )
        size = materialize(size.filter("n > 1"), "buckets")
        large = level.join(size.filter(F.col("n") > LIMIT), "key", "left_semi")
        if depth == 1:
            large = materialize(large, "large")
            if not large.isEmpty():
                stars = materialize(_stars(large, classes), "stars")
                labels = components(stars).select(
                    F.col("id").alias("cid"), F.col("component").alias("label")
                )
                # One link per class says all that the stars say.
                edges = labels.filter("cid <> label").select(
                    F.col("cid").alias("a"), F.col("label").alias("b")
                )
        small = _distinct_buckets(size.filter(F.col("n") <= LIMIT))
        part = level.join(small, "key", "left_semi").select(
            "key", "cid", F.col("cid").alias("label"), F.lit(False).alias("major"),
            F.lit(1).alias("outer"), F.lit(0).alias("inner"),
        )
        leaves = part if leaves is None else leaves.unionByName(part)
        if labels is None:
            break
        named = large.join(labels, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
        named = materialize(named, "large")
        parts = named.groupBy("key", "label").agg(F.count("*").alias("c"))
        # Pairs of classes that are not connected, from both sides.
        open_ = parts.groupBy("key").agg(
            F.sum("c").alias("n"),
            (F.sum("c") * F.sum("c") - F.sum(F.col("c") * F.col("c"))).alias("cross"),
            F.max(F.struct("c", "label")).alias("top"),
        )
        open_ = materialize(open_.filter("cross > 0"), "open")
        # Few for the bucket's size: at most LIMIT others for each class, or, where most
        # pairs are connected, as many as fit one block.
        few = F.col("cross") <= F.col("n") * F.greatest(
            F.lit(2 * LIMIT), F.least(F.col("n") / 4, F.lit(BLOCK))
        )
        done = open_ if depth == DEPTH else open_.filter(few)
        once = _distinct_buckets(size.join(done, "key", "left_semi")).select("key")
        both = done.join(once, "key", "left_semi").select(
            "key",
            F.col("top.label").alias("_top"),
            F.ceil((F.col("n") - F.col("top.c")) / (2 * BLOCK)).cast("int").alias("outer"),
            F.ceil(F.col("top.c") / (2 * BLOCK)).cast("int").alias("inner"),
        )
        leaves = leaves.unionByName(
            named.join(both, "key").select(
                "key", "cid", "label", (F.col("label") == F.col("_top")).alias("major"),
                "outer", "inner",
            )
        )
        if depth == DEPTH:
            break
        rows = named.join(open_.filter(~few), "key", "left_semi").select("key", "cid")
        if rows.isEmpty():
            break
        level = _longer(rows.join(classes.select("cid", "sketch"), "cid"))
    return leaves, edges


def _distinct_buckets(size: DataFrame) -> DataFrame:
    """(key, n) of one bucket for each set of classes."""
    return size.groupBy("n", "x", "y").agg(F.min("key").alias("key")).select("key", "n")


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Leaves dealt to pairs of blocks (i, j) of their bucket, `own` their block.

    A row that is not major goes to a pair with every block, a major one to a
    pair with every block of others, so that any two rows meet once, but for
    two major ones, which are connected.
    """
    number = F.xxhash64("cid", F.lit(5))
    own = F.when(F.col("major"), F.col("outer") + F.pmod(number, F.greatest("inner", F.lit(1)))).otherwise(
        F.pmod(number, F.col("outer"))
    )
    last = F.col("outer") + F.when(F.col("major"), F.lit(0)).otherwise(F.col("inner")) - 1
    dealt = rows.withColumn("own", own.cast("int")).select(
        "*", F.explode(F.sequence(F.lit(0), last)).alias("_other")
    )
    return dealt.select(
        "key",
        F.least("own", "_other").alias("i"),
        F.greatest("own", "_other").alias("j"),
        *[c for c in dealt.columns if c not in ("key", "_other", "outer", "inner", "major")],
    )


def _pairs(
    bounds: np.ndarray, own: np.ndarray, i: np.ndarray, j: np.ndarray, label: np.ndarray, some: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers (a, b) of the pairs of different labels in each group, about `some` at a time."""
    held_a, held_b, held = [], [], 0
    for start, stop in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        left = start + np.flatnonzero(own[start:stop] == i[start])
        right = start + np.flatnonzero(own[start:stop] == j[start])
        step = max(1, some // max(len(right), 1))
        for k in range(0, len(left), step):
            part = left[k : k + step]
            a, b = np.repeat(part, len(right)), np.tile(right, len(part))
            keep = label[a] != label[b]
            if i[start] == j[start]:
                keep &= a < b
            held_a.append(a[keep])
            held_b.append(b[keep])
            held += len(held_a[-1])
            if held >= some:
                yield np.concatenate(held_a), np.concatenate(held_b)
                held_a, held_b, held = [], [], 0
    if held:
        yield np.concatenate(held_a), np.concatenate(held_b)


def _candidates(leaves: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): a forest that connects the classes whose sketches agree in a bucket."""
    dealt = _in_blocks(leaves.join(classes.select("cid", "sketch"), "cid"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = math.ceil(SKETCH * T)
        for rows, bounds in whole_groups(batches, ("key", "i", "j")):
            column = {c: rows.column(c).to_numpy() for c in ("cid", "i", "j", "own", "label")}
            sketch = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8)
            sketch = sketch.reshape(-1, T)
            left, right = [], []
            places = (column[c] for c in ("own", "i", "j", "label"))
            for a, b in _pairs(bounds, *places, 50_000):
                near = (sketch[a] == sketch[b]).sum(axis=1) >= least
                left.append(a[near])
                right.append(b[near])
            if not left:
                continue
            label = linked(len(sketch), np.concatenate(left), np.concatenate(right))
            away = np.flatnonzero(label != np.arange(len(label)))
            cid = column["cid"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cid[away]), pa.array(cid[label[away]])], names=["a", "b"]
            )

    # In order of cid, a part's smallest row is its smallest cid, so the buckets of
    # one large group give mostly the same links.
    dealt = together(dealt, "key", "i", "j", order=("cid",))
    return dealt.mapInArrow(run, "a long, b long").distinct()


def _overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets[left] with sets[right], as a table.

    Shingles in one set only are left out; for the others a 0-1 matrix is
    multiplied, some columns at a time.
    """
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    new = np.ones(len(flat), bool)
    new[1:] = flat[order[1:]] != flat[order[:-1]]
    column = np.cumsum(new) - 1
    many = np.bincount(column)[column] > 1
    number = np.cumsum(new & many) - 1
    owner, number = owner[order][many], number[many]
    out = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, int(number[-1]) + 1 if len(number) else 0, 4096):
        a, b = np.searchsorted(number, [start, start + 4096])
        part = np.zeros((len(sets), 4096), np.float32)
        part[owner[a:b], number[a:b] - start] = 1
        out += part[left] @ part[right].T
    return out.astype(np.int64)


def _sets(members: DataFrame, docs: DataFrame) -> DataFrame:
    """(cid, component, copies, blocks, shingles) of the members, read from one text each."""
    # The members grow with the texts, so they are never broadcast, also when small.
    texts = docs.select("text", row_key()).hint("merge").join(members, "row_key")
    # Equal rows have one key; one of them is enough.
    texts = texts.dropDuplicates(["row_key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordHashes(8)
        for rows, some in chunks(batches):
            sets = shingle_sets(some, table)
            yield pa.RecordBatch.from_arrays(
                [
                    *[rows.column(c) for c in ("cid", "component", "copies", "blocks")],
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                names=["cid", "component", "copies", "blocks", "shingles"],
            )

    return texts.mapInArrow(
        run, "cid long, component long, copies long, blocks long, shingles binary"
    )


def _distances(sets: DataFrame) -> DataFrame:
    """(cid, component, copies, blocks, core): whether a class is in its part's core.

    The part's first class goes to every block of the part, every other class to one.
    """
    own = F.pmod(F.xxhash64("cid", F.lit(5)), F.col("blocks")).cast("int")
    first = F.col("cid") == F.col("component")
    every = F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)
    dealt = sets.select(
        "*", own.alias("own"), F.explode(F.when(first, every).otherwise(F.array(own))).alias("i")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, bounds in whole_groups(batches, ("component", "i")):
            column = {c: rows.column(c).to_numpy() for c in ("cid", "component", "i", "own")}
            binary = rows.column("shingles")
            core = np.zeros(rows.num_rows, bool)
            for start, stop in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                some = [np.frombuffer(binary[k].as_py(), np.uint64) for k in range(start, stop)]
                size = np.fromiter(map(len, some), np.int64, len(some))
                at = np.flatnonzero(column["cid"][start:stop] == column["component"][start])
                lead = some[int(at[0])]
                flat = np.concatenate(some)
                place = np.minimum(np.searchsorted(lead, flat), len(lead) - 1)
                both = np.add.reduceat((lead[place] == flat).astype(np.int64), np.cumsum(size) - size)
                union = size + len(lead) - both
                core[start:stop] = 2 * OF * (union - both) <= (OF - SIMILAR) * union
            mine = pa.array(column["own"] == column["i"])
            out = rows.select(["cid", "component", "copies", "blocks"])
            out = out.append_column("core", pa.array(core)).filter(mine)
            yield from out.to_batches()

    # No set is empty, so every block of a part holds the part's first class.
    return together(dealt, "component", "i").mapInArrow(
        run, "cid long, component long, copies long, blocks long, core boolean"
    )


def _exact(sets: DataFrame) -> DataFrame:
    """(cid, other, links, text_links): the links within connected parts.

    `links` counts the documents, `text_links` the classes that a class is
    linked to, summed over the rows of a class; `other` connects it to one of them.
    """
    near = materialize(_distances(sets), "cores")
    size = near.groupBy("component").agg(
        F.sum(F.col("core").cast("long")).alias("cores"),
        F.sum(F.when(F.col("core"), F.col("copies")).otherwise(0)).alias("core_copies"),
        F.count("*").alias("classes"),
    )
    size = materialize(size, "parts")
    inside = near.filter("core").join(size, "component").select(
        "cid",
        F.col("component").alias("other"),
        (F.col("core_copies") - F.col("copies")).alias("links"),
        (F.col("cores") - 1).alias("text_links"),
    )
    # Parts with classes outside the core: these meet all, in blocks of both.
    open_ = size.filter("classes > cores").select(
        "component", F.ceil((F.col("classes") - F.col("cores")) / BLOCK).alias("outer")
    )
    rows = sets.join(near.select("cid", "core"), "cid").join(open_, "component")
    outer = F.greatest(F.col("outer"), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("cid", F.lit(5)), F.col("blocks")).cast("int")
    mine = F.pmod(F.xxhash64("cid", F.lit(6)), outer).cast("int")
    as_any = rows.select(
        "component", "cid", "copies", "shingles", "core", F.lit(False).alias("seeks"),
        F.explode(F.sequence(F.lit(0), outer - 1)).alias("i"), own.alias("j"),
    )
    as_outer = rows.filter("not core").select(
        "component", "cid", "copies", "shingles", "core", F.lit(True).alias("seeks"),
        mine.alias("i"), F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)).alias("j"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, bounds in whole_groups(batches, ("component", "i", "j")):
            column = {c: rows.column(c).to_numpy() for c in ("cid", "copies", "core", "seeks")}
            binary = rows.column("shingles")
            out = []
            for start, stop in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                cid, copies, core, seeks = (
                    column[c][start:stop] for c in ("cid", "copies", "core", "seeks")
                )
                left, right = np.flatnonzero(seeks), np.flatnonzero(~seeks)
                if not len(left) or not len(right):
                    continue
                some = [np.frombuffer(binary[k].as_py(), np.uint64) for k in range(start, stop)]
                size = np.fromiter(map(len, some), np.int64, len(some))
                both = _overlaps(some, left, right)
                near = OF * both >= SIMILAR * (size[left][:, None] + size[right] - both)
                a, b = np.nonzero(near & (cid[left][:, None] != cid[right]))
                a, b = left[a], right[b]
                # A core class never seeks, so its links are counted from the other side.
                back = core[b]
                to, at = np.concatenate([a, b[back]]), np.concatenate([b, a[back]])
                # A class is here twice, once in each role; both are one row.
                names, where = np.unique(cid, return_inverse=True)
                links = np.bincount(where[to], copies[at], len(names)).astype(np.int64)
                n = np.bincount(where[to], minlength=len(names))
                label = linked(len(names), where[a], where[b])
                seen = np.flatnonzero(n)
                out.append((names[seen], names[label[seen]], links[seen], n[seen]))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in zip(*out)],
                    names=["cid", "other", "links", "text_links"],
                )

    outside = together(as_any.unionByName(as_outer), "component", "i", "j").mapInArrow(
        run, "cid long, other long, links long, text_links long"
    )
    return inside.unionByName(outside)


def _grouped(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): (doc_id, row_key, cid) of the texts with words, and each
    class's first row, copies, group and links."""
    embedded = materialize(embed(docs), "embedded")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key"))
    classes = materialize(
        embedded.groupBy("cid").agg(
            first.alias("rep"),
            F.count("*").alias("copies"),
            F.first("n").alias("n"),
            F.first("sketch").alias("sketch"),
            F.first("keys").alias("keys"),
        ),
        "classes",
    )
    leaves, edges = _leaves(classes)
    candidates = _candidates(leaves, classes)
    parts = components(candidates if edges is None else candidates.unionByName(edges))
    narrow = classes.select("cid", "rep", "copies", "n")
    inside = narrow.join(parts.withColumnRenamed("id", "cid"), "cid")
    size = inside.groupBy("component").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_SHINGLES)).alias("blocks")
    )
    members = inside.join(size, "component").select(
        "cid", "component", "copies", "blocks", "rep.row_key"
    )
    sets = materialize(_sets(materialize(members, "members"), docs), "sets")
    exact = materialize(_exact(sets), "exact")
    links = exact.groupBy("cid").agg(
        F.sum("links").alias("links"), F.sum("text_links").alias("text_links")
    )
    joined = components(
        exact.filter("cid <> other").select(F.col("cid").alias("a"), F.col("other").alias("b"))
    )
    named = narrow.join(joined.withColumnRenamed("id", "cid"), "cid", "left").select(
        "cid", "rep", "copies", F.coalesce("component", "cid").alias("component")
    )
    first = named.groupBy("component").agg(F.min("rep").alias("first"))
    named = named.join(first, "component").join(links, "cid", "left").drop("component")
    return embedded.select("doc_id", "row_key", "cid"), materialize(named, "named")


def jaccard_join(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, copy_of, n_links, n_text_links), a row per row of `docs`.

    Two documents are linked when the Jaccard similarity of their sets of
    SHINGLE-word shingles is at least SIMILAR / OF. `class_id` is the smallest
    doc_id that a document is connected to by links, `copy_of` the smallest with
    the same set, `n_links` the number of other documents it is linked to and
    `n_text_links` that of other sets. A null, empty or blank text has no
    shingle and no link, its class is its own id. A text of fewer than SHINGLE
    words is one shingle. Repeated rows are linked copies. Rows with a null
    doc_id are linked like others; a class of such rows only has a null class_id.
    One doc_id may have several texts. Other columns are not read.
    """
    rows, classes = _grouped(docs)
    found = rows.join(classes, "cid").select(
        "doc_id",
        F.col("first.doc_id").alias("class_id"),
        F.col("rep.doc_id").alias("copy_of"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("text_links", F.lit(0)).alias("n_text_links"),
    )
    blank = docs.filter(~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    none = F.lit(0).cast("long")
    return found.unionAll(
        blank.select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_of"), none, none)
    )


def select_first(docs: DataFrame) -> DataFrame:
    """The rows of `docs` without all but one document of each group of linked ones.

    The row with the smallest doc_id stays (null last, ties by a hash of id and
    text). Rows equal in doc_id and text stay once, with or without words; of
    rows that differ in other columns only, the one with the smallest hash of
    them. All columns are kept.
    """
    names = docs.columns
    rows, classes = _grouped(docs)
    dropped = rows.join(classes.select("cid", "first"), "cid").filter(
        F.col("row_key") != F.col("first.row_key")
    )
    # The whole rows move once: both steps go by one key.
    dropped = materialize(dropped.select("row_key").distinct(), "dropped")
    left = docs.select(F.struct(*names).alias("_row"), row_key()).join(
        dropped, "row_key", "left_anti"
    )
    others = F.to_json(F.struct(*[F.col("_row")[c] for c in names if c not in ("doc_id", "text")]))
    again = Window.partitionBy("row_key").orderBy(F.xxhash64(others))
    return left.withColumn("_n", F.row_number().over(again)).filter("_n = 1").select("_row.*")
