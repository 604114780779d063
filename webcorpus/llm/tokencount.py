"""Token counts of the documents in flat token files, by a separator scan.

A flat file is the tokens of many documents one after the other, as little-endian
numbers of `width` bytes, with an end-of-document token after each and no index.
It is read in blocks that are cut anywhere between two tokens. In each block all
separators are found by one vectorised comparison. A document that runs over
several blocks gets its length from a prefix scan over the blocks' tails, in two
levels, so that no task needs more than SCAN summaries of blocks at once.
"""

from __future__ import annotations

import base64
import importlib.util
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webcorpus.llm.texts import chunks
from webcorpus.session import ddl, materialize

#: Tokens in a block, and blocks in one step of the prefix scan.
BLOCK_TOKENS, SCAN = 1 << 18, 1_024
#: Folder of the public vocabularies; a name there; its free end-of-document id.
VOCABULARIES = "/opt/tokenizers"
VOCABULARY, END = "byte_bpe_50k.tiktoken", 50_256
#: Characters that are tokenised in one call; longer texts are cut at a blank.
PIECE = 100_000


def load_encoding(folder: str = VOCABULARIES, name: str = VOCABULARY):
    """The encoding of a rank file; its split pattern is given beside it as PATTERN."""
    import tiktoken

    spec = importlib.util.spec_from_file_location("vocabularies", os.path.join(folder, "__init__.py"))
    described = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(described)
    with open(described.path(name), "rb") as lines:
        ranks = {
            base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines)
        }
    return tiktoken.Encoding(
        "flat", pat_str=described.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def token_files(
    docs: DataFrame, folder: str = VOCABULARIES, name: str = VOCABULARY, end: int = END
) -> DataFrame:
    """(file, block, data, doc_ids): each task's texts as one flat file, in blocks.

    `data` are 2-byte tokens, BLOCK_TOKENS to a block but for a file's last. The
    separator is no token of the vocabulary, so no text can hold it. `doc_ids`
    are the documents that end in the block, in order: they are not part of the
    file, but tell afterwards which document is which. A null text is an empty
    document.
    """
    id_field = docs.schema["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load_encoding(folder, name)
        from pyspark import TaskContext

        file = TaskContext.get().partitionId()
        tokens: list[np.ndarray] = []
        ends: list[int] = []  # places of the separators from the start of the block
        ids: list = []
        held = block = 0
        id_type = pa.null()

        def row(data: np.ndarray, done: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([file], pa.int64()),
                    pa.array([block], pa.int64()),
                    pa.array([data.tobytes()], pa.binary()),
                    pa.array([done], pa.list_(id_type)),
                ],
                names=["file", "block", "data", "doc_ids"],
            )

        for rows, texts in chunks(batches):
            id_type = rows.column("doc_id").type
            for doc_id, text in zip(rows.column("doc_id").to_pylist(), texts):
                found: list[int] = []
                for piece in pieces(text):
                    found += encoding.encode_ordinary(piece)
                found.append(end)
                tokens.append(np.array(found, "<u2"))
                held += len(found)
                ends.append(held - 1)
                ids.append(doc_id)
                while held >= BLOCK_TOKENS:
                    whole = np.concatenate(tokens)
                    n = int(np.searchsorted(ends, BLOCK_TOKENS))
                    yield row(whole[:BLOCK_TOKENS], ids[:n])
                    block += 1
                    tokens, held = [whole[BLOCK_TOKENS:]], held - BLOCK_TOKENS
                    ends, ids = [e - BLOCK_TOKENS for e in ends[n:]], ids[n:]
        if held:
            yield row(np.concatenate(tokens), ids)

    return docs.select("doc_id", "text").mapInArrow(
        run,
        f"file long, block long, data binary, doc_ids array<{id_field.dataType.simpleString()}>",
    )


def pieces(text: str) -> Iterator[str]:
    """The text in parts of about PIECE characters, cut before a blank after a letter.

    The vocabularies' patterns start a word at its blank, so a cut there does not
    change the tokens. Without such a blank nearby the part gets longer.
    """
    start = 0
    while len(text) - start > PIECE:
        cut = start + PIECE
        while True:
            cut = text.find(" ", cut)
            if cut < 0 or cut + 1 >= len(text):
                break
            if text[cut - 1].isalpha() and text[cut + 1].isalpha():
                break
            cut += 1
        if cut < 0 or cut + 1 >= len(text):
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


def flat_blocks(files: DataFrame, width: int = 2) -> DataFrame:
    """(file, block, data) of binary files (path, content), cut into blocks of tokens."""
    size = BLOCK_TOKENS * width
    last = F.floor((F.octet_length("content") - 1) / size)
    cut = F.expr(f"substring(content, int(block * {size} + 1), {size})")
    return (
        files.filter(F.octet_length("content") > 0)
        .select("path", "content", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))
        .select(F.col("path").alias("file"), "block", cut.alias("data"))
    )


def separators(blocks: DataFrame, end: int = END, width: int = 2) -> DataFrame:
    """(file, block, n_tokens, ends, ...): places of the separators in each block."""
    kept = [f for f in blocks.schema.fields if f.name != "data"]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ends = [], []
            for data in batch.column("data").to_pylist():
                tokens = np.frombuffer(data or b"", f"<u{width}")
                sizes.append(len(tokens))
                ends.append(np.flatnonzero(tokens == end))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(n) for n in names],
                    pa.array(sizes, pa.int64()),
                    pa.array(ends, pa.list_(pa.int64())),
                ],
                names=[*names, "n_tokens", "ends"],
            )

    return blocks.mapInArrow(run, f"{ddl(kept)}, n_tokens long, ends array<long>")


def _scanned(summaries: DataFrame) -> DataFrame:
    """Add to (file, block, n_tokens, n_ends, tail) what the blocks before add up to.

    `carry` are the tokens since the last separator before the block, `ordinal`
    the separators and `offset` the tokens before it. Steps of SCAN blocks are
    summed first and scanned in turn; inside a step the scan starts from that.
    """
    step = F.floor(F.col("block") / SCAN)

    def prefix(rows: DataFrame, keys: list[str], order: str, names: list[str]) -> DataFrame:
        """Of the rows before: their tokens and separators, and the tokens up to the
        last separator (null without one)."""
        window = Window.partitionBy(*keys).orderBy(order)
        past = window.rowsBetween(Window.unboundedPreceding, -1)
        # The last of these is the greatest, as they count from the first row.
        upto = F.sum("n_tokens").over(window.rowsBetween(Window.unboundedPreceding, 0))
        closed = F.when(F.col("n_ends") > 0, upto - F.col("tail"))
        return rows.withColumn("_upto", closed).select(
            *keys,
            order,
            *names,
            F.coalesce(F.sum("n_tokens").over(past), F.lit(0)).alias("_done"),
            F.coalesce(F.sum("n_ends").over(past), F.lit(0)).alias("_ends"),
            F.max("_upto").over(past).alias("_closed"),
        )

    names = ["n_tokens", "n_ends", "tail"]
    steps = prefix(summaries.withColumn("step", step), ["file", "step"], "block", names)
    steps = materialize(steps, "scan")
    sums = steps.groupBy("file", "step").agg(
        F.sum("n_tokens").alias("n_tokens"),
        F.sum("n_ends").alias("n_ends"),
        F.max(
            F.when(F.col("n_ends") > 0, F.col("_done") + F.col("n_tokens") - F.col("tail"))
        ).alias("_end"),
    )
    sums = sums.withColumn("tail", F.col("n_tokens") - F.coalesce("_end", F.lit(0)))
    outer = prefix(sums, ["file"], "step", []).select(
        "file",
        "step",
        F.col("_done").alias("_step_done"),
        (F.col("_done") - F.coalesce("_closed", F.lit(0))).alias("_step_carry"),
        F.col("_ends").alias("_step_ends"),
    )
    joined = steps.join(outer, ["file", "step"])
    carry = F.when(F.col("_closed").isNotNull(), F.col("_done") - F.col("_closed")).otherwise(
        F.col("_step_carry") + F.col("_done")
    )
    return joined.select(
        "file",
        "block",
        carry.alias("carry"),
        (F.col("_step_ends") + F.col("_ends")).alias("ordinal"),
        (F.col("_step_done") + F.col("_done")).alias("offset"),
    )


def document_tokens(blocks: DataFrame, end: int = END, width: int = 2) -> DataFrame:
    """(file, ordinal, doc_id, first, n_tokens, closed): the documents of flat files.

    `blocks` are (file, block, data), numbered from 0 in each file without gaps,
    with `doc_ids` where they are known (else doc_id is null). `ordinal` counts a
    file's documents, `first` is a document's first token, `n_tokens` excludes
    the separator. Separators in a row are empty documents. Tokens after a
    file's last separator are a document that is not `closed`; nothing there is
    none. Empty files and null data hold no tokens. Other columns are not read.
    """
    known = "doc_ids" in blocks.columns
    wanted = ["file", "block", "data", *(["doc_ids"] if known else [])]
    found = materialize(separators(blocks.select(*wanted), end, width), "separators")
    n_ends = F.size("ends").cast("long")
    last = F.when(n_ends > 0, F.element_at("ends", -1) + 1).otherwise(0)
    summaries = found.select(
        "file", "block", "n_tokens", n_ends.alias("n_ends"), (F.col("n_tokens") - last).alias("tail")
    )
    scan = materialize(_scanned(summaries), "scan")
    placed = found.join(scan, ["file", "block"])
    doc_id = F.get("doc_ids", F.col("k")) if known else F.lit(None).cast("long")
    start: Column = F.when(F.col("k") == 0, -F.col("carry")).otherwise(
        F.get("ends", F.col("k") - 1) + 1
    )
    kept = ["file", "offset", "carry", "ordinal", "ends", *(["doc_ids"] if known else [])]
    closed = placed.select(*kept, F.posexplode("ends").alias("k", "at")).select(
        "file",
        (F.col("ordinal") + F.col("k")).alias("ordinal"),
        doc_id.alias("doc_id"),
        (F.col("offset") + start).alias("first"),
        (F.col("at") - start).alias("n_tokens"),
        F.lit(True).alias("closed"),
    )
    ended = F.when(n_ends > 0, last).otherwise(-F.col("carry"))
    totals = placed.groupBy("file").agg(
        F.max_by(
            F.struct(
                (F.col("ordinal") + n_ends).alias("ordinal"),
                (F.col("offset") + ended).alias("first"),
                (F.col("n_tokens") - ended).alias("n_tokens"),
            ),
            "block",
        ).alias("left")
    )
    none = F.lit(None).cast(closed.schema["doc_id"].dataType)
    open_ = totals.filter("left.n_tokens > 0").select(
        "file", "left.ordinal", none, "left.first", "left.n_tokens", F.lit(False)
    )
    return closed.unionAll(open_)


def count_tokens(docs: DataFrame, folder: str = VOCABULARIES) -> DataFrame:
    """`document_tokens` of the flat files that `token_files` makes of some texts."""
    return document_tokens(token_files(docs, folder))
