"""Mixing sources to target weights by pivotal dependent rounding.

A source's documents are to be copied `target / source_size` times on average.
The whole part of that is given to every document. The fractional parts are
rounded in pairs: words move at random from one document's fraction to the
other's until one of them is 0 or 1, so a source's words stay the same in every
step and each document keeps its expected copies. Pairs are made in blocks of
about BLOCK documents; each block leaves one residual, and the residuals of
BLOCK blocks are paired in the next level, up to one residual for a source. That
one is rounded to the nearer side, so a source's words miss its target by half a
document at most.

Everything is a DataFrame expression. The draws are hashes of the seed and the
documents, so that reruns and repeated tasks agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webcorpus.functions.text import let
from webcorpus.llm.ranks import numbered
from webcorpus.llm.texts import WORD
from webcorpus.session import materialize

#: Documents or residuals that are paired in one row.
BLOCK = 64
#: A document is copied so often, and a source grows by so much, at most.
MOST = 3
#: Weights of the sources in order, repeated.
WEIGHTS = (1, 2, 3)
SEED = 20
#: Fractions nearer than this to 0 or 1 are whole.
NEAR = 1e-9


def n_words(text: Column) -> Column:
    """Words of a text, 0 for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _draw(*keys: Column) -> Column:
    """Number from 0 to 1 (excluded) that depends on the keys alone."""
    return F.pmod(F.xxhash64(F.lit(SEED), *keys), F.lit(1 << 48)) / F.lit(float(1 << 48))


def source_targets(sources: DataFrame) -> DataFrame:
    """Add `weight` and `target` to (source, source_size, ...), one row per source.

    Sources in order of their code points, null last, take WEIGHTS in turn. All
    words are shared by weight; a target stops at MOST times its source's size,
    and what that leaves is shared by weight among the others until none is
    above. Sources without words get 0.
    """
    ranked = numbered(sources, F.col("source").asc_nulls_last(), "_rank")
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    weighted = materialize(
        ranked.withColumn(
            "weight", F.get(weights, (F.col("_rank") % len(WEIGHTS)).cast("int"))
        ).drop("_rank"),
        "weights",
    )
    cap = F.col("source_size") * MOST
    total, weight = weighted.agg(F.sum("source_size"), F.sum("weight")).first()
    level, n_full = (total or 0) / (weight or 1), 0
    # Each round is one small aggregate. The level only rises, so sources that
    # are full stay full and the rounds end.
    while True:
        full = cap <= F.col("weight") * F.lit(level)
        used, open_weight, n = weighted.agg(
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
            F.count(F.when(full, True)),
        ).first()
        if n == n_full or not open_weight:
            break
        level, n_full = (total - used) / open_weight, n
    share = F.col("weight") * F.lit(level)
    return weighted.withColumn("target", F.least(share, cap.cast("double")))


def _settle(a: Column, b: Column) -> Column:
    """(done, carry) of two fractions: words move until one is 0 or 1."""
    ratio = a["size"] / b["size"]
    bounds = F.struct(
        ratio.alias("ratio"),
        F.least(1 - a["p"], b["p"] / ratio).alias("up"),
        F.least(a["p"], (1 - b["p"]) / ratio).alias("down"),
    )
    draw = _draw(a["doc_id"], a["size"], b["doc_id"], b["size"])

    def moved(x: Column) -> Column:
        step = F.when(draw * (x["up"] + x["down"]) < x["down"], x["up"]).otherwise(-x["down"])
        return let(
            step,
            lambda s: F.struct(
                a.withField("p", a["p"] + s).alias("a"),
                b.withField("p", b["p"] - s * x["ratio"]).alias("b"),
            ),
        )

    def whole(item: Column) -> Column:
        return (item["p"] <= NEAR) | (item["p"] >= 1 - NEAR)

    def result(pair: Column) -> Column:
        both = F.array(pair["a"], pair["b"])
        return F.struct(
            F.filter(both, whole).alias("done"),
            F.get(F.filter(both, lambda item: ~whole(item)), F.lit(0)).alias("carry"),
        )

    return let(let(bounds, moved), result)


def _pair_up(items: Column, item_type: str) -> Column:
    """(done, carry) of a row's items, taken in their order."""
    start = F.struct(
        F.lit(None).cast(f"array<{item_type}>").alias("done"),
        F.lit(None).cast(item_type).alias("carry"),
    )
    start = start.withField("done", F.array().cast(f"array<{item_type}>"))

    def step(state: Column, item: Column) -> Column:
        alone = F.struct(state["done"].alias("done"), item.alias("carry"))
        together = let(
            _settle(state["carry"], item),
            lambda s: F.struct(
                F.concat(state["done"], s["done"]).alias("done"), s["carry"].alias("carry")
            ),
        )
        return F.when(state["carry"].isNull(), alone).otherwise(together)

    return F.aggregate(items, start, step)


def decide(units: DataFrame, sources: DataFrame) -> DataFrame:
    """Copies of every unit: (doc_id, source, size, m, copies, source_size, target).

    `units` has distinct (doc_id, source, size) and their number of equal rows
    `m`; `copies` are those of all m rows together.
    """
    keys = ["source", "source_size", "target"]
    pace = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    mass = F.col("m") * pace
    known = sources.select(
        F.col("source").alias("_source"),
        "source_size",
        "target",
        F.ceil(F.col("n_units") / BLOCK).alias("_blocks"),
    )
    shares = units.join(known, F.col("source").eqNullSafe(F.col("_source"))).select(
        *keys,
        "doc_id",
        "size",
        "m",
        F.floor(mass).alias("whole"),
        (mass - F.floor(mass)).alias("p"),
        F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "size"), "_blocks").alias("block"),
    )
    shares = materialize(shares, "shares")
    open_ = (F.col("p") > NEAR) & (F.col("p") < 1 - NEAR) & (F.col("size") > 0)
    item = F.struct("size", F.xxhash64("doc_id").alias("h"), "doc_id", "m", "whole", "p")
    waiting = shares.filter(open_).select(*keys, "block", item.alias("item"))
    item_type = waiting.schema["item"].dataType.simpleString()
    settled = [shares.filter(~open_).select(*keys, item.alias("item"))]
    blocks = sources.agg(F.max(F.ceil(F.col("n_units") / BLOCK))).first()[0] or 1
    while True:
        # From large to small: a large document's fraction is filled up or used
        # up by the small ones after it, so that what is left at the end is small.
        level = materialize(
            waiting.groupBy(*keys, "block")
            .agg(F.reverse(F.array_sort(F.collect_list("item"))).alias("items"))
            .select(*keys, "block", _pair_up(F.col("items"), item_type).alias("state")),
            "paired",
        )
        settled.append(level.select(*keys, F.explode("state.done").alias("item")))
        left = level.filter(F.col("state.carry").isNotNull())
        if blocks <= 1:
            break
        blocks = -(-blocks // BLOCK)
        waiting = left.select(
            *keys, F.floor(F.col("block") / BLOCK).alias("block"), F.col("state.carry").alias("item")
        )
    last = F.col("state.carry")
    up = (last["p"] >= 0.5).cast("double")
    settled.append(left.select(*keys, last.withField("p", up).alias("item")))
    out = settled[0]
    for more in settled[1:]:
        out = out.unionAll(more)
    copies = F.col("item.whole") + F.when(F.col("item.p") >= 0.5, 1).otherwise(0)
    return out.select(
        *keys, "item.doc_id", "item.size", "item.m", copies.cast("long").alias("copies")
    )


def _own_copies(number: Column) -> Column:
    """Of a unit's copies, those of its row with this 0-based number."""
    each = F.floor(F.col("copies") / F.col("m"))
    return (each + (number < F.col("copies") % F.col("m")).cast("long")).cast("long")


def _decided(docs: DataFrame) -> DataFrame:
    sizes = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"))
    units = materialize(
        sizes.groupBy("doc_id", "source", "size").agg(F.count("*").alias("m")), "units"
    )
    sources = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("m")).alias("source_size"), F.count("*").alias("n_units")
    )
    return decide(units, materialize(source_targets(sources), "targets"))


def mix(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken), a row per document.

    `size` is the number of words, 0 for a null or empty text; such a document
    takes no words. Null sources are one source, the last. Equal rows (doc_id,
    source and size) share their copies as evenly as can be. Rows with a null
    doc_id are documents as any other. Other columns of `docs` are not read; an
    empty table gives an empty result.
    """
    return (
        _decided(docs)
        .withColumn("_number", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)))
        .withColumn("copies", _own_copies(F.col("_number")))
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            "copies",
            (F.col("copies") * F.col("size")).alias("taken"),
        )
    )


def take_mix(docs: DataFrame) -> DataFrame:
    """The mix itself: each row of `docs` as often as the mix takes it.

    `copy` counts a row's copies from 1; it replaces a column of that name. The
    decisions are joined by narrow keys, so a text moves once. Which of several
    rows of one id, source and size is taken more often follows from a hash of
    the whole row, so a repeat gives the same.
    """
    names = [c for c in docs.columns if c != "copy"]

    def key(name: str) -> Column:
        return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit(""))

    decided = materialize(_decided(docs), "decided").select(
        key("doc_id").alias("_doc"), key("source").alias("_src"), F.col("size").alias("_size"),
        "m", "copies",
    )
    rows = docs.select(
        F.struct(*names).alias("_row"),
        key("doc_id").alias("_doc"),
        key("source").alias("_src"),
        n_words(F.col("text")).alias("_size"),
        F.xxhash64("text").alias("_text"),
        F.xxhash64(F.to_json(F.struct(*[c for c in names if c != "text"]))).alias("_rest"),
    )
    keys = ["_doc", "_src", "_size"]
    # Rows of one id, source and size take their copies in an order of their own.
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("_text", "_rest")) - 1
    return (
        rows.join(decided, keys)
        .withColumn("_taken", _own_copies(number))
        .filter("_taken > 0")
        .select("_row", F.explode(F.sequence(F.lit(1), F.col("_taken").cast("int"))).alias("copy"))
        .select("_row.*", "copy")
    )
