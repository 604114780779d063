"""Quality classifier: a sparse rule ensemble over text statistics.

Shallow boosted trees propose conjunctive rules (every path from a root to a
node), a lasso logistic regression keeps few of them, and the kept rules are
compiled into one Spark column expression, which scores every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcorpus.llm.quality import STATS as BASE
from webcorpus.llm.quality import base_stats
from webcorpus.llm.texts import WordHashes, chunks, flat_words
from webcorpus.session import ddl, materialize

#: Labelled documents that the rules are learnt from, at most.
MAX_LABELLED = 20_000
#: Labelled documents that rules can be learnt from, at least.
LEAST = 40
TREES, DEPTH, RATE, BINS = 16, 3, 0.3, 32
#: Weight of the lasso penalty, and its proximal gradient steps.
PENALTY, STEPS = 1e-3, 300
CUT = 0.7

STATS = (*BASE, "n_chars", "n_lines", "n_distinct", "n_bars", "n_stops", "n_commas")


def _rate(top: str, bottom: str) -> Column:
    return F.col(top) / F.greatest(F.col(bottom), F.lit(1))


def features() -> dict[str, Column]:
    """Inputs of the rules, as expressions over STATS."""
    return {
        "n_words": F.col("n_words").cast("double"),
        "word_length": _rate("word_chars", "n_words"),
        "symbols": _rate("n_symbols", "n_words"),
        "bars": _rate("n_bars", "n_words"),
        "dup_lines": _rate("n_dup_lines", "n_lines"),
        "repeated": _rate("n_repeat_words", "n_words"),
        "distinct": _rate("n_distinct", "n_words"),
        "stops": _rate("n_stops", "n_words"),
        "commas": _rate("n_commas", "n_words"),
        "line_words": _rate("n_words", "n_lines"),
        "blank": 1 - _rate("word_chars", "n_chars"),
    }


class Rule(NamedTuple):
    """Conjunction of (feature, is_above, threshold), with its weight."""

    terms: tuple[tuple[str, bool, float], ...]
    weight: float


class Model(NamedTuple):
    bias: float
    rules: list[Rule]


def text_stats(docs: DataFrame) -> DataFrame:
    """doc_id and STATS (all long) of every whole text; a null is an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordHashes(8)
        for rows, texts in chunks(batches):
            flat, bounds = flat_words(texts)
            made = base_stats(texts, flat, bounds, table.array(flat))
            cuts = zip(bounds[:-1].tolist(), bounds[1:].tolist())
            made["n_chars"] = list(map(len, texts))
            made["n_lines"] = [text.count("\n") + 1 for text in texts]
            made["n_distinct"] = [len(set(flat[a:b])) for a, b in cuts]
            for name, mark in (("n_bars", "|"), ("n_stops", "."), ("n_commas", ",")):
                made[name] = [text.count(mark) for text in texts]
            columns = [pa.array(made[c], pa.int64()) for c in STATS]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), *columns], names=["doc_id", *STATS]
            )

    source = docs.select("doc_id", "text")
    schema = f"{ddl([source.schema['doc_id']])}, " + ", ".join(f"{c} long" for c in STATS)
    return source.mapInArrow(run, schema)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """True for the documents whose label is never learnt from; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


# -- fitting, on at most MAX_LABELLED rows ---------------------------------------


def _grow(codes: np.ndarray, edges: list[np.ndarray], gradient, curve, names) -> tuple[list, np.ndarray]:
    """Nodes of one tree as rules' terms, and the tree's step for each row."""
    nodes, step = [], np.zeros(len(codes))

    def value(rows):
        return gradient[rows].sum() / (curve[rows].sum() + 1.0)

    def split(rows: np.ndarray, terms: tuple, depth: int) -> None:
        best = (1e-6, None, None)
        whole_g, whole_h = gradient[rows].sum(), curve[rows].sum()
        for j in range(codes.shape[1] if depth < DEPTH and len(rows) >= 20 else 0):
            n = len(edges[j]) + 1
            g = np.cumsum(np.bincount(codes[rows, j], gradient[rows], n))[:-1]
            h = np.cumsum(np.bincount(codes[rows, j], curve[rows], n))[:-1]
            if not len(g):
                continue
            gain = g**2 / (h + 1) + (whole_g - g) ** 2 / (whole_h - h + 1) - whole_g**2 / (whole_h + 1)
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], j, k)
        _, j, k = best
        if terms:
            nodes.append(terms)
        if j is None:
            step[rows] = value(rows)
            return
        above = codes[rows, j] > k
        for side in (False, True):
            term = (names[j], side, float(edges[j][k]))
            split(rows[above == side], (*terms, term), depth + 1)

    split(np.arange(len(codes)), (), 0)
    return nodes, step


def _simple(terms: tuple) -> tuple:
    """The same conjunction with one bound for each feature and side, in order."""
    bounds: dict[tuple[str, bool], float] = {}
    for name, above, edge in terms:
        pick = max if above else min
        bounds[name, above] = pick(edge, bounds.get((name, above), edge))
    return tuple(sorted((name, above, edge) for (name, above), edge in bounds.items()))


def fit(x: np.ndarray, y: np.ndarray, names: list[str]) -> Model:
    """Rules and weights from statistics `x` and labels `y` (0 or 1).

    Without rows the score is 0.5 everywhere; with one class, or fewer than LEAST
    rows, it is the smoothed share of label 1.
    """
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    bias = float(np.log(share / (1 - share)))
    if len(y) < LEAST or y.min() == y.max():
        return Model(bias, [])
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
    # Code k: above the first k edges.
    codes = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    margin, found = np.full(len(y), bias), {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        nodes, step = _grow(codes, edges, y - p, p * (1 - p), names)
        found.update(dict.fromkeys(map(_simple, nodes)))
        margin += RATE * step
    column = {name: x[:, j] for j, name in enumerate(names)}
    rules = list(found)
    z = np.ones((len(y), len(rules)))
    for k, terms in enumerate(rules):
        for name, above, edge in terms:
            z[:, k] *= (column[name] > edge) == above
    support = z.mean(0)
    scale = np.sqrt(np.maximum(support * (1 - support), 1e-4))
    z = (z - support) / scale
    # Accelerated proximal gradient; the bias is not penalised.
    rate = 4.0 * len(y) / np.linalg.norm(z, 2) ** 2
    w, ahead, b, t = np.zeros(len(rules)), np.zeros(len(rules)), bias, 1.0
    for _ in range(STEPS):
        error = 1 / (1 + np.exp(-(z @ ahead + b))) - y
        b -= 4 * error.mean()
        new = ahead - rate * (z.T @ error) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - rate * PENALTY, 0)
        t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead, w = new + (last - 1) / t * (new - w), new
    weights = w / scale
    return Model(
        float(b - (weights * support).sum()),
        [Rule(terms, float(v)) for terms, v in zip(rules, weights) if v],
    )


def learn(stats: DataFrame, labels: DataFrame, label: str, folds: int, fold: int) -> Model:
    """Fit on labelled rows outside the held-out fold.

    Of more than MAX_LABELLED rows those with the smallest hashes of doc_id are
    taken, so the sample is the same in every run. Rows without a 0 or 1 are no
    labels; an id that has several labels counts with its smallest, and one that
    has several texts with the one of the smallest statistics.
    """
    sample = (
        labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .filter(~held_out(F.col("doc_id"), folds, fold))
        .groupBy("doc_id")
        .agg(F.min(label).alias("_label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(MAX_LABELLED)
    )
    named = features()
    rows = (
        stats.join(F.broadcast(sample), "doc_id")
        .select("doc_id", "_label", *[c.alias(n) for n, c in named.items()])
        .groupBy("doc_id")
        # Of several texts under one id, one whole text counts.
        .agg(F.min("_label").alias("_label"), F.min(F.struct(*named)).alias("_x"))
        .select("doc_id", "_label", "_x.*")
        .orderBy("doc_id")
        .toPandas()
    )
    return fit(rows[list(named)].to_numpy(float), rows["_label"].to_numpy(float), list(named))


# -- scoring ----------------------------------------------------------------------


def compiled(model: Model) -> Column:
    """The model's probability as one column expression over STATS."""
    named = features()
    total = F.lit(model.bias)
    for rule in model.rules:
        holds = F.lit(True)
        for name, above, edge in rule.terms:
            holds = holds & (named[name] > edge if above else named[name] <= edge)
        total = total + F.when(holds, rule.weight).otherwise(0.0)
    return 1 / (1 + F.exp(-total))


def classify(docs: DataFrame, labels: DataFrame, folds: int = 4, fold: int = 2) -> DataFrame:
    """(doc_id, held_out, score, predicted), a row for each row of `docs`.

    Empty and null texts have statistics of 0 and are scored like any other;
    repeated rows get the same score; other columns are not read. Texts are read
    once: the statistics are stored and the rest works on them.
    """
    stats = materialize(text_stats(docs), "stats")
    score = compiled(learn(stats, labels, "quality", folds, fold))
    return stats.select(
        "doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), score.alias("score")
    ).withColumn("predicted", (F.col("score") >= CUT).cast("int"))
