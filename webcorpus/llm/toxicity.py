"""Toxicity: a bidirectional gated recurrent network with attention pooling.

A word's input joins an embedding of the word with the mean of embeddings of its
character trigrams. Windows of WINDOW words, each starting STRIDE after the one
before, run through a gated recurrent unit in both directions; attention pools
the states, and a logistic unit gives the window's logit. A document is as toxic
as its worst window; the final probability is a logistic curve over that logit,
fitted on the training documents.

Only documents are labelled. So windows take their document's label at first;
later, in toxic documents, those the network finds clean are relabelled, but for
the worst one. The network is trained with numpy on all windows of a sample that
is bounded in documents, and broadcast; scoring is one pass over all texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.llm.rules import held_out
from webcorpus.llm.texts import WordHashes, chunks, words_of
from webcorpus.session import ddl

WINDOW, STRIDE = 32, 16
#: Labelled documents of each class that are learnt from at most, with all their windows.
MAX_PER_CLASS = 1_500
#: Labelled documents that the network can be trained on, at least.
LEAST = 20
WORD_ROWS, CHAR_ROWS, WORD_DIM, CHAR_DIM, HIDDEN, ATTENTION = 8_192, 4_096, 6, 8, 8, 8
#: Training: rounds over the windows at most, steps in all unless LEAST_ROUNDS over
#: all windows take more, rows of a step, rate.
ROUNDS, LEAST_ROUNDS, STEPS, BATCH, RATE = 25, 2, 300, 256, 0.015
#: Share of word embeddings left out in a step, so that spelling counts too; and
#: the decay of both embeddings.
DROPPED, DECAY = 0.5, 0.02
#: Every so many training documents one is kept for the final curve.
CURVE_EVERY = 4
SCORE_BATCH = 1_024
#: Input to the update gate that leaves the state as it is.
SHUT = 1e4
CUT = 0.5
#: Parts that the sample's texts reach the driver in.
PARTS = 8
#: Words whose inputs a task remembers.
REMEMBERED = 150_000
#: Cut from both ends of a word, which is read in lower case.
MARKS = ".,;:!?\"'()[]"

Parameters = dict[str, np.ndarray]


class Model(NamedTuple):
    """Network, and the curve slope * logit + bias; `lowest` is for empty texts."""

    network: Parameters | None
    slope: float
    bias: float
    lowest: float


class Windows(NamedTuple):
    """Windows as runs of word numbers: where each starts in `ids`, its words, its text."""

    ids: np.ndarray
    first: np.ndarray
    size: np.ndarray
    owner: np.ndarray


class Lexicon:
    """Rows of embedding tables that words take their inputs from."""

    def __init__(self):
        self.hashes = WordHashes(8)

    def rows(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word row of each word; its trigrams' rows, all in a line, with their bounds."""
        plain = [w.lower().strip(MARKS) or w for w in words]
        word = (self.hashes.array(plain) % np.uint64(WORD_ROWS)).astype(np.int64)
        # Each word between marks has as many trigrams as characters.
        points = np.frombuffer(
            "".join(f"\x02{w}\x03" for w in plain).encode("utf-32-le", "surrogatepass"), "<u4"
        ).astype(np.uint64)
        sizes = np.fromiter(map(len, plain), np.int64, len(plain))
        mixed = (
            points[:-2] * np.uint64(0x9E3779B1)
            + points[1:-1] * np.uint64(0x85EBCA77)
            + points[2:] * np.uint64(0xC2B2AE3D27)
        )
        mixed ^= mixed >> np.uint64(17)
        starts = np.cumsum(sizes + 2) - sizes - 2
        bounds = np.zeros(len(plain) + 1, np.int64)
        np.cumsum(sizes, out=bounds[1:])
        place = np.repeat(starts - bounds[:-1], sizes) + np.arange(bounds[-1])
        return word, (mixed[place] % np.uint64(CHAR_ROWS)).astype(np.int64), bounds


def inputs(p: Parameters, word: np.ndarray, chars: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    mean = np.add.reduceat(p["chars"][chars], bounds[:-1]) / np.diff(bounds)[:, None]
    return np.concatenate([p["words"][word], mean], axis=1).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def new_network(rng: np.random.Generator) -> Parameters:
    def draw(*shape, scale):
        return rng.normal(0, scale, shape).astype(np.float32)

    d, h = WORD_DIM + CHAR_DIM, HIDDEN
    return {
        "words": draw(WORD_ROWS, WORD_DIM, scale=0.1),
        "chars": draw(CHAR_ROWS, CHAR_DIM, scale=0.3),
        "W": draw(2, d, 3 * h, scale=d**-0.5),
        "b": np.zeros((2, 1, 3 * h), np.float32),
        "U": draw(2, h, 3 * h, scale=h**-0.5),
        "A": draw(2 * h, ATTENTION, scale=(2 * h) ** -0.5),
        "v": draw(ATTENTION, scale=0.5),
        "w": draw(2 * h, scale=0.5),
        "c": np.zeros(1, np.float32),
    }


def run_windows(
    p: Parameters, gates: np.ndarray, ids: np.ndarray, pad: int | None = None
) -> tuple[np.ndarray, dict]:
    """Logits of windows `ids` (rows of word numbers), and what the gradient needs.

    `gates` (2, words, 3 * HIDDEN) are the words' inputs to the gates in both
    directions. Direction 1 reads a window from its end. Short windows end with
    the word `pad`, whose gates are `SHUT` and which gets no attention.
    """
    n, length = ids.shape
    h = HIDDEN
    across = np.ascontiguousarray(ids.T)
    state = np.zeros((2, n, h), np.float32)
    states = np.empty((length, n, 2 * h), np.float32)
    steps = []
    for t in range(length):
        x = np.stack([gates[0][across[t]], gates[1][across[length - 1 - t]]])
        own = state @ p["U"]
        zr = _sigmoid(x[..., : 2 * h] + own[..., : 2 * h])
        z, r = zr[..., :h], zr[..., h:]
        new = np.tanh(x[..., 2 * h :] + r * own[..., 2 * h :])
        steps.append((state, z, r, own[..., 2 * h :], new))
        state = new + z * (state - new)
        states[t, :, :h] = state[0]
        states[length - 1 - t, :, h:] = state[1]
    hidden = np.tanh(states @ p["A"])
    energy = hidden @ p["v"]
    if pad is not None:
        energy[across == pad] = -np.inf
    share = np.exp(energy - energy.max(0))
    share /= share.sum(0)
    pooled = (share[..., None] * states).sum(0)
    logit = pooled @ p["w"] + p["c"]
    return logit, {
        "across": across, "steps": steps, "states": states, "hidden": hidden,
        "share": share, "pooled": pooled,
    }


def gradients(p: Parameters, k: dict, error: np.ndarray, n_words: int) -> tuple[dict, np.ndarray]:
    """Of the loss with d loss / d logit = `error`: parameters', and the gates' of each word."""
    h, length = HIDDEN, len(k["states"])
    g = {"w": k["pooled"].T @ error, "c": error.sum(keepdims=True)}
    d_pooled = error[:, None] * p["w"]
    d_share = (k["states"] * d_pooled).sum(-1)
    d_energy = k["share"] * (d_share - (k["share"] * d_share).sum(0))
    d_hidden = d_energy[..., None] * p["v"] * (1 - k["hidden"] ** 2)
    g["v"] = np.einsum("tn,tna->a", d_energy, k["hidden"])
    g["A"] = np.einsum("tns,tna->sa", k["states"], d_hidden)
    d_states = k["share"][..., None] * d_pooled + d_hidden @ p["A"].T
    g["U"] = np.zeros_like(p["U"])
    d_gates = np.zeros((2, n_words, 3 * h), np.float32)
    back = np.zeros_like(k["steps"][0][0])
    u_t = p["U"].transpose(0, 2, 1)
    for t in reversed(range(length)):
        before, z, r, m, new = k["steps"][t]
        d = back + np.stack([d_states[t, :, :h], d_states[length - 1 - t, :, h:]])
        d_new = d * (1 - z) * (1 - new**2)
        d_z = d * (before - new) * z * (1 - z)
        d_r = d_new * m * r * (1 - r)
        own = np.concatenate([d_z, d_r, d_new * r], axis=-1)
        back = d * z + own @ u_t
        g["U"] += before.transpose(0, 2, 1) @ own
        d_x = np.concatenate([d_z, d_r, d_new], axis=-1)
        np.add.at(d_gates[0], k["across"][t], d_x[0])
        np.add.at(d_gates[1], k["across"][length - 1 - t], d_x[1])
    return g, d_gates


def step(p: Parameters, lexicon: tuple, ids: np.ndarray, target, weight, rng) -> dict:
    """Gradients of the mean weighted log loss of some windows.

    The number after the last word fills up short windows.
    """
    word, chars, bounds = lexicon
    used, own = np.unique(ids, return_inverse=True)
    used = used[used < len(word)]
    sizes = np.diff(bounds)[used]
    own_bounds = np.zeros(len(used) + 1, np.int64)
    np.cumsum(sizes, out=own_bounds[1:])
    own_chars = chars[np.repeat(bounds[used] - own_bounds[:-1], sizes) + np.arange(own_bounds[-1])]
    x = inputs(p, word[used], own_chars, own_bounds)
    there = (rng.random((len(used), 1)) >= DROPPED) / np.float32(1 - DROPPED)
    x[:, :WORD_DIM] *= there
    shut = np.zeros((2, 1, 3 * HIDDEN), np.float32)
    shut[..., :HIDDEN] = SHUT
    gates = np.concatenate([x @ p["W"] + p["b"], shut], axis=1)
    logit, kept = run_windows(p, gates, own.reshape(ids.shape), len(used))
    error = ((_sigmoid(logit) - target) * weight / len(ids)).astype(np.float32)
    g, d_gates = gradients(p, kept, error, len(used) + 1)
    d_gates = d_gates[:, :-1]
    g["W"] = x.T @ d_gates
    g["b"] = d_gates.sum(1, keepdims=True)
    d_x = (d_gates @ p["W"].transpose(0, 2, 1)).sum(0)
    g["words"] = np.zeros_like(p["words"])
    np.add.at(g["words"], word[used], d_x[:, :WORD_DIM] * there)
    g["chars"] = np.zeros_like(p["chars"])
    each = d_x[:, WORD_DIM:] / sizes[:, None]
    np.add.at(g["chars"], own_chars, np.repeat(each, sizes, axis=0))
    return g


def logits(p: Parameters, gates: np.ndarray, windows: Windows) -> np.ndarray:
    """Of windows of any length; those of one length run together."""
    out = np.zeros(len(windows.first), np.float32)
    for size in np.unique(windows.size):
        rows = np.flatnonzero(windows.size == size)
        for k in range(0, len(rows), SCORE_BATCH):
            some = rows[k : k + SCORE_BATCH]
            ids = windows.ids[windows.first[some, None] + np.arange(size)]
            out[some] = run_windows(p, gates, ids)[0]
    return out


def starts(n_words: int) -> np.ndarray:
    """First words of a text's windows; the last window ends with the text."""
    if n_words <= WINDOW:
        return np.zeros(min(n_words, 1), np.int64)
    return np.append(np.arange(0, n_words - WINDOW, STRIDE), n_words - WINDOW)


def windows_of(texts: list[np.ndarray]) -> Windows:
    """All windows of some texts, which are word numbers."""
    ids = np.concatenate([np.zeros(0, np.int32), *texts])
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = [starts(n) for n in lengths]
    owner = np.repeat(np.arange(len(texts)), np.fromiter(map(len, begins), np.int64, len(texts)))
    first = np.concatenate([np.zeros(0, np.int64), *begins])
    size = np.minimum(lengths[owner] - first, WINDOW)
    return Windows(ids, first + (np.cumsum(lengths) - lengths)[owner], size, owner)


def train(windows: list[list[str]], owner: np.ndarray, toxic: np.ndarray) -> Model:
    """`learn` from windows of words; `owner` is each window's document, in order."""
    numbers: dict[str, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for x in windows for w in x], np.int32)
    size = np.fromiter(map(len, windows), np.int64, len(windows))
    return learn(list(numbers), Windows(ids, np.cumsum(size) - size, size, owner), toxic)


def learn(
    words: list[str], windows: Windows, toxic: np.ndarray, stands: np.ndarray | None = None
) -> Model:
    """`words` are those that the windows have numbers of; `toxic` the documents' labels.

    `stands` is how many labelled documents each one stands for, so that the curve
    has the classes' true shares however large the sample; one each by default.
    Without both classes, or with fewer than LEAST documents, the score is the
    smoothed share of toxic documents.
    """
    stands = np.ones(len(toxic)) if stands is None else stands
    share = ((stands * toxic).sum() + 0.5) / (stands.sum() + 1.0)
    prior = float(np.log(share / (1 - share)))
    if len(toxic) < LEAST or toxic.min() == toxic.max():
        return Model(None, 0.0, prior, 0.0)
    rng = np.random.default_rng(7)
    owner = windows.owner
    lexicon = Lexicon().rows(words)
    learnt = np.arange(len(toxic)) % CURVE_EVERY > 0
    used = np.flatnonzero(learnt[owner])
    target = toxic[owner[used]].astype(np.float32)
    p = new_network(rng)
    mean = {n: np.zeros_like(v) for n, v in p.items()}
    square = {n: np.zeros_like(v) for n, v in p.items()}
    done = 0
    batches = -(-len(used) // BATCH)
    total = min(max(STEPS, LEAST_ROUNDS * batches), ROUNDS * batches)

    def all_logits() -> np.ndarray:
        return logits(p, inputs(p, *lexicon) @ p["W"] + p["b"], windows)

    def padded(some: np.ndarray) -> np.ndarray:
        place = np.arange(WINDOW)
        inside = place < windows.size[some, None]
        at = windows.first[some, None] + np.where(inside, place, 0)
        return np.where(inside, windows.ids[at], len(words))

    while done < total:
        if done >= total // 3:  # relabel the clean windows of toxic documents
            found = all_logits()
            worst = np.full(len(toxic), -np.inf)
            np.maximum.at(worst, owner, found)
            bad = (found > 0) | (found >= worst[owner])
            target = (toxic[owner[used]] & bad[used]).astype(np.float32)
        balance = np.where(target > 0, 0.5 / max(target.mean(), 1e-3), 0.5 / max(1 - target.mean(), 1e-3))
        weight = np.minimum(balance, 4.0).astype(np.float32)
        order = rng.permutation(len(used))
        for k in range(0, len(order), BATCH):
            some = order[k : k + BATCH]
            grads = step(p, lexicon, padded(used[some]), target[some], weight[some], rng)
            done += 1
            rate = RATE * (1 - 0.8 * done / total) * np.sqrt(1 - 0.999**done) / (1 - 0.9**done)
            for n, g in grads.items():
                mean[n] += 0.1 * (g - mean[n])
                square[n] += 0.001 * (g * g - square[n])
                p[n] -= (rate * mean[n] / (np.sqrt(square[n]) + 1e-8)).astype(np.float32)
                if n in ("words", "chars"):
                    p[n] *= 1 - RATE * DECAY
            if done >= total:
                break
    found = all_logits()
    lowest = float(found.min()) if len(found) else 0.0
    worst = np.full(len(toxic), -np.inf)
    np.maximum.at(worst, owner, found)
    worst[~np.isfinite(worst)] = lowest
    kept = ~learnt if toxic[~learnt].any() else np.ones(len(toxic), bool)
    # The curve over the worst window's logit, by Newton's method with a small ridge.
    coef = np.array([1.0, 0.0])
    x, y = np.stack([worst, np.ones_like(worst)], axis=1)[kept], toxic[kept]
    each = stands[kept]
    for _ in range(30):
        q = _sigmoid(x @ coef)
        slope = x.T @ (each * (q - y)) + 1e-2 * (coef - [1.0, 0.0])
        curve = (x * (each * q * (1 - q))[:, None]).T @ x + 1e-2 * np.eye(2)
        coef = coef - np.clip(np.linalg.solve(curve, slope), -1, 1)
    return Model(p, float(max(coef[0], 1e-3)), float(coef[1]), lowest)


def training_texts(
    docs: DataFrame, labels: DataFrame, folds: int, fold: int
) -> tuple[list[str], Windows, np.ndarray, np.ndarray]:
    """The words, all windows and the labels of the bounded sample, and how many
    labelled documents each of its documents stands for.

    Of each class the MAX_PER_CLASS labelled documents with the smallest hashes
    of doc_id are taken, held-out ones excepted, with their whole texts. The
    texts reach the driver a part at a time and become word numbers as they come;
    only these are held together.
    """
    known = (
        labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .filter(~held_out(F.col("doc_id"), folds, fold))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("_toxic"))
    )
    many = np.zeros(2)
    for row in known.groupBy("_toxic").count().collect():
        many[row["_toxic"]] = row["count"]
    parts = [
        known.filter(F.col("_toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_PER_CLASS)
        for c in (0, 1)
    ]
    sample = F.broadcast(parts[0].unionAll(parts[1]))
    chosen = docs.select("doc_id", "text").join(sample, "doc_id")
    whole = chosen.groupBy("doc_id").agg(
        F.max("_toxic").alias("toxic"), F.max("text").alias("text")
    )
    numbers: dict[str, int] = {}
    rows = []
    for row in whole.coalesce(PARTS).toLocalIterator():
        words = words_of(row["text"] or "")
        ids = (numbers.setdefault(w, len(numbers)) for w in words)
        rows.append((row["doc_id"], row["toxic"], np.fromiter(ids, np.int32, len(words))))
    # In order of doc_id, words in order of their first place, whatever came first.
    rows.sort(key=lambda row: row[0])
    flat = np.concatenate([np.zeros(0, np.int32), *[ids for _, _, ids in rows]])
    used, first = np.unique(flat, return_index=True)
    order = used[np.argsort(first)]
    place = np.zeros(len(numbers), np.int32)
    place[order] = np.arange(len(order))
    names = list(numbers)
    toxic = np.array([label for _, label, _ in rows], np.int64)
    stands = np.maximum(many / MAX_PER_CLASS, 1.0)[toxic]
    return [names[k] for k in order], windows_of([place[ids] for _, _, ids in rows]), toxic, stands


class Scorer:
    """Probabilities of texts; the inputs of words seen are remembered, up to a bound."""

    def __init__(self, model: Model):
        self.model, self.lexicon = model, Lexicon()
        self.numbers: dict[str, int] = {}
        self.gates = np.zeros((2, 1024, 3 * HIDDEN), np.float32)

    def _learn(self, words: list[str]) -> None:
        p, n = self.model.network, len(self.numbers)
        while n + len(words) > self.gates.shape[1]:
            self.gates = np.concatenate([self.gates, np.zeros_like(self.gates)], axis=1)
        self.gates[:, n : n + len(words)] = (
            inputs(p, *self.lexicon.rows(words)) @ p["W"] + p["b"]
        )
        self.numbers.update(zip(words, range(n, n + len(words))))

    def scores(self, texts: list[str]) -> np.ndarray:
        model = self.model
        worst = np.full(len(texts), model.lowest)
        if model.network is not None:
            if len(self.numbers) > REMEMBERED:
                self.numbers.clear()
            numbered = []
            for text in texts:
                words = words_of(text)
                if unseen := [w for w in dict.fromkeys(words) if w not in self.numbers]:
                    self._learn(unseen)
                numbered.append(
                    np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words))
                )
            windows = windows_of(numbered)
            top = np.full(len(texts), -np.inf)
            np.maximum.at(top, windows.owner, logits(model.network, self.gates, windows))
            worst = np.where(np.isfinite(top), top, worst)
        return _sigmoid(model.slope * worst + model.bias)


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score): every window of every whole text is scored."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for rows, texts in chunks(batches):
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(scorer.scores(texts).astype(float))],
                names=["doc_id", "score"],
            )

    source = docs.select("doc_id", "text")
    return source.mapInArrow(run, f"{ddl([source.schema['doc_id']])}, score double")


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0) -> DataFrame:
    """(doc_id, held_out, score, predicted), a row for each row of `docs`.

    Null and empty texts have no window and take the lowest logit seen in
    training; repeated rows get the same score; other columns are not read.
    Without labels of both classes, or with fewer than LEAST labelled documents,
    all scores are the share of toxic labels.
    """
    model = learn(*training_texts(docs, labels, folds, fold))
    return score_texts(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id"), folds, fold).alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )
