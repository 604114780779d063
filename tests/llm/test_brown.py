"""Class-based scores against plain loops, and what the classes are worth."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from webcorpus.llm import brown as B

CLASSES, TOP, TURNS = 3, 14, 6


def texts(n, seed=5):
    """Two languages of three kinds of words that follow each other in order."""
    random.seed(seed)
    kinds = {
        lang: [[f"{lang}{kind}{k}" for k in range(6)] for kind in "xyz"] for lang in ("A", "b")
    }
    out = []
    for _ in range(n):
        lang = random.choice("Ab")
        words = [
            random.choices(kinds[lang][k % 3], [9, 5, 3, 2, 1, 1])[0] for k in range(random.randint(3, 40))
        ]
        if random.random() < 0.2:
            words.insert(random.randrange(len(words)), f"once{random.randrange(10**6)}")
        out.append(" ".join(words))
    return out


def plain_tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + ["\n"]


def plain(rows, classes=CLASSES, top=TOP, turns=TURNS):
    """Every step in plain loops, the likelihood from scratch for every move."""
    docs = [(i, i is not None and zlib.crc32(str(i).encode()) % 7 == 2, plain_tokens(t)) for i, t in rows]
    number = lambda w: B.word_number(w.encode())
    train = [("\n", *t) for _, held, t in docs if not held]
    counts = Counter(w for t in train for w in t[1:])
    n, v = sum(counts.values()), len(counts)
    ranked = sorted(counts, key=lambda w: (-counts[w], number(w)))[: min(top, max(v, 1))]
    if "\n" not in ranked:
        ranked = ranked[: min(top, max(v, 1)) - 1] + ["\n"]
    pairs = Counter(p for t in train for p in zip(t, t[1:]))
    inside = {p: c for p, c in pairs.items() if p[0] in ranked and p[1] in ranked}

    def matrix(of):
        out = np.zeros((classes, classes))
        for (a, b), c in inside.items():
            out[of[a], of[b]] += c
        return out

    of = {w: k % classes for k, w in enumerate(ranked)}
    for turn in range(turns):
        now, moves = B.likelihood(matrix(of)), []
        for k, w in enumerate(ranked):
            if k % B.EVERY == turn % B.EVERY:
                gain = [B.likelihood(matrix({**of, w: c})) - now for c in range(classes)]
                best = int(np.argmax(np.round(gain, 9)))
                if gain[best] > 1e-6:
                    moves.append((-round(gain[best], 6), k, w, best))
        moves.sort()
        while moves:
            tried = {**of, **{w: c for _, _, w, c in moves}}
            if B.likelihood(matrix(tried)) > now:
                of = tried
                break
            moves = moves[: len(moves) // 2]
    m = matrix(of)
    after, before = m + 0.5, m + 0.5
    for w in counts:
        if w in ranked:
            continue
        score, seen = np.zeros(classes), False
        for (a, b), c in pairs.items():
            if a == w and b in ranked:
                seen = True
                score += c * (np.log(after[:, of[b]]) - np.log(m.sum(1) + 0.5 * classes))
            if b == w and a in ranked:
                seen = True
                score += c * (np.log(before[of[a]]) - np.log(m.sum(0) + 0.5 * classes))
        of[w] = int(np.argmax(np.round(score, 6))) if seen else classes
    size = Counter()
    for w, c in counts.items():
        size[of[w]] += c
    step, total = Counter(), Counter()
    for (a, b), c in pairs.items():
        step[of[a], of[b]] += c
        total[of[a]] += c
    unseen = (sum(c == 1 for c in counts.values()) + 1) / (n + 2 + sum(c == 1 for c in counts.values()))
    out = []
    for doc_id, held, tokens in docs:
        base = score = 0.0
        last = "\n"
        for w in tokens:
            base += math.log10((counts[w] + 1) / (n + v + 1))
            if counts[w]:
                share = size[of[w]] / n
                if last in of and (counts[last] or last == "\n"):
                    share = (step[of[last], of[w]] + B.ALPHA * share) / (total[of[last]] + B.ALPHA)
                score += math.log10((1 - unseen) * share * counts[w] / size[of[w]])
            else:
                score += math.log10(unseen)
            last = w
        out.append((doc_id, held, len(tokens), sum(counts[w] > 0 for w in tokens), n, base, score))
    return sorted(out, key=str)


def found(docs, **more):
    more = {"classes": CLASSES, "top": TOP, "turns": TURNS, "block_tokens": 120} | more
    rows = B.score_texts(docs, **more).collect()
    assert all(abs(r.perplexity - 10 ** (-r.score / r.n_tokens)) < 1e-6 * r.perplexity for r in rows)
    return sorted((tuple(r)[:7] for r in rows), key=str)


def same(left, right):
    assert [r[:5] for r in left] == [r[:5] for r in right]
    for a, b in zip(left, right):
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_same_as_plain(spark, make_docs, odd_rows):
    rows = list(enumerate(texts(60)))
    same(found(make_docs(rows).repartition(3)), plain(rows))


def test_odd_rows(spark, make_docs, odd_rows):
    rows = [r[:2] for r in odd_rows if not r[1] or len(r[1]) < 20_000] + [(5, None), (None, "ÉÉ É"), (9, "A a a")]
    same(found(make_docs(rows)), plain(rows))


def test_long_text_and_few_rows(spark, make_docs, odd_rows):
    rows = B.score_texts(make_docs(odd_rows), block_tokens=500).collect()
    assert len(rows) == len(odd_rows)
    assert sorted(r.n_tokens for r in rows)[-1] == 30_001


def test_nothing_to_learn_from(spark, make_docs):
    held = next(k for k in range(99) if zlib.crc32(str(k).encode()) % 7 == 2)
    (row,) = B.score_texts(make_docs([(held, "one two")])).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0)
    assert row.score == pytest.approx(3 * math.log10(0.5))
    assert B.score_texts(make_docs([])).count() == 0


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 9, (4, 4)).astype(float)
    shares = rng.random(4)
    logs = B.transition_logs(counts, shares / shares.sum())
    assert (10 ** logs[:, :4]).sum(1) == pytest.approx(np.ones(5))


def test_held_out_texts_score_above_the_base(spark, make_docs):
    rows = [r for r in found(make_docs(list(enumerate(texts(400)))), classes=8, top=40, turns=9) if r[1]]
    assert len(rows) > 30
    assert sum(r[6] for r in rows) > sum(r[5] for r in rows) + 0.2 * sum(r[2] for r in rows)


def test_neighbours_move_as_one_row_per_word():
    rng = np.random.default_rng(3)
    w = np.sort(rng.integers(0, 50, 5000)).astype(np.int32)
    at, n = rng.integers(0, 100, (2, 5000))
    batches = list(B._lists(w, at, n, rows=7))
    rows = [r for batch in batches for r in batch.to_pylist()]
    assert max(b.num_rows for b in batches) == 7 and len(rows) == len(set(w.tolist()))
    flat = [(r["w"], a, c) for r in rows for a, c in zip(r["at"], r["n"])]
    assert flat == list(zip(w.tolist(), at.tolist(), n.tolist()))
