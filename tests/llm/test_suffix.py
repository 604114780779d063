import hashlib
import random

import numpy as np
import pytest

from webcorpus.llm import suffix


def brute(rows):
    seen, out = set(), []
    for doc_id, text, *_ in sorted(rows):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - 99):
            window = data[k : k + 100]
            if window in seen:
                gone[k : k + 100] = True
            seen.add(window)
        spans = int((np.diff(np.concatenate([[0], gone, [0]]).astype(int)) == 1).sum())
        left = bytes(np.frombuffer(data, np.uint8)[~gone])
        out.append((doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()))
    return out


def result(docs):
    return sorted(tuple(r) for r in suffix.remove_repeats(docs).collect())


def repetitive(seed):
    rng = random.Random(seed)
    words = [f"{rng.randrange(10**6):x}é" for _ in range(60)]
    passages = [" ".join(rng.choices(words, k=rng.randrange(15, 60))) for _ in range(8)]
    rows = []
    for k in range(50):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            parts.append(" ".join(rng.choices(words, k=rng.randrange(1, 30))))
            part = rng.choice(passages)
            parts.append(part[rng.randrange(40) : len(part) - rng.randrange(40)])
        rows.append((k, " ".join(parts)))
    rows += [(60, "ab" * 300), (61, "ab" * 170 + "c" + "ab" * 90), (62, "a" * 99), (63, "a" * 101)]
    rows += [(64, passages[0] * 3), (65, passages[0] * 3), (66, "\0" * 250 + "x" + "\0" * 120)]
    return rows


@pytest.mark.parametrize("hot", [suffix.HOT, 3])
def test_bytes_are_those_of_brute_force(make_docs, monkeypatch, hot):
    monkeypatch.setattr(suffix, "HOT", hot)
    rows = repetitive(hot)
    assert result(make_docs(rows)) == brute(rows)


def test_a_line_in_many_texts(make_docs):
    line = "this line of over a hundred bytes stands in every text of the table, and only one may keep it whole " * 2
    rows = [(k, f"{k * 7919:x} {line} {k * 104729:x}") for k in range(300)]
    assert result(make_docs(rows)) == brute(rows)


def test_maximal_repeats_have_all_their_occurrences():
    common = bytes(range(1, 121))
    stretches = [b"x" + common + b"1", b"y" + common + b"2", b"y" + common + b"3"]
    windows = np.array([len(s) - 99 for s in stretches])
    found = {(n, len(owner)) for n, owner, _ in suffix.maximal_repeats(stretches, windows)}
    assert found == {(120, 3), (121, 2)}


def test_odd_rows(make_docs, odd_rows):
    found = suffix.remove_repeats(make_docs(odd_rows)).collect()
    assert len(found) == len(odd_rows)
    by_id = {r.doc_id: r for r in found}
    assert by_id[1].n_bytes == by_id[2].n_bytes == 0
    assert by_id[1].kept_sha256 == hashlib.sha256(b"").hexdigest()
    assert (by_id[8].n_removed, by_id[8].n_spans) == (4_999, 1)
    assert by_id[5].n_removed < by_id[5].n_bytes  # a repeated row is not the earlier one


@pytest.mark.parametrize("hot", [suffix.HOT, 3])
def test_different_texts_under_null_and_equal_ids(make_docs, monkeypatch, hot):
    monkeypatch.setattr(suffix, "HOT", hot)
    texts = [text for _, text in repetitive(5)]
    rows = [(None if k % 3 == 0 else k % 5, text) for k, text in enumerate(texts)]
    docs = make_docs(rows)
    keys = {r.text: r.key for r in docs.selectExpr("text", "xxhash64(text) as key").collect()}
    distinct = sorted({(-1 if d is None else d, keys[t], t) for d, t in rows})
    wanted = brute([(k, t) for k, (_, _, t) in enumerate(distinct)])
    by_row = {(d, t): w[1:] for (d, _, t), w in zip(distinct, wanted)}
    found = [tuple(r) for r in suffix.remove_repeats(docs).collect()]
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in found) == sorted(
        (d, *by_row[d, t]) for d, t in ((-1 if d is None else d, t) for d, t in rows)
    )


def test_empty(make_docs):
    assert suffix.remove_repeats(make_docs([])).count() == 0
