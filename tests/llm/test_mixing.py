import pytest

from webcorpus.llm import mixing


def brute_targets(sizes):
    """Targets of sources {name: words} by resharing what is above the limit."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        open_ = sum(weight[s] for s in sizes if s not in full)
        target = {
            s: 3 * sizes[s] if s in full else left * weight[s] / open_ for s in sizes
        }
        above = {s for s in sizes if s not in full and target[s] > 3 * sizes[s]}
        if not above:
            return target
        full |= above


def corpus():
    rows = []
    for k in range(900):
        source = "hot" if k % 3 == 0 else f"s{k % 7}"
        rows.append((k, " ".join(["w"] * (1 + k * 37 % 90)), None if k % 50 == 1 else source))
    return rows + [(2000, "lonely words", "zz")]


def test_targets_and_words_taken(make_docs, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 8)  # several levels
    rows = corpus()
    found = mixing.mix(make_docs(rows)).collect()
    assert sorted(r.doc_id for r in found) == sorted(r[0] for r in rows)
    sizes, taken, largest = {}, {}, {}
    for r in found:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        largest[r.source] = max(largest.get(r.source, 0), r.size)
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
    target = brute_targets(sizes)
    for r in found:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source])
        pace = r.target / r.source_size
        assert r.copies in (int(pace), int(pace) + 1)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6


def test_reruns_agree(make_docs):
    docs = make_docs(corpus())
    first, again = (
        sorted((r.doc_id, r.taken) for r in mixing.mix(d).collect())
        for d in (docs, docs.repartition(7, "text"))
    )
    assert first == again


def test_odd_rows(make_docs, odd_rows):
    found = mixing.mix(make_docs(odd_rows)).collect()
    assert len(found) == len(odd_rows)
    assert all(r.taken == 0 for r in found if r.size == 0)
    assert {r.size for r in found if r.doc_id in (1, 2, 3)} == {0}


def test_equal_rows_share_their_copies(make_docs):
    rows = [(1, "a b c d", "x")] * 50 + [(k, "a b", "y") for k in range(2, 60)]
    found = [r for r in mixing.mix(make_docs(rows)).collect() if r.doc_id == 1]
    assert len(found) == 50
    assert max(r.copies for r in found) - min(r.copies for r in found) <= 1


def test_take_mix_repeats_rows_as_decided(make_docs, odd_rows):
    docs = make_docs(odd_rows + corpus())
    decided = sorted(
        (str(r.doc_id), r.copies) for r in mixing.mix(docs).collect() if r.copies
    )
    rows = mixing.take_mix(docs).collect()
    assert sum(c for _, c in decided) == len(rows)
    counts = {}
    for r in rows:
        counts[str(r.doc_id)] = counts.get(str(r.doc_id), 0) + 1
    wanted = {}
    for doc_id, copies in decided:
        wanted[doc_id] = wanted.get(doc_id, 0) + copies
    assert counts == wanted
    assert set(rows[0].asDict()) == set(docs.columns)


def test_rows_of_one_id_are_taken_alike_in_every_run(make_docs):
    rows = [(1, f"{a} {b} c d", "x") for a in "pqrstu" for b in "vw"] + [(k, "a b", "y") for k in range(2, 40)]
    docs = make_docs(rows)
    taken = [
        sorted((r.doc_id, r.text, r["copy"]) for r in mixing.take_mix(docs.repartition(n, "text")).collect())
        for n in (1, 3, 7)
    ]
    assert taken[0] == taken[1] == taken[2]


def test_empty(make_docs):
    assert mixing.mix(make_docs([])).count() == 0
    assert mixing.take_mix(make_docs([])).count() == 0
    assert mixing.mix(make_docs([(1, None), (2, "")])).count() == 2
