import random
import re

import pytest

from webcorpus.llm import jaccard


def shingles(text):
    words = re.findall(r"[^ \t-\r]+", text or "")
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """{row number: (class, n_links, n_text_links)} by comparing all with all."""
    sets = [shingles(text) for _, text, *_ in rows]
    group = list(range(len(rows)))
    links, kinds = [0] * len(rows), [set() for _ in rows]
    for i in range(len(rows)):
        for j in range(len(rows)):
            both = len(sets[i] & sets[j])
            if i != j and both and 5 * both >= 4 * len(sets[i] | sets[j]):
                links[i] += 1
                if sets[i] != sets[j]:
                    kinds[i].add(frozenset(sets[j]))
                old, new = group[j], group[i]
                group = [new if g == old else g for g in group]
    first = {}
    for k, (doc_id, *_) in enumerate(rows):
        known = [x for x in (first.get(group[k]), doc_id) if x is not None]
        first[group[k]] = min(known, default=None)
    return sorted(((r[0], first[group[k]], links[k], len(kinds[k])) for k, r in enumerate(rows)), key=str)


def near_copies(seed, n_base=12, n_copies=9, words=60):
    rng = random.Random(seed)
    rows = []
    for base in range(n_base):
        text = [f"w{rng.randrange(400)}" for _ in range(words)]
        for _ in range(rng.randrange(1, n_copies)):
            copy = list(text)
            for _ in range(rng.randrange(3)):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(50)}"
            rows.append((len(rows), " ".join(copy)))
    passage = " ".join(f"p{k}" for k in range(25))
    for _ in range(30):  # share a passage, but are not near copies
        own = " ".join(f"o{rng.randrange(10**6)}" for _ in range(25))
        rows.append((len(rows), f"{passage} {own}"))
    rng.shuffle(rows)
    return rows


def result(docs):
    found = jaccard.jaccard_join(docs).collect()
    return sorted(((r.doc_id, r.class_id, r.n_links, r.n_text_links) for r in found), key=str)


@pytest.mark.parametrize("limit, block", [(64, 256), (2, 3)])
def test_links_are_those_of_brute_force(make_docs, monkeypatch, limit, block):
    monkeypatch.setattr(jaccard, "LIMIT", limit)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = near_copies(limit)
    assert result(make_docs(rows)) == brute(rows)


def test_one_hot_group_of_near_and_equal_copies(make_docs):
    rng = random.Random(3)
    text = [f"w{k}" for k in range(80)]
    rows = [(k, " ".join(text)) for k in range(40)]
    for k in range(40, 160):
        copy = list(text)
        copy[rng.randrange(80)] = f"e{rng.randrange(30)}"
        rows.append((k, " ".join(copy)))
    assert result(make_docs(rows)) == brute(rows)


def edits(seed, n, words=80, changes=1, first=0):
    """Different near copies of one text: its words with a few of them changed."""
    rng = random.Random(seed)
    text = [f"w{k}" for k in range(words)]
    rows = []
    for k in range(n):
        copy = list(text)
        for _ in range(changes):
            copy[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        rows.append((first + k, " ".join(copy)))
    return rows


@pytest.mark.parametrize("block", [7, 2_048])
def test_near_copies_inside_and_outside_the_core(make_docs, monkeypatch, block):
    monkeypatch.setattr(jaccard, "LIMIT", 8)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = edits(1, 40, 90) + edits(2, 40, 90, 2, 100) + edits(3, 25, 90, 3, 200) + near_copies(9)
    rows = [(k, text) for k, (_, text) in enumerate(rows)]
    assert result(make_docs(rows)) == brute(rows)


def test_null_ids_and_one_id_with_several_texts(make_docs):
    a, b, c = edits(4, 3, 120)
    rows = [(None, a[1]), (None, b[1]), (7, c[1]), (None, a[1]), (8, "some other text of six words"), (8, c[1]),
            (None, "words of a text that has no id"), (None, "words of a text that has no id")]
    assert result(make_docs(rows)) == brute(rows)


def test_texts_of_one_id_stay_apart_in_select_first(make_docs):
    a, b = "a b c d e f g h i j k l", "quite another text than the one above it is"
    rows = [(1, a), (2, a), (2, b), (None, a), (None, "x y z"), (None, "x y z"), (3, None), (3, None), (None, None)]
    kept = [tuple(r)[:2] for r in jaccard.select_first(make_docs(rows)).collect()]
    assert sorted(kept, key=str) == sorted([(1, a), (2, b), (None, "x y z"), (3, None), (None, None)], key=str)


def test_rows_that_differ_in_other_columns_only(spark, make_docs):
    docs = make_docs([(1, "a b c d e f", f"s{k}") for k in range(6)])
    kept = [jaccard.select_first(docs.repartition(n)).collect() for n in (1, 5)]
    assert kept[0] == kept[1] and len(kept[0]) == 1


def test_work_on_a_hot_group_grows_with_its_size(make_docs, monkeypatch):
    monkeypatch.setattr(jaccard, "LIMIT", 16)
    searched, compared = [], []
    for n in (100, 200):
        embedded = jaccard.embed(make_docs(edits(5, n, 200))).cache()
        classes = embedded.withColumn("copies", embedded.cid * 0 + 1)
        leaves, edges = jaccard._leaves(classes)
        searched.append(leaves.count())
        compared.append(edges.count())
    assert searched[1] <= 2.5 * searched[0] + 20
    assert compared[1] <= 2.5 * compared[0]


def test_a_hot_group_hands_on_one_link_per_class(make_docs, monkeypatch):
    monkeypatch.setattr(jaccard, "LIMIT", 16)
    classes = jaccard.embed(make_docs(edits(5, 200, 200))).cache()
    _, edges = jaccard._leaves(classes.withColumn("copies", classes.cid * 0 + 1))
    ends = edges.select("a").union(edges.select("b")).distinct().count()
    assert 0 < edges.count() < ends


def test_odd_rows(make_docs, odd_rows):
    found = jaccard.jaccard_join(make_docs(odd_rows)).collect()
    assert len(found) == len(odd_rows)
    by_id = {r.doc_id: r for r in found}
    for blank in (1, 2, 3):
        assert (by_id[blank].class_id, by_id[blank].n_links) == (blank, 0)
    assert by_id[5].n_links == 1 and by_id[5].class_id == 5
    assert by_id[4].n_links == by_id[7].n_links == 0


def test_select_first_keeps_one_and_all_columns(make_docs, odd_rows):
    rows = odd_rows + [(50, "a b c d e f g h i j k l m n o p q r s t"), (51, "a b c d e f g h i j k l m n o p q r s t")]
    docs = make_docs(rows)
    kept = jaccard.select_first(docs)
    assert kept.schema == docs.schema
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    assert ids == sorted([1, 2, 3, 4, None, 5, 6, 7, 8, 50], key=str)


def test_empty(make_docs):
    assert jaccard.jaccard_join(make_docs([])).count() == 0
    assert jaccard.select_first(make_docs([])).count() == 0


def test_runs_reach_the_recall():
    assert jaccard.runs_needed() >= 10
