"""The pipeline against a plain version of each stage, and the entry's guard."""

import hashlib
import math
import subprocess
import sys
from collections import Counter

import pytest

import corpus_pipeline
from test_filters import brute_share, brute_stats, words
from test_jaccard import shingles
from webcorpus.llm import mixing, pii, quality

ITEM = "the benchmark asks which of these seven rivers runs into the northern sea at the old harbour town"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, extra string"


def corpus():
    rows = []
    for k in range(80):
        text = [f"w{(k * 7919 + j * 104729 + j * j * k) % 700}" for j in range(70)]
        if k % 9 == 4:
            text = [f"{w}###" for w in text]
        if k % 9 == 5:
            text[20:20] = ITEM.split()
        if k % 9 == 6:
            text[30:30] = ["mail", f"user.{k}@mail.example.com", "or", "10.20.30.40", "card", "4111111111111111"]
        rows.append([k, " ".join(text), f"s{k % 4}"])
    for k in range(20):  # near copies of clean documents
        copy = rows[k * 3][1].split()
        copy[k] = "edited"
        rows.append([100 + k, " ".join(copy), "s1"])
    rows += [[200, None, "s0"], [201, "", None], [202, "too short", "s2"], [204, rows[0][1], None]]
    return [(i, t, "en", s, None if t is None else len(t), "kept as it is") for i, t, s in rows]


def is_good(doc_id):
    return doc_id >= 80 or doc_id % 9 != 4


def brute_quality(rows, good):
    size, a = 2 * quality.BUCKETS, quality.SMOOTHING

    def grams(text):
        h = [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) for w in words(text)]
        pairs = [quality.BUCKETS + (x * 31 + y) % quality.BUCKETS for x, y in zip(h, h[1:])]
        return [x % quality.BUCKETS for x in h] + pairs

    raw, trusted = Counter(), Counter()
    for doc_id, text, *_ in rows:
        raw.update(grams(text))
        if doc_id in good:
            trusted.update(grams(text))
    n_raw, n_trusted = sum(raw.values()) + a * size, sum(trusted.values()) + a * size
    kept = []
    for row in rows:
        n, _, _, _, repeated = brute_stats(row[1])
        if n < 50 or 100 * repeated > 50 * n:
            continue
        found = grams(row[1])
        llr = sum(
            round(quality.SCALE * math.log(((trusted[g] + a) / n_trusted) / ((raw[g] + a) / n_raw)))
            for g in found
        )
        if llr >= quality.THRESHOLD * quality.SCALE * len(found):
            kept.append(row)
    return kept


def brute_first(rows):
    sets, group = [shingles(r[1]) for r in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 5 * both >= 4 * len(sets[i] | sets[j]) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    first = {}
    for k, row in enumerate(rows):
        if group[k] not in first or row[0] < first[group[k]][0]:
            first[group[k]] = row
    return sorted(first.values(), key=lambda r: r[0])


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(corpus(), COLUMNS).write.parquet(f"{path}/documents.parquet")
    labels = [(r[0], int(is_good(r[0])), 0) for r in corpus()]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_pipeline_is_the_plain_stages_in_order(spark, folder, monkeypatch):
    monkeypatch.setattr(quality, "SMOOTHING", 1.0)  # few counts here
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_duplicates", "benchmark_decontamination", "pii_pseudonyms", "source_mixing"]
    rows = brute_quality(corpus(), {r[0] for r in corpus() if is_good(r[0])})
    assert 0 < len(rows) < len(corpus())
    rows = brute_first(rows)
    rows = [r for r in rows if brute_share(r[1], ITEM) < 0.5]
    masker = pii.Masker(corpus_pipeline.TEST_KEY)
    rows = [(r[0], masker.mask(r[1])[0], *r[2:4], len(masker.mask(r[1])[0]), r[5]) for r in rows]
    copies = {r.doc_id: r.copies for r in mixing.mix(spark.createDataFrame(rows, COLUMNS)).collect()}
    wanted = sorted((*r, c) for r in rows for c in range(1, copies[r[0]] + 1))
    found = corpus_pipeline.run(spark, folder)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "extra", "copy"]
    assert sorted(map(tuple, found.collect())) == wanted
    assert not any("4111111111111111" in r[1] or "10.20.30.40" in r[1] for r in wanted)


@pytest.mark.parametrize("k", range(5))
def test_stages_take_odd_and_empty_tables(spark, folder, make_docs, odd_rows, k):
    name, stage = corpus_pipeline.STAGES[k]
    for docs in (make_docs(odd_rows), make_docs([])):
        out = stage(spark, docs, folder)
        out.collect()
        assert set(docs.columns) <= set(out.columns)


def test_entry_works_without_the_package():
    code = (
        "import sys; sys.modules['webcorpus.llm'] = None; sys.modules['corpus_pipeline'] = None\n"
        "import __spark_entry__ as e\n"
        "assert 'page_chunk_records' in e.queries() and not any(k.startswith('op1_') for k in e.queries())\n"
    )
    root = corpus_pipeline.__file__.rsplit("/", 1)[0]
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root)
