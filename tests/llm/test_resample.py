"""Resampling against a plain version, and the selection against a sort."""

import hashlib
import math
import re
import zlib

import pytest
from pyspark.sql import functions as F

from webcorpus.llm import resample as R

PROSE = "The quick brown Fox jumps over a lazy dog again and again until the night falls on us all "


def plain(rows, target, longest=1, percent=R.PERCENT, min_words=R.MIN_WORDS):
    """Every step in plain Python."""

    def features(text):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        made = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
        return [zlib.crc32(f.encode()) % R.BUCKETS for f in made], len(words)

    def counts(texts):
        out = {}
        for text in texts:
            for b in features(text)[0]:
                out[b] = out.get(b, 0) + 1
        return out

    s, t = counts(x for _, x in rows), counts(target)
    big_s, big_t = sum(s.values()), sum(t.values())
    out, able = [], []
    for at, (doc_id, text) in enumerate(rows):
        own, n_words = features(text)
        gain = [
            math.floor(1000 * math.log((t.get(b, 0) + 1) * (big_s + R.BUCKETS) / ((s[b] + 1) * (big_t + R.BUCKETS))))
            for b in own
        ]
        weight = sum(gain) // len(gain) if gain else 0
        name = f"{R.SEED}:{'' if doc_id is None else doc_id}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(own), weight, score, None])
        if n_words >= min_words:
            able.append(at)
    able.sort(key=lambda k: (-out[k][3], out[k][0] is None, out[k][0] or 0, out[k][1]))
    for rank, k in enumerate(able[: percent * len(able) // 100], 1):
        out[k][4] = rank
    return sorted(map(tuple, out), key=str)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("longest", [1, 2])
def test_same_as_plain(spark, make_docs, odd_rows, longest):
    rows = [r[:2] for r in odd_rows] + [
        (k, PROSE + f"number{k} Über straße " * (k % 7) + "ABC-def_ghi") for k in range(20, 140)
    ]
    rows += [(30, rows[20][1]), (None, rows[25][1]), (None, rows[25][1])]
    target = [PROSE, None, "", "number40 straße"]
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id int, text string")
    found = R.resample(make_docs(rows), bench, percent=30, longest=longest, pivots=3)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert collected(found) == plain(rows, target, longest, percent=30)


def test_empty_tables(spark, make_docs):
    docs, none = make_docs([(1, PROSE)] * 3), make_docs([])
    assert R.resample(none, docs).count() == 0
    assert R.resample(docs, none).count() == 3


def test_text_ids(spark, make_docs):
    docs = make_docs([(k, PROSE + f"w{k}") for k in range(40)])
    docs = docs.withColumn("doc_id", F.concat(F.lit("id"), F.col("doc_id").cast("string")))
    drawn = R.resample(docs, docs, pivots=4).filter("rank is not null").collect()
    assert sorted(r.rank for r in drawn) == [1, 2, 3, 4]


def test_kth_key_of_many_ties(spark):
    rows = spark.range(3_000).select(
        (F.col("id") % 3).alias("score"), F.lit(7).cast("long").alias("doc_id"),
        F.lit(1).alias("n_features"), F.col("id").alias("_row"),
    )
    listed = sorted((r.asDict() for r in rows.collect()), key=R._place)
    for k in (1, 2, 999, 1000, 1001, 2500, 3000):
        assert R.kth_key(rows, k, 4) == listed[k - 1]

