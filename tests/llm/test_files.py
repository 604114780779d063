"""Merkle audit and token counts."""

import numpy as np
import pytest

from webcorpus.llm import fixity, tokencount

PLACE = "file string, offset long, length long, record_id long, record binary"


def replica(spark, rows):
    return fixity.hashed(spark.createDataFrame(rows, PLACE))


def records(n, files=("a", "b", None)):
    out, at = [], {}
    for k in range(n):
        file = files[k % len(files)]
        data = bytes([k % 251]) * (40 + k % 90)
        out.append((file, at.get(file, 0), len(data), k, data))
        at[file] = at.get(file, 0) + len(data)
    return out


@pytest.mark.parametrize("span", [64, 1 << 20])
def test_only_damaged_records_are_found(spark, monkeypatch, span):
    monkeypatch.setattr(fixity, "SPAN", span)
    monkeypatch.setattr(fixity, "FANOUT", 3)
    good = records(300)
    bad = [r for r in good if r[3] != 17]  # lost
    bad = [(*r[:4], b"?" + r[4][1:]) if r[3] in (5, 250) else r for r in bad]  # changed
    bad = [(*r[:4], None) if r[3] == 80 else r for r in bad]
    bad.append(("c", 10**7, 3, 999, b"new"))
    bad.append(good[100])  # repeated
    found = fixity.audit(replica(spark, good), replica(spark, bad)).collect()
    assert sorted(r.record_id for r in found) == [5, 17, 80, 100, 250, 999]
    lost = next(r for r in found if r.record_id == 17)
    assert lost.second_hash is None and lost.first_length == good[17][2]


def test_a_lost_record_is_found_alone_though_all_others_moved(spark, monkeypatch):
    monkeypatch.setattr(fixity, "SPAN", 256)
    monkeypatch.setattr(fixity, "FANOUT", 3)
    rows = [(k, f"http://x/{k}", "<p>" + "text " * (k % 30)) for k in range(120)]
    schema = "page_id long, url string, html string"

    def laid(some):
        return fixity.laid_out(fixity.hashed(fixity.warc_records(spark.createDataFrame(some, schema))), 40)

    longer = [(k, u, h + " and more" if k == 90 else h) for k, u, h in rows if k != 45]
    found = {r.record_id: r for r in fixity.audit(laid(rows), laid(longer)).collect()}
    assert set(found) == {45, 90}
    assert found[45].second_hash is None and found[90].second_length == found[90].first_length + 10  # one digit more in the header
    place = {r.record_id: r.offset for r in laid(rows).collect()}
    assert {k: r.file_offset for k, r in found.items()} == {k: place[k] for k in (45, 90)}


def test_records_without_an_offset(spark):
    good = [(None, None, 3, k % 50, f"r{k}".encode()) for k in range(3_000)]
    bad = [r for r in good if r[4] != b"r77"] + [("", None, 3, 1, b"new")]
    found = fixity.audit(replica(spark, good), replica(spark, bad)).collect()
    assert sorted((r.file, r.file_offset, r.record_id) for r in found) == [("", 0, 1), ("", 0, 27)]


def test_equal_and_empty_replicas(spark):
    good = replica(spark, records(50))
    assert fixity.audit(good, good.repartition(5)).count() == 0
    none = replica(spark, [])
    assert fixity.audit(none, none).count() == 0
    assert fixity.audit(none, good).count() == 50


def test_warc_records(spark):
    pages = spark.createDataFrame(
        [(1, "http://x/", "<p>é</p>"), (2, None, None), (None, "u", "x")],
        "page_id long, url string, html string",
    )
    rows = {r.record_id: r for r in fixity.warc_records(pages).collect()}
    assert bytes(rows[1].record).endswith("Content-Length: 9\r\n\r\n<p>é</p>\r\n\r\n".encode())
    assert all(r.length == len(r.record) for r in rows.values())
    laid = fixity.laid_out(fixity.hashed(fixity.warc_records(pages))).orderBy("file", "offset").collect()
    assert [r.offset for r in laid] == [0, laid[0].length, 0]


def blocks_of(spark, files, size):
    rows = []
    for name, tokens in files.items():
        data = np.array(tokens, "<u2").tobytes()
        cuts = range(0, len(data), 2 * size)
        rows += [(name, k, data[c : c + 2 * size], "clash") for k, c in enumerate(cuts)]
    return spark.createDataFrame(rows, "file string, block long, data binary, ordinal string")


def brute_documents(tokens, end):
    out, first = [], 0
    for k, token in enumerate(tokens):
        if token == end:
            out.append((first, k - first, True))
            first = k + 1
    if first < len(tokens):
        out.append((first, len(tokens) - first, False))
    return out


@pytest.mark.parametrize("size, scan", [(1, 2), (3, 2), (7, 5), (1000, 1024)])
def test_documents_of_flat_files(spark, monkeypatch, size, scan):
    monkeypatch.setattr(tokencount, "SCAN", scan)
    rng = np.random.default_rng(size)
    files = {
        "mixed": rng.choice([1, 2, 3, 9], 90, p=[0.4, 0.3, 0.2, 0.1]).tolist(),
        "long": [1] * 60 + [9] + [2] * 40,
        "only ends": [9] * 20,
        "no end": [4] * 30,
    }
    found = tokencount.document_tokens(blocks_of(spark, files, size), end=9).collect()
    for name, tokens in files.items():
        mine = sorted((r.ordinal, r.first, r.n_tokens, r.closed) for r in found if r.file == name)
        assert mine == [(k, *d) for k, d in enumerate(brute_documents(tokens, 9))]


def test_files_on_disk(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tokencount, "BLOCK_TOKENS", 4)
    tokens = [1, 2, 9, 3, 4, 5, 6, 7, 9, 9, 1]
    (tmp_path / "x.bin").write_bytes(np.array(tokens, "<u2").tobytes())
    (tmp_path / "empty.bin").write_bytes(b"")
    files = spark.read.format("binaryFile").load(str(tmp_path))
    found = tokencount.document_tokens(tokencount.flat_blocks(files), end=9).collect()
    mine = sorted((r.first, r.n_tokens, r.closed) for r in found)
    assert mine == brute_documents(tokens, 9)


def test_counts_of_texts(make_docs, odd_rows, monkeypatch):
    monkeypatch.setattr(tokencount, "BLOCK_TOKENS", 500)
    monkeypatch.setattr(tokencount, "PIECE", 1_000)
    encoding = tokencount.load_encoding()
    found = tokencount.count_tokens(make_docs(odd_rows)).collect()
    mine = sorted((str(r.doc_id), r.n_tokens) for r in found)
    assert mine == sorted((str(r[0]), len(encoding.encode_ordinary(r[1] or ""))) for r in odd_rows)
    assert tokencount.count_tokens(make_docs([])).count() == 0
