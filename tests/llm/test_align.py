"""Alignment against plain loops, fragments as a monoid, the two vocabularies' libraries."""

import hashlib
import os
import random
from collections import Counter, defaultdict
from functools import reduce

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from webcorpus.llm import align as A

HARD = "ab1   \t\x00<|endoftext|><s></s><0x41> \r\n\x1c\x85 wörter 日本語 \U0001f600\U0001f468‍\U0001f469 x' s"


@pytest.fixture(scope="module")
def plain_tokenizers():
    first = Tokenizer.from_file(f"{A.VOCABULARIES}/{A.FILE_A}")
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=f"{A.VOCABULARIES}/{A.FILE_B}")
    return first, second


def plain(rows, tokenizers):
    """Every document in loops over its bytes."""
    first, second = tokenizers
    byte = A.byte_characters()
    aligned, count = [], Counter()
    for doc_id, text in rows:
        text = text or ""
        data = f" {text}".encode()
        a = first.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        bytes_a = [bytes(byte[c] for c in first.id_to_token(k)) for k in a]
        pieces = [second.id_to_piece(k) for k in b]
        bytes_b = [
            bytes([int(p[3:5], 16)]) if second.is_byte(k) else p.replace("▁", " ").encode()
            for k, p in zip(b, pieces)
        ]
        if not text or b"".join(bytes_a) != data or b"".join(bytes_b) != data:
            aligned.append((doc_id, [], [], [], Counter()))
            continue
        owner_a = [k for k, x in enumerate(bytes_a) for _ in x]
        owner_b = [k for k, x in enumerate(bytes_b) for _ in x]
        linked = Counter((a[i], b[j]) for i, j in set(zip(owner_a, owner_b)))
        groups, i, j = [], 0, 0
        while i < len(a):
            ends, left, right = [len(bytes_a[i]), len(bytes_b[j])], [a[i]], [b[j]]
            i, j = i + 1, j + 1
            while ends[0] != ends[1]:
                if ends[0] < ends[1]:
                    ends[0] += len(bytes_a[i])
                    left.append(a[i])
                    i += 1
                else:
                    ends[1] += len(bytes_b[j])
                    right.append(b[j])
                    j += 1
            groups.append(",".join(map(str, left)) + "|" + ",".join(map(str, right)))
        count.update(set(linked))
        aligned.append((doc_id, a, b, groups, linked))
    highest = defaultdict(int)
    for (x, _), n in count.items():
        highest[x] = max(highest[x], n)
    out = []
    for doc_id, a, b, groups, linked in aligned:
        best = sum(t for p, t in linked.items() if count[p] == highest[p[0]])
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        total = sum(t * count[p] for p, t in linked.items())
        out.append((doc_id, len(a), len(b), len(groups), sum(linked.values()), best, total, sha))
    return sorted(out, key=str)


def found(docs, **more):
    return sorted((tuple(r) for r in A.align(docs, **more).collect()), key=str)


@pytest.mark.parametrize("size", [1 << 16, 64, 300])
def test_same_as_plain(spark, make_docs, odd_rows, plain_tokenizers, size):
    random.seed(3)
    words = "the of straße Wörter données 12,345 “quoted” antidisestablishment 日本 \t a  b \n\n é".split(" ")
    rows = [r[:2] for r in odd_rows if not r[1] or len(r[1]) < 9_000]
    rows += [(k, " ".join(random.choices(words, k=random.randint(1, 120)))) for k in range(20, 50)]
    rows += [(50, HARD), (50, HARD), (51, "has ▁ of its own"), (None, HARD * 9), (52, "x" * 2_000)]
    assert found(make_docs(rows).repartition(3), size=size) == plain(rows, plain_tokenizers)


def test_empty_table(spark, make_docs):
    empty = A.align(make_docs([]))
    assert empty.columns[0] == "doc_id" and empty.count() == 0


def test_long_text(spark, make_docs, odd_rows, plain_tokenizers):
    rows = [r[:2] for r in odd_rows if r[1] and len(r[1]) > 9_000] + [(1, "short")]
    assert found(make_docs(rows), size=4_096) == plain(rows, plain_tokenizers)


def test_same_tokens_as_the_vocabularys_library(plain_tokenizers):
    made = A.Tokenizers(*A.read_files(A.VOCABULARIES))
    for text in (HARD, HARD * 40, "x" * 5_000, " " * 5_000, "\n " * 999, "日本語" * 999, "'s 'S ''ll"):
        ((a, b),) = made.encode([text])
        assert a == plain_tokenizers[0].encode(f" {text}", add_special_tokens=False).ids
        assert b == plain_tokenizers[1].encode(text)


def stretch(lengths_a, lengths_b):
    """Tokens of both sides over as many bytes as the shorter side has."""
    n = min(sum(lengths_a), sum(lengths_b))
    ends = [np.cumsum(x) for x in (lengths_a, lengths_b)]
    ends = [np.unique(np.append(x[x < n], n)).astype(np.int64) for x in ends]
    return A.Tokens(np.arange(len(ends[0])), ends[0], np.arange(len(ends[1])), ends[1]), n


def as_lists(fragment):
    flat = reduce(lambda x, y: x + y, fragment.closed, A.NONE)
    return fragment.cut, *([x.tolist() for x in part] for part in (fragment.prefix, flat, fragment.suffix))


lengths = st.lists(st.integers(1, 9), min_size=1, max_size=30)


@settings(max_examples=200, deadline=None)
@given(lengths, lengths, st.integers(1, 15), st.randoms())
def test_composition_is_associative(lengths_a, lengths_b, size, rng):
    tokens, n = stretch(lengths_a, lengths_b)
    parts = [A.Fragment.of(tokens.cut(k, k + size)) for k in range(0, n, size)]
    whole = as_lists(A.Fragment.of(tokens))
    while len(parts) > 1:
        k = rng.randrange(len(parts) - 1)
        parts[k : k + 2] = [parts[k] + parts[k + 1]]
    assert as_lists(parts[0]) == whole


def test_files_are_a_parameter(tmp_path):
    os.symlink(f"{A.VOCABULARIES}/{A.FILE_A}", tmp_path / A.FILE_A)
    os.symlink(f"{A.VOCABULARIES}/{A.FILE_B}", tmp_path / A.FILE_B)
    assert A.read_files(str(tmp_path)) == A.read_files(A.VOCABULARIES)
