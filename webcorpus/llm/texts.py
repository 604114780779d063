"""Words and text chunks, as the tasks of several operators read them."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa

#: A word, as a Java or RE2 pattern and as a Python function.
WORD = r"[^\x20\x09-\x0D]+"
words_of: Callable[[str], list[str]] = re.compile(r"[^ \t-\r]+").findall


class WordHashes(dict):
    """word -> leading `n_bytes` of its MD5 as an unsigned number, remembered.

    The memory is bounded: it is emptied when it holds `limit` words.
    """

    def __init__(self, n_bytes: int = 8, limit: int = 400_000):
        super().__init__()
        self.n_bytes, self.limit = n_bytes, limit

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        digest = hashlib.md5(word.encode("utf-8", "surrogatepass")).digest()
        value = self[word] = int.from_bytes(digest[: self.n_bytes], "big")
        return value

    def array(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def chunks(
    batches: Iterable[pa.RecordBatch], max_chars: int = 1_500_000
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """(rows, texts) in runs of about `max_chars`; a longer text is a run of its own.

    A null text is read as an empty one. The column is named `text`.
    """
    for batch in batches:
        texts = [text or "" for text in batch.column("text").to_pylist()]
        start = size = 0
        for k, text in enumerate(texts):
            if size and size + len(text) > max_chars:
                yield batch.slice(start, k - start), texts[start:k]
                start, size = k, 0
            size += len(text)
        if start < len(texts):
            yield batch.slice(start), texts[start:]


def flat_words(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """All words of the texts in order, and the bounds of each text's words."""
    flat: list[str] = []
    bounds = np.zeros(len(texts) + 1, np.int64)
    for k, text in enumerate(texts):
        flat += words_of(text)
        bounds[k + 1] = len(flat)
    return flat, bounds


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of `values` between consecutive bounds; exact for whole numbers."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
