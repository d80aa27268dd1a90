"""Toxicity: a factorization machine over the hashed words of a text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from . import factorization
from .common import bare, mix, split_words, texts_of

#: Hashed words share this many features.
BUCKETS = 1 << 20
#: Lengths of the word beginnings that count as terms besides whole words.
STEMS = (4, 5, 6, 7, 8)


def terms(part: pa.RecordBatch) -> factorization.Features:
    """Hashed words of each text; stems which one, two or three of its different words begin with; a mark for an empty text."""
    n = part.num_rows
    words, bounds = split_words(texts_of(part, "text"))
    coded = words.dictionary_encode()
    plain = [bare(w) for w in coded.dictionary.to_pylist()]
    row = np.repeat(np.arange(n), np.diff(bounds))
    hashes = hash_list(plain)
    code = coded.indices.to_numpy()
    doc, code = np.divmod(distinct(row * np.int64(max(len(plain), 1)) + code)[0], max(len(plain), 1))
    real = hashes[code] != 0
    doc, code = doc[real], code[real]
    found = [spread(doc, hashes[code])]
    for length in STEMS:
        # Stems are numbered within the batch, so that one sort of plain numbers brings those of a text together.
        stems, number = np.unique(hash_list([w[:length] if len(w) > length else "" for w in plain]), return_inverse=True)
        own = number[code]
        begun = stems[own] != 0
        both, many = distinct(doc[begun] * np.int64(max(len(stems), 1)) + own[begun])
        d, own = np.divmod(both, max(len(stems), 1))
        for least in (1, 2, 3):
            there = many >= least
            found.append(spread(d[there], mix(stems[own[there]] + np.uint64(16 * length + least))))
    empty = np.flatnonzero(np.bincount(doc, minlength=n) == 0)
    both = distinct(np.concatenate([*found, empty * np.int64(BUCKETS + 1) + BUCKETS]))[0]
    return np.divmod(both, BUCKETS + 1)


def distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different numbers of ``x`` in order, and how often each occurs. Sorts plain numbers, the quickest sort of numpy."""
    x = np.sort(x)
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    at = np.flatnonzero(new)
    return x[at], np.diff(np.append(at, len(x)))


def hash_list(words: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) or 1 if w else 0 for w in words), np.uint64, len(words))


def spread(doc: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return doc * np.int64(BUCKETS + 1) + (hashes % np.uint64(BUCKETS)).astype(np.int64)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", **options) -> factorization.Machine | None:
    """Pairwise interactions of words, such as an insult near the name of a group, beside their own weights."""
    return factorization.learn(docs.select("doc_id", "text"), labels, label, terms, **options)


def score(docs: DataFrame, machine: factorization.Machine | None, threshold: float = 0.3) -> DataFrame:
    """All columns of ``docs`` with ``score`` (0 to 1) and ``predicted`` (0 or 1), for every whole text.

    Words are compared without case and outer signs. Null and empty texts get the score of a text without words;
    repeated rows each get theirs; no shuffle; columns named like a result are replaced.
    """
    return factorization.apply(docs, machine, terms, threshold)
