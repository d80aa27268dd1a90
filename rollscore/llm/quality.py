"""Quality: a factorization machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from . import factorization
from .common import bare, split_words, texts_of, word_hashes

BUCKETS = 1 << 20
#: Steps into which each share between 0 and 1 is cut, and each logarithm of a count.
STEPS = 16
SHARES = ("upper", "digit", "space", "sign", "bar", "other", "distinct", "commonest", "repeated", "ends_in_sign", "only_signs", "distinct_lines")
LOGS = ("bytes", "words", "lines", "word_length")


def byte_classes() -> np.ndarray:
    """For each byte: 0 lower case, 1 upper case, 2 digit, 3 space, 4 sign, 5 bar, 6 not ASCII."""
    b = np.arange(256)
    out = np.full(256, 4)
    out[(b >= 97) & (b <= 122)] = 0
    out[(b >= 65) & (b <= 90)] = 1
    out[(b >= 48) & (b <= 57)] = 2
    out[(b == 32) | ((b >= 9) & (b <= 13))] = 3
    out[b == 124] = 5
    out[b >= 128] = 6
    return out


CLASSES = byte_classes()


def statistics(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shares (texts x SHARES), logarithms (texts x LOGS), and the hashed bare words with their text numbers."""
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    ends = offsets - offsets[0]
    size = np.diff(ends)
    kind = CLASSES[data]
    count = {}
    for name, k in (("lower", 0), ("upper", 1), ("digit", 2), ("space", 3), ("sign", 4), ("bar", 5), ("other", 6)):
        count[name] = np.diff(np.concatenate([[0], np.cumsum(kind == k)])[ends])
    words, bounds = split_words(texts)
    row = np.repeat(np.arange(n), np.diff(bounds))
    exact = word_hashes(words)
    plain = word_hashes(words, bare)
    many = np.maximum(np.diff(bounds), 1)
    order = np.lexsort((exact, row))
    r, h = row[order], exact[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(new)
    run = np.diff(np.append(at, len(r)))
    commonest = np.zeros(n)
    np.maximum.at(commonest, r[at], run)
    same = np.zeros(len(row), bool)
    same[1:] = (row[1:] == row[:-1]) & (exact[1:] == exact[:-1])
    tail = pc.match_substring_regex(words, r"[^\p{L}\p{N}.,;:]$").to_numpy(zero_copy_only=False)
    per = lambda flag: np.bincount(row, flag, n)
    lines = [t.split("\n") for t in texts.to_pylist()]
    line_count = np.array([len(x) for x in lines])
    letters = np.maximum(count["upper"] + count["lower"], 1)
    size1 = np.maximum(size, 1)
    shares = np.stack(
        [
            count["upper"] / letters,
            *[count[c] / size1 for c in ("digit", "space", "sign", "bar", "other")],
            np.bincount(r[at], minlength=n) / many,
            commonest / many,
            per(same) / many,
            per(tail) / many,
            per(plain == 0) / many,
            np.array([len(set(x)) for x in lines]) / line_count,
        ],
        axis=1,
    )
    logs = np.log2(1 + np.stack([size, np.diff(bounds), line_count, (size - count["space"]) / many], axis=1))
    real = plain != 0
    return shares, logs, plain[real], row[real]


def extractor(metadata: tuple[str, ...] = ()) -> Callable[[pa.RecordBatch], factorization.Features]:
    """Features of a batch: hashed words, and one step of every statistic and of every numeric metadata column."""

    def features(part: pa.RecordBatch) -> factorization.Features:
        shares, logs, plain, row = statistics(texts_of(part, "text"))
        n = part.num_rows
        columns = [*np.floor(np.sqrt(np.clip(shares, 0, 1)) * (STEPS - 1)).T, *np.floor(logs * 2).T]
        for name in metadata:
            value = pc.fill_null(part.column(name).cast(pa.float64()), np.nan).to_numpy(zero_copy_only=False)
            columns.append(np.where(np.isfinite(value), np.floor(np.log2(1 + np.abs(np.nan_to_num(value))) * 2), 200))
        base = BUCKETS
        doc, feature = [], []
        for k, c in enumerate(columns):
            doc.append(np.arange(n))
            feature.append(base + 256 * k + c.astype(np.int64))
        wide = BUCKETS + 256 * len(columns)
        both = np.unique(row * wide + (plain % np.uint64(BUCKETS)).astype(np.int64))
        return np.concatenate([both // wide, *doc]), np.concatenate([both % wide, *feature])

    return features


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", metadata: tuple[str, ...] = (), **options) -> factorization.Machine | None:
    """Learns from at most about ``sample`` (8000) labelled documents; ``metadata`` names numeric columns of ``docs``."""
    return factorization.learn(docs.select("doc_id", "text", *metadata), labels, label, extractor(metadata), **options)


def score(docs: DataFrame, machine: factorization.Machine | None, threshold: float = 0.5, metadata: tuple[str, ...] = ()) -> DataFrame:
    """All columns of ``docs`` with ``score`` (0 to 1) and ``predicted`` (0 or 1), for every whole text.

    Null texts count as empty and empty ones get a score from their statistics; a null in metadata is a step of its
    own; repeated rows each get theirs; no shuffle; columns named like a result are replaced.
    """
    return factorization.apply(docs, machine, extractor(metadata), threshold)
