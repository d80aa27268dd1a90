"""Whole-document packing against piece-by-piece best fit."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from rollscore.operators.packing import best_fit, pack_whole


def piece_by_piece(sizes, length):
    """Free space of each row after best-fit decreasing."""
    free = []
    for s in sorted(sizes, reverse=True):
        fits = [(f, i) for i, f in enumerate(free) if f >= s]
        if fits:
            _, i = min(fits)
            free[i] -= s
        else:
            free.append(length - s)
    return free


def filled(placings):
    """row -> list of (at, size)."""
    out = {}
    for p in placings:
        for k in range(p.count):
            out.setdefault(p.row + k // p.each, []).append((p.at + k % p.each * p.size, p.size))
    return out


@pytest.mark.parametrize("seed", range(40))
def test_best_fit_equals_piece_by_piece(seed):
    rng = random.Random(seed)
    length = rng.choice([1, 2, 7, 16, 100])
    sizes = [rng.randrange(1, length + 1) if rng.random() < 0.8 else rng.randrange(1, min(length, 4) + 1) for _ in range(rng.randrange(0, 300))]
    rows = filled(best_fit(Counter(sizes), length))
    assert Counter(s for r in rows.values() for _, s in r) == Counter(sizes)
    for r in rows.values():
        end = 0
        for at, size in sorted(r):
            assert at == end
            end = at + size
        assert end <= length
    free = Counter(length - sum(s for _, s in r) for r in rows.values())
    assert free == Counter(piece_by_piece(sizes, length)) and sorted(rows) == list(range(len(rows)))


def test_work_depends_on_sizes_not_on_pieces():
    counts = {s: 10**12 + s for s in range(1, 257)}
    placings = best_fit(counts, 256)
    assert sum(p.count for p in placings) == sum(counts.values()) and len(placings) < 2000
    tokens = sum(s * n for s, n in counts.items())
    rows = max(p.row + -(-p.count // p.each) for p in placings)
    assert tokens / (rows * 256) > 0.999


@pytest.mark.parametrize("part_rows", [100_000, 30])
def test_documents_stay_whole(spark, part_rows):
    rng = random.Random(3)
    docs = [(i, [i * 1000 + k for k in range(rng.choice([0, 1, 3, 5, 5, 5, 8, 15, 16, 17, 40]))]) for i in range(300)]
    docs += [(7, [1, 2, 3]), (None, [4, 5]), (None, [4, 5]), (8, None), (None, [])]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc long, tokens array<int>, size string, part int").repartition(5)
    packed = pack_whole(df, "doc", length=16, part_rows=part_rows)
    rows = packed.collect()
    pieces = []
    for r in rows:
        assert 0 < len(r.tokens) <= 16 and sum(d.size for d in r.documents) == len(r.tokens)
        at = 0
        for d in r.documents:
            pieces.append((d.id, tuple(r.tokens[at : at + d.size])))
            at += d.size
    want = [(i, tuple(t[k : k + 16])) for i, t in docs if t for k in range(0, len(t), 16)]
    assert Counter(pieces) == Counter(want)
    assert len(rows) == len(piece_by_piece([len(t) for _, t in want], 16))
    assert sorted(map(str, rows)) == sorted(map(str, pack_whole(df.repartition(2), "doc", length=16, part_rows=part_rows).collect()))


def test_empty_table(spark):
    assert pack_whole(spark.createDataFrame([], "doc long, tokens array<int>"), "doc").count() == 0
    assert pack_whole(spark.createDataFrame([(1, None), (2, [])], "doc long, tokens array<int>"), "doc").count() == 0
