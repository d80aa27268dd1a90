"""Similar sets share a block of columns; others meet seldom, and pairs to be multiplied grow with the group, not its square."""

from __future__ import annotations

import numpy as np
import pytest

from rollscore.llm import jaccard


def edited(rng, x, most):
    """Random columns left out and put in."""
    kept = x[rng.permutation(len(x))[int(rng.integers(0, most + 1)) :]]
    return np.unique(np.concatenate([kept, rng.integers(0, 1 << 64, int(rng.integers(0, most + 1)), dtype=np.uint64)]))


@pytest.mark.parametrize(("percent", "size"), [(50, 12), (80, 12), (80, 120), (85, 14), (85, 60), (85, 700), (99, 300), (100, 9)])
def test_similar_sets_share_a_block(percent, size):
    rng = np.random.default_rng(size * 100 + percent)
    rows = []
    for _ in range(1500):
        x = np.unique(rng.integers(0, 1 << 64, int(rng.integers(1, size)), dtype=np.uint64))
        rows += [x, edited(rng, x, len(x) * (100 - percent) // 100 + 1)]
    hashes, whose, need = jaccard.block_hashes(rows, percent)
    own = np.split(hashes[np.argsort(whose, kind="stable")], np.cumsum(np.bincount(whose, minlength=len(rows)))[:-1])
    similar = 0
    for i in range(0, len(rows), 2):
        both = len(np.intersect1d(rows[i], rows[i + 1]))
        if len(rows[i + 1]) and both < max(len(rows[i]), len(rows[i + 1])):
            if 100 * both >= percent * (len(rows[i]) + len(rows[i + 1]) - both):
                similar += 1
                steps = np.intersect1d(own[i], own[i + 1]) & np.uint64((1 << jaccard.STEP_BITS) - 1)
                assert len(steps) and np.bincount(steps.astype(int)).max() >= max(need[i : i + 2]), (rows[i], rows[i + 1])
    assert similar or percent == 100
    assert not len(jaccard.block_hashes([np.empty(0, np.uint64)], percent)[0])


def test_sets_with_many_empty_blocks_meet():
    """Columns that lie together leave most blocks empty; these are shown then."""
    x = np.arange(1, 201, dtype=np.uint64)
    y = np.concatenate([x[16:], np.arange(1, 15, dtype=np.uint64) << np.uint64(58)])
    both = len(np.intersect1d(x, y))
    assert 100 * both >= 85 * (len(x) + len(y) - both)
    hashes, whose, _ = jaccard.block_hashes([x, np.sort(y)], 85)
    assert len(np.intersect1d(hashes[whose == 0], hashes[whose == 1]))


def test_a_common_line_brings_few_texts_together(spark):
    rng = np.random.default_rng(5)
    line = " ".join(f"line{i}" for i in range(20))
    texts = [f"{line} " + " ".join(f"w{i}" for i in rng.integers(0, 10**9, 60)) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    blocks = jaccard.documents(docs, 4, 85).where("n is null")
    shared = blocks.groupBy("block").count().where("count > 1")
    assert sum(r["count"] for r in shared.collect()) < blocks.count() / 10


def test_pairs_grow_with_the_group(spark, monkeypatch):
    """Near copies of one text that are about as different as the limit allows: most are not similar to a given one."""
    counts = {}

    def counted(df, name):
        out = kept(df, name)
        counts[name] = counts.get(name, 0) + out.count()
        return out

    kept = jaccard.written
    monkeypatch.setattr(jaccard, "written", counted)
    rng = np.random.default_rng(9)
    texts = []
    for i in range(300):
        own = [f"w{k}" for k in range(150)]
        for at in rng.choice(150, 2, replace=False):
            own[at] = f"x{i}at{at}"
        texts.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(3)
    got = {r.id: r.component_id for r in jaccard.near_copies(docs, id_column="id", percent=81).collect()}
    shingles = [{tuple(t.split()[k : k + 4]) for k in range(147)} for t in texts]
    top = list(range(300))
    for i in range(300):
        for j in range(i):
            if top[i] != top[j] and 100 * len(shingles[i] & shingles[j]) >= 81 * len(shingles[i] | shingles[j]):
                a, b = sorted((top[i], top[j]))
                top = [a if x == b else x for x in top]
    assert got == dict(enumerate(top)) and len(set(top)) < 150
    assert sum(counts[k] for k in ("star", "near", "rest-pairs") if k in counts) < 300 * 10, counts
