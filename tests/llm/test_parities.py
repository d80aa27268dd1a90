"""Parity sketches of shingle sets refuse no similar pair, and refuse most others before they are multiplied."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollscore.llm.jaccard import PARITIES, documents, may_link, near_copies, parities, plausible


@pytest.mark.parametrize(("percent", "size"), [(80, 30), (85, 60), (85, 400), (85, 3000)])
def test_no_similar_pair_is_refused(spark, percent, size):
    rng = np.random.default_rng(size)
    rows, truth = [], []
    for i in range(300):
        n = int(rng.integers(1, size))
        x = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        y = np.concatenate([x[int(rng.integers(0, n // 4 + 1)) :], rng.integers(0, 1 << 63, int(rng.integers(0, n // 4 + 1)), dtype=np.uint64)])
        both = len(np.intersect1d(x, y))
        truth.append(100 * both >= percent * (len(x) + len(y) - both))
        rows.append((i, len(x), len(y), parities(np.sort(x)).tolist(), parities(np.sort(y)).tolist()))
    df = spark.createDataFrame(rows, "id long, n long, m long, x array<long>, y array<long>")
    kept = {r.id for r in df.where(may_link(F.col("n"), F.col("m"), F.col("x"), F.col("y"), percent)).collect()}
    assert {i for i, t in enumerate(truth) if t} <= kept
    assert any(truth) and (size > 400 or len(kept) < len(rows))
    assert all(len(r[3]) == PARITIES for r in rows)


def test_copies_that_do_not_link_are_not_multiplied(spark):
    """Copies of one text, each with two words of its own: all share columns, none links with another."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(120):
        own = list(base)
        for at in rng.choice(60, 2, replace=False):
            own[at] = f"x{i}at{at}"
        texts.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    sets = documents(docs, 4).select("class", "n", "sketch")
    pairs = sets.select(F.col("class").alias("a")).crossJoin(sets.select(F.col("class").alias("b"))).where("a < b")
    left = plausible(pairs, sets, 85).count()
    shingles = [{tuple(t.split()[k : k + 4]) for k in range(57)} for t in texts]
    similar = [(i, j) for i in range(120) for j in range(i) if 100 * len(shingles[i] & shingles[j]) >= 85 * len(shingles[i] | shingles[j])]
    assert len(similar) <= left < 120 * 119 // 2 // 10
    got = {r.id: r.component_id for r in near_copies(docs, id_column="id").collect()}
    assert all(got[i] == got[j] for i, j in similar) and len(set(got.values())) >= 120 - len(similar)
