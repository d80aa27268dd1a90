"""Windows around possible item shingles are all windows that can match."""

from __future__ import annotations

import numpy as np
import pytest

from rollscore.llm.contamination import near_hits, passes, window_keys


@pytest.mark.parametrize("seed", range(20))
def test_no_window_with_an_item_shingle_is_lost(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.choice([0, 1, 3, 15, 16, 17, 64, 200, 1000], 12)
    edges = np.concatenate([[0], np.cumsum(lengths)])
    runs = rng.integers(0, 1 << 63, edges[-1], dtype=np.uint64) << np.uint64(1)
    there = np.zeros(1 << 12, bool)
    there[(runs[rng.integers(0, len(runs), 4)] & np.uint64((1 << 12) - 1)).astype(int)] = True
    sizes, every_key = [4, 16, 32], np.ones(1 << 4, bool)
    some, bounds, owner = near_hits(runs, edges, sizes[-1], there)
    assert len(bounds) == len(owner) + 1 and bounds[-1] == len(some)
    text, key = window_keys(some, bounds, sizes, every_key)
    found = set(zip(owner[text].tolist(), key.tolist(), strict=True))
    # Keys whose least value is a shingle that may be an item's must be the same with and without the cut.
    all_text, all_key = window_keys(runs, edges, sizes, every_key)
    every = set(zip(all_text.tolist(), all_key.tolist(), strict=True))
    hits = runs[passes(there, runs)]
    from rollscore.llm.contamination import HASHES, key_of, multipliers

    least = {int(k) for size in sizes for h, m in enumerate(multipliers()[:HASHES]) for k in key_of(size, h, hits * m)}
    assert {(t, k) for t, k in every if k in least} <= found


def test_nothing_is_left_without_hits():
    runs, edges = np.arange(100, dtype=np.uint64), np.array([0, 40, 40, 100])
    some, bounds, owner = near_hits(runs, edges, 8, np.zeros(64, bool))
    assert not len(some) and bounds.tolist() == [0] and not len(owner)
    empty = near_hits(runs[:0], np.array([0, 0]), 8, np.zeros(64, bool))
    assert not len(empty[0]) and not len(empty[2])
