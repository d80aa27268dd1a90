"""Terms of texts against a plain count, and the place of a feature in the machine."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from rollscore.llm import toxicity
from rollscore.llm.common import bare, mix
from rollscore.llm.factorization import TABLE, Machine

TEXTS = ["Stems stemmed, stemming STEMS!", None, "", "... --", "één ÉÉN _x_ x", "a a a"]


def plain_terms(text: str | None) -> set[int]:
    words = {bare(w) for w in (text or "").split()} - {""}
    found = {xxhash.xxh3_64_intdigest(w) % toxicity.BUCKETS for w in words}
    for length in toxicity.STEMS:
        stems = [w[:length] for w in words if len(w) > length]
        for stem in set(stems):
            for least in range(1, min(3, stems.count(stem)) + 1):
                h = np.array([xxhash.xxh3_64_intdigest(stem)], np.uint64) + np.uint64(16 * length + least)
                found.add(int(mix(h)[0] % np.uint64(toxicity.BUCKETS)))
    return found or {toxicity.BUCKETS}


def test_terms():
    doc, feature = toxicity.terms(pa.RecordBatch.from_arrays([pa.array(TEXTS)], ["text"]))
    assert [set(feature[doc == i].tolist()) for i in range(len(TEXTS))] == [plain_terms(t) for t in TEXTS]
    assert len(set(zip(doc.tolist(), feature.tolist(), strict=True))) == len(doc)


@pytest.mark.parametrize("kept", [[], [7], [3, 9, 10], [0, 5, TABLE + 9]])
def test_places(kept):
    none = np.zeros(len(kept))
    machine = Machine(np.array(kept, np.int64), none > 0, 0.0, none, np.zeros((len(kept), 2)))
    asked = np.array([0, 3, 4, 7, 9, 10, 11, TABLE + 9, TABLE + 10])
    assert machine.places(asked).tolist() == [kept.index(f) if f in kept else -1 for f in asked]
