"""Metadata columns of the quality features, nulls among them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from rollscore.llm.quality import BUCKETS, LOGS, SHARES, extractor


def test_metadata_is_a_feature_with_a_step_for_null():
    part = pa.RecordBatch.from_pydict({"text": ["some words", None, "", "more words"], "n_chars": pa.array([10, None, 0, 10], pa.int64())})
    doc, feature = extractor(("n_chars",))(part)
    base = BUCKETS + 256 * (len(SHARES) + len(LOGS))
    own = {int(d): int(f) - base for d, f in zip(doc, feature, strict=True) if f >= base}
    assert own == {0: int(np.floor(np.log2(11) * 2)), 1: 200, 2: 0, 3: own[0]}
    plain = extractor()(part)
    assert plain[1].max() < base
