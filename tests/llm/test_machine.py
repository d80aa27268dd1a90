"""The factorization machine: pairs of words that say nothing alone, odd rows, and ranks of held-out rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollscore.llm import toxicity
from rollscore.llm.common import table
from rollscore.llm.factorization import evidence, fit, row_sums
from rollscore.llm.queries import QUERIES

ROWS = 4000


@pytest.fixture(scope="module")
def pairs(spark):
    """Texts whose label is that one of two words is there, but not both."""
    rng = np.random.default_rng(1)
    words = rng.integers(2, 40, (ROWS, 10))
    words[:, 0] = np.where(rng.random(ROWS) < 0.5, 0, words[:, 0])
    words[:, 1] = np.where(rng.random(ROWS) < 0.5, 1, words[:, 1])
    label = ((words == 0).any(1) ^ (words == 1).any(1)).astype(int)
    texts = [" ".join(f"w{chr(97 + w // 6)}{chr(97 + w % 6)}rd" for w in row) for row in words]
    df = spark.createDataFrame([(i, t, int(k)) for i, (t, k) in enumerate(zip(texts, label, strict=True))], "doc_id long, text string, toxic int")
    return df.repartition(4).cache()


def share_right(pairs, **options):
    machine = toxicity.train(pairs, pairs.where("doc_id < 3000"), **options)
    got = toxicity.score(pairs.where("doc_id >= 3000"), machine, threshold=0.5)
    return got.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int"))).first()[0]


def test_pairs_that_say_nothing_alone_are_learned(pairs):
    assert share_right(pairs) > 0.95
    assert share_right(pairs, rank=0) < 0.65


def ranks_right(rows):
    """The chance that a row of label 1 has a higher score than one of label 0."""
    score, y = np.array([r.score for r in rows]), np.array([r.y for r in rows])
    ones, zeros = score[y == 1][:, None], score[y == 0][None]
    return (ones > zeros).mean() + (ones == zeros).mean() / 2


@pytest.mark.parametrize(("query", "label", "least_rank", "least_recall"), [("op8_toxicity", "toxic", 0.9, 0.6), ("op10_quality", "quality", 0.98, 0.95)])
def test_held_out_rows(spark, sf_dir, query, label, least_rank, least_recall):
    folder = sf_dir.replace("sf0.001", "sf0.01")
    rows = QUERIES[query](spark, folder).join(table(spark, folder, "labels", "doc_id", F.col(label).alias("y")), "doc_id").where("held_out and y in (0, 1)").collect()
    assert ranks_right(rows) > least_rank
    assert np.mean([r.predicted for r in rows if r.y == 1]) > least_recall
    assert np.mean([r.predicted for r in rows if r.y == 0]) < 0.05


def test_same_machine_from_any_order(pairs):
    some = pairs.where("doc_id < 300")
    a, b = (toxicity.train(some.repartition(n), some) for n in (1, 5))
    assert np.array_equal(a.kept, b.kept) and np.array_equal(a.factor, b.factor) and a.bias == b.bias


def test_rows_without_features_and_empty_sums():
    machine = fit(4, (np.array([0, 0, 2]), np.array([7, 9, 7])), np.array([1.0, 0, 1, 0]), np.ones(4))
    assert machine.kept.tolist() == [7, 9]
    scores = machine.scores(3, (np.array([0, 2]), np.array([7, 8])))
    assert np.isfinite(scores).all() and scores[1] == scores[2] < scores[0]
    assert row_sums(np.array([0, 0, 2, 2]), np.array([1.0, 2.0])).tolist() == [0, 3, 0]
    n, z = evidence(4, np.array([0, 2, 0, 1, 2, 3]), np.array([0, 0, 1, 1, 1, 1]), np.array([1.0, 0, 1, 0]), 2)
    assert n.tolist() == [2, 4] and z[0] == pytest.approx(2.0) and z[1] == 0


def test_learnable_rows_only(spark):
    df = spark.createDataFrame([(1, "a b", 1), (2, None, 0), (None, "c", 1), (3, "", None), (2, "twice", 0)], "doc_id long, text string, toxic int")
    machine = toxicity.train(df, df)
    assert toxicity.score(df, machine).count() == 5
    assert toxicity.train(df.where("doc_id = 1"), df) is None
