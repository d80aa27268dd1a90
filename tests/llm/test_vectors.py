"""Vector links where rows share ids."""

from __future__ import annotations

from rollscore.llm.vectors import near_vectors


def test_vectors_with_one_id_have_their_own_links(spark):
    rows = [(5, [1.0, 0.0, 0.0, 0.0]), (5, [0.0, 1.0, 0.0, 0.0]), (7, [1.0, 0.05, 0.0, 0.0]), (9, [0.0, 0.0, 1.0, 0.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, label string")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in near_vectors(df).collect())
    assert got == [(5, 0, 5, True), (5, 1, 5, True), (7, 1, 5, False), (9, 0, 9, True)]


def test_copies_and_shared_ids_meet(spark):
    """Two classes share id 3; the smallest id of either is that of all."""
    a, b = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    df = spark.createDataFrame([(1, a), (3, a), (3, b), (4, b), (4, b)], "vec_id long, embedding array<double>").selectExpr("*", "1 as label")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in near_vectors(df).collect())
    assert got == [(1, 1, 1), (3, 1, 1), (3, 2, 1), (4, 2, 1), (4, 2, 1)]
