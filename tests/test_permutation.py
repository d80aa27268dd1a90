"""Epoch orders: one to one for every size, and the way back."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rollscore.operators.permutation import _halves, epoch_ordinal, epoch_position


def test_halves_cover_little_more_than_n():
    for n in range(1, 10_001):
        a, b = _halves(n)
        assert n <= a * b <= n + a and abs(a - b) <= 2


@pytest.mark.parametrize("n", [1, 2, 10, 101, 4097, 10_000])
def test_one_to_one_and_back(spark, n):
    df = spark.range(n).withColumn("p", epoch_position("id", n, epoch=3)).withColumn("back", epoch_ordinal("p", n, epoch=3))
    rows = df.collect()
    assert sorted(r.p for r in rows) == list(range(n)) and all(r.back == r.id for r in rows)


def test_sizes_up_to_ten_thousand(spark):
    """All sizes would be 50 million rows: the small ones and every 499th."""
    wrong = []
    for n in [*range(1, 33), *range(499, 10_001, 499)]:
        got = spark.range(n).select(epoch_position("id", n, seed=7).alias("p")).agg(F.count_distinct("p"), F.min("p"), F.max("p")).first()
        wrong += [n] if tuple(got) != (n, 0, n - 1) else []
    assert wrong == []


def test_same_order_from_any_partitioning(spark):
    n = 5000
    orders = []
    for parts in (1, 7):
        rows = spark.range(n).repartition(parts).select("id", epoch_position("id", n).alias("p")).collect()
        orders.append(sorted((r.p, r.id) for r in rows))
    assert orders[0] == orders[1]
    order = [i for _, i in orders[0]]
    assert sum(abs(a - b) == 1 for a, b in zip(order, order[1:], strict=False)) < 20
    other = spark.range(n).select(epoch_position("id", n, epoch=1).alias("p")).collect()
    assert [r.p for r in other] != [p for p, _ in sorted(orders[0], key=lambda x: x[1])]


def test_large_numbers_and_strangers(spark):
    n = 10**12 + 7
    df = spark.range(0, n, n // 1000).select("id", epoch_position("id", n).alias("p")).withColumn("back", epoch_ordinal("p", n))
    assert all(0 <= r.p < n and r.back == r.id for r in df.collect())
    odd = spark.sql("select explode(array(-1L, 10L, null, 3L)) as id").select("id", epoch_position("id", 10).alias("p")).collect()
    assert [r.p is None for r in odd] == [True, True, True, False]
