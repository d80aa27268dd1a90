"""Quantile sketches: error bound against exact quantiles, merging, odd values."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from rollscore.operators.sketches import merge_sketches, quantile_sketch, sketch_quantiles

PROBABILITIES = [0.0, 0.01, 0.25, 0.5, 0.9, 0.999, 1.0]


def exact(values, p):
    held = sorted(v for v in values if v is not None and not math.isnan(v))
    return held[max(math.ceil(p * len(held)), 1) - 1]


def data():
    rng = random.Random(11)
    steps = {
        0: [rng.lognormvariate(0, 3) for _ in range(3000)],
        1: [-rng.expovariate(0.1) for _ in range(500)] + [0.0, -0.0] * 40,
        2: [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(700)],
        3: [5e-324, 1.7e308, -1.7e308, -5e-324, math.inf, -math.inf, math.nan, None] * 5,
        4: [1.0] * 1000 + [1.0000001],
        5: [7.25],
    }
    return [(s, v) for s, values in steps.items() for v in values], steps


@pytest.mark.parametrize("error", [0.01, 0.2])
def test_error_stays_within_the_bound(spark, error):
    rows, steps = data()
    df = spark.createDataFrame(rows, "step int, x double").repartition(9)
    got = sketch_quantiles(quantile_sketch(df, ["x"], ["step"], error), PROBABILITIES, ["step"]).collect()
    assert len(got) == len(steps) * len(PROBABILITIES)
    for r in got:
        values = steps[r.step]
        want = exact(values, r.probability)
        assert r.n == sum(v is not None and not math.isnan(v) for v in values)
        assert r.low <= want <= r.high
        # Denormal doubles have fewer digits than any bound asks for.
        assert r.value == want or abs(r.value - want) <= error * abs(want) * (1 + 1e-9) + 1e-320


def test_merging_steps_equals_the_sketch_of_their_rows(spark):
    rows, steps = data()
    df = spark.createDataFrame(rows, "step int, x double").withColumn("y", F.col("x") * 2).repartition(5)
    kept = quantile_sketch(df, ["x", "y"], ["step"])
    ranged = merge_sketches(kept.where("step between 1 and 4"))
    whole = quantile_sketch(df.where("step between 1 and 4"), ["x", "y"], [])
    assert sorted(ranged.collect()) == sorted(whole.select(ranged.columns).collect())
    values = [v for s in (1, 2, 3, 4) for v in steps[s]]
    for r in sketch_quantiles(ranged.where("measure = 'x'"), PROBABILITIES).collect():
        want = exact(values, r.probability)
        assert r.low <= want <= r.high


def test_buckets_are_in_the_order_of_values(spark):
    rng = random.Random(3)
    values = [rng.choice([-1, 1]) * 10 ** rng.uniform(-320, 308) for _ in range(400)] + [0.0, math.inf, -math.inf, 5e-324]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = sorted((r.bucket, r.least, r.most) for r in quantile_sketch(df, ["x"], []).collect())
    assert all(a[2] < b[1] for a, b in zip(rows, rows[1:], strict=False))
    # No bucket but the denormal ones spans more than its factor.
    assert all(m == l or abs(l) < 1e-300 or max(abs(l), abs(m)) / min(abs(l), abs(m)) <= 1.01 / 0.99 * (1 + 1e-9) for _, l, m in rows)


def test_empty_null_and_unsound_input(spark):
    df = spark.createDataFrame([(1, None), (1, math.nan)], "step int, x double")
    assert sketch_quantiles(quantile_sketch(df, ["x"], ["step"]), [0.5], ["step"]).count() == 0
    assert quantile_sketch(df.limit(0), ["x"], ["step"]).count() == 0
    with pytest.raises(ValueError, match="error"):
        quantile_sketch(df, ["x"], ["step"], 0.0)


def test_no_group_is_gathered(spark):
    df = spark.range(1000).selectExpr("id % 3 as step", "cast(id as double) as x")
    plan = sketch_quantiles(quantile_sketch(df, ["x"], ["step"]), [0.5], ["step"])._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "percentile" not in plan and "collect_" not in plan
