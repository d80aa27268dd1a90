"""The median of the throughput: exact, and never gathered in one buffer."""

from __future__ import annotations

import math
import random

import pytest

from rollscore.operators.evaluation import eval_throughput
from rollscore.operators.skew import group_median


def lower_median(values):
    held = sorted((x for x in values if x is not None), key=lambda x: (math.isnan(x), x))
    return held[(len(held) + 1) // 2 - 1] if held else None


@pytest.mark.parametrize(("per_e", "steps"), [(64, 65_536), (1, 3)])
def test_median_is_exact(spark, per_e, steps):
    rng = random.Random(6)
    odd = [0.0, -0.0, -3.5, 5e-324, -1e308, 1e308, math.inf, -math.inf, math.nan, None]
    groups = {
        "wide": [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(500)],
        "near": [1 + rng.random() * 1e-9 for _ in range(501)],
        "ties": [rng.choice([1.5, 2.5, 2.5000000000000004]) for _ in range(500)],
        "odd": odd * 3 + [7.0],
        "nan": [math.nan, math.nan, 1.0],
        "one": [4.25],
        "none": [None, None],
        None: [rng.gauss(0, 1) for _ in range(200)],
    }
    rows = [(k, x) for k, v in groups.items() for x in v]
    df = spark.createDataFrame(rows, "task string, x double").repartition(7)
    got = {r._keys.task: r.m for r in group_median(df, ["task"], "x", "m", per_e, steps).collect()}
    want = {k: lower_median(v) for k, v in groups.items() if lower_median(v) is not None}
    assert set(got) == set(want)
    assert all(got[k] == want[k] or (math.isnan(got[k]) and math.isnan(want[k])) for k in want)


def test_throughput_gathers_no_group(spark):
    rows = [("a", float(i), 2) for i in range(1000)] + [(None, 3.0, 1), (None, None, 1), ("b", None, 1), ("c", 1.0, 0)]
    df = spark.createDataFrame(rows, "task string, seconds double, n_docs long")
    out = eval_throughput(df)
    got = {r.task: (r.runs, r.median_sec_per_doc) for r in out.collect()}
    assert got == {"a": (1000, 249.5), None: (2, 3.0), "b": (1, None), "c": (1, None)}
    plan = out._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "percentile" not in plan and "collect_" not in plan
