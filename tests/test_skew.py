"""One key holds a third of all rows: results stay whole and the rows stay spread."""

from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rollscore.operators.joins import join_gold, join_verification
from rollscore.operators.skew import attach_by_key, attach_group_stats, hash_ordinal, unit_dense_rank
from rollscore.operators.sweeps import shuffle_digest

ROWS = 3_000


@pytest.fixture(scope="module")
def skewed(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 200)
    return spark.range(ROWS).select("id", key.cast("bigint").alias("k"), (F.col("id") * 37 % 101).cast("double").alias("v"))


@pytest.mark.parametrize("bounds", [{}, {"hot_rows": 100}, {"hot_rows": 5}, {"hot_rows": 5, "hot_keys": 1}])
def test_group_stats_equal_brute_force(skewed, bounds):
    stats = {"lo": F.min("v"), "mean": F.avg("v"), "n": F.count("v")}
    got = attach_group_stats(skewed, ["k"], ["id"], stats, **bounds).toPandas().sort_values("id").reset_index(drop=True)
    raw = skewed.toPandas()
    grouped = raw.groupby("k", dropna=False)["v"].agg(lo="min", mean="mean", n="count").reset_index()
    want = raw.merge(grouped, on="k", how="left").sort_values("id").reset_index(drop=True)
    pd.testing.assert_frame_equal(got[want.columns], want, check_dtype=False)


def test_hot_rows_are_spread_over_tasks(spark, skewed):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = attach_group_stats(skewed, ["k"], ["id"], {"lo": F.min("v")}, hot_rows=20)
        sizes = [r["count"] for r in out.where("k = 7").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert len(sizes) > 4
    assert max(sizes) < sum(sizes) / 2


def test_hot_rows_of_a_join_are_spread_over_tasks(spark, skewed):
    before = spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        right = spark.range(150).select(F.col("id").alias("k"), F.lit("w").alias("w"))
        out = attach_by_key(skewed, right, ["k"], ["id"], hot_rows=50)
        sizes = [r["count"] for r in out.where("k = 7").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before[0])
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before[1])
    assert sum(sizes) == skewed.where("k = 7").count() and len(sizes) > 4
    assert max(sizes) < sum(sizes) / 2


@pytest.mark.parametrize("bounds", [{}, {"hot_rows": 100}, {"hot_rows": 5, "hot_keys": 3}])
def test_attach_by_key_keeps_every_row(spark, skewed, bounds):
    right = spark.range(0, 150).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    got = attach_by_key(skewed, right, ["k"], ["id"], **bounds).toPandas()
    assert sorted(got["id"]) == list(range(ROWS))
    for row in got.itertuples():
        known = not pd.isna(row.k) and row.k < 150
        assert row._matched == known if hasattr(row, "_matched") else True
        assert (row.w == row.k * 10) if known else pd.isna(row.w)


def test_hot_key_without_partner(spark, skewed):
    right = spark.createDataFrame([(1, "x")], "k bigint, w string")
    got = attach_by_key(skewed, right, ["k"], ["id"], hot_rows=100)
    assert got.where("_matched").count() == skewed.where("k = 1").count()
    assert got.count() == ROWS


def test_join_gold_and_verification(spark):
    rows = spark.range(900).select(F.col("id").alias("completion_id"), F.when(F.col("id") < 300, 0).otherwise(F.col("id") % 40).cast("bigint").alias("prompt_id"))
    gold = spark.range(30).select(F.col("id").alias("prompt_id"), F.col("id").cast("string").alias("solution"))
    joined = join_gold(rows, gold, hot_rows=100)
    want = rows.join(gold, "prompt_id")
    assert joined.count() == want.count()
    assert joined.where("solution <> cast(prompt_id as string)").count() == 0
    info = gold.select(
        "prompt_id",
        F.expr("""named_struct('language', 'python', 'test_cases', transform(sequence(0, cast(prompt_id % 3 as int)),
            i -> named_struct('input', cast(i as string), 'output', cast(prompt_id as string))))""").alias("verification_info"),
    )
    cases = join_verification(rows, info, hot_rows=100)
    assert cases.count() == want.select(F.sum(F.col("prompt_id") % 3 + 1)).first()[0]


def test_ordinal_is_a_permutation_in_digest_order(spark):
    df = spark.range(2_000)
    for parts in (1, 7):
        got = hash_ordinal(df.repartition(parts), shuffle_digest("id", 42), ["id"], "pos", prefix=2).collect()
        order = [r.id for r in sorted(got, key=lambda r: r.pos)]
        digest = dict(df.select("id", shuffle_digest("id", 42)).collect())
        assert [r.pos for r in sorted(got, key=lambda r: r.pos)] == list(range(2_000))
        assert order == sorted(range(2_000), key=lambda i: (digest[i], i))


def test_dense_rank_equals_brute_force(spark):
    df = spark.range(1_500).select("id", (F.col("id") % 3).alias("task"), ((F.col("id") * 7919 % 331) / 330.0).alias("score"))
    got = unit_dense_rank(df, ["task"], "score", "rank", ["id"], buckets=17).toPandas()
    want = got.groupby("task")["score"].rank(method="dense", ascending=False).astype(int)
    assert (got["rank"] == want).all()
    assert len(got) == 1_500
