"""Joins, statistics and ranks that stay balanced when one key holds a large share of all rows.

A window or a plain join on such a key would put the whole group into one task. The helpers here look only at
pre-aggregated sizes, treat the few largest groups apart, and keep every row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A group larger than this is worth treating apart; smaller ones fit a task.
HOT_ROWS = 100_000
# At most this many groups are treated apart. Any group left out holds less than 1/HOT_KEYS of all rows, because at
# least HOT_KEYS groups are as large as it, so the ordinary shuffle of the rest is balanced.
HOT_KEYS = 10_000


def _equal(keys: Sequence[str], left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(left + k).eqNullSafe(F.col(right + k)) for k in keys])


def hot_groups(
    df: DataFrame, keys: Sequence[str], hot_rows: int | None = None, hot_keys: int | None = None
) -> DataFrame:
    """The largest groups of ``df`` as (``_hash``, ``_salts``): a 64-bit hash of the keys, and one salt per
    ``hot_rows`` rows.

    Fixed-width rows, at most ``hot_keys`` of them, so the table is always small enough to broadcast (160 kB by
    default), however wide the keys are. Only the key columns are read. Keys that share a hash are treated alike, which
    costs some spreading but never changes a result.
    """
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    sizes = df.groupBy(F.xxhash64(*keys).alias("_hash")).agg(F.count(F.lit(1)).alias("_rows"))
    largest = sizes.where(F.col("_rows") > hot_rows).orderBy(F.desc("_rows"), "_hash")
    largest = largest.limit(HOT_KEYS if hot_keys is None else hot_keys)
    return largest.select("_hash", F.ceil(F.col("_rows") / hot_rows).cast("int").alias("_salts"))


def with_salts(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    """Add ``_salts``: how many ways the row's group is split (null for ordinary groups). A map-side join."""
    return df.withColumn("_hash", F.xxhash64(*keys)).join(F.broadcast(hot), "_hash", "left").drop("_hash")


def _one_salt(spread_on: Sequence[str]) -> Column:
    return F.when(
        F.col("_salts").isNotNull(), F.pmod(F.xxhash64(*spread_on), F.col("_salts").cast("bigint")).cast("int")
    ).otherwise(F.lit(0))


def attach_by_key(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread_on: Sequence[str],
    hot_rows: int | None = None,
    hot_keys: int | None = None,
) -> DataFrame:
    """Left outer join of ``left`` with a ``right`` that has at most one row per key; adds ``_matched``.

    A salted join: rows of a hot group are split over its salts, and the one partner row is repeated once per salt. The
    repeats come to at most rows / ``hot_rows`` + ``hot_keys`` in all, and no size of ``right`` is assumed. Null keys
    match each other. Row order is not kept.
    """
    keys = list(keys)
    payload = [c for c in right.columns if c not in keys]
    hot = hot_groups(left, keys, hot_rows, hot_keys)
    salted = with_salts(left, keys, hot).withColumn("_salt", _one_salt(spread_on))
    every_salt = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)).alias("_r_salt")
    partners = with_salts(right, keys, hot).select(
        *[F.col(k).alias(f"_r_{k}") for k in keys], F.struct(F.lit(True).alias("hit"), *payload).alias("_row"), every_salt
    )
    same = _equal(keys, "", "_r_") & (F.col("_salt") == F.col("_r_salt"))
    return salted.join(partners, same, "left").select(
        *left.columns,
        *[F.col("_row")[c].alias(c) for c in payload],
        F.coalesce(F.col("_row")["hit"], F.lit(False)).alias("_matched"),
    )


def attach_group_stats(
    df: DataFrame,
    keys: Sequence[str],
    spread_on: Sequence[str],
    stats: dict[str, Column],
    hot_rows: int | None = None,
    hot_keys: int | None = None,
) -> DataFrame:
    """Add group aggregates to every row without ever holding a hot group in one task.

    Ordinary groups use a window: one pass over the rows, one shuffle. Hot groups are aggregated with map-side combine
    and their few result rows (keys and numbers) broadcast; their rows pass the window's shuffle split over salts.
    Without hot groups that second branch is empty and is not run.
    """
    keys = list(keys)
    salted = with_salts(df, keys, hot_groups(df, keys, hot_rows, hot_keys))
    hot = salted.where(F.col("_salts").isNotNull()).groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()])
    hot = hot.select(*[F.col(k).alias(f"_h_{k}") for k in keys], F.struct(*stats).alias("_hot"))
    marked = salted.join(F.broadcast(hot), _equal(keys, "", "_h_"), "left").withColumn("_salt", _one_salt(spread_on))
    group, is_hot = Window.partitionBy(*keys, "_salt"), F.col("_hot").isNotNull()
    return marked.select(
        *df.columns, *[F.when(is_hot, F.col("_hot")[n]).otherwise(c.over(group)).alias(n) for n, c in stats.items()]
    )


def hash_ordinal(df: DataFrame, digest: Column, tie: Sequence[str], out: str, prefix: int = 4) -> DataFrame:
    """Global 0-based position of each row in the order (``digest``, ``tie``), without a global sort.

    ``digest`` is a uniform hex string. Its first ``prefix`` digits cut the order into 16**prefix near-equal ranges:
    rows are numbered inside a range, and each range starts where the smaller ranges end. The start table has at most
    16**prefix rows, whatever the data size.
    """
    cut = df.withColumn("_digest", digest).withColumn("_range", F.substring("_digest", 1, prefix))
    inside = Window.partitionBy("_range").orderBy("_digest", *tie)
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        cut.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    numbered = cut.withColumn("_in", F.row_number().over(inside) - 1)
    return (
        numbered.join(F.broadcast(starts), "_range")
        .withColumn(out, (F.col("_start") + F.col("_in")).cast("bigint"))
        .drop("_range", "_digest", "_start", "_in")
    )


def running_total(df: DataFrame, row_id: str, order: Sequence[str], amount: Column, out: str) -> DataFrame:
    """Sum of ``amount`` over all rows before each row in the order (``row_id``, ``order``), without a global sort.

    ``row_id`` is an integer, of any size and with any gaps; null ids come first. Rows are summed inside ranges of 4,096
    ids. The start of a range comes from the totals of the ranges before it, summed in a tree: a node has at most 8,192
    children, and four levels hold every 64-bit id. So no window is larger than a range or a node.
    """
    cut = df.withColumn("_range", F.struct(F.shiftright(F.col(row_id).cast("bigint"), 12).alias("id"))).withColumn("_amount", amount)
    totals = [cut.groupBy(F.col("_range.id").alias("_k")).agg(F.sum("_amount").alias("_sum"))]
    for _ in range(3):
        totals.append(totals[-1].groupBy(F.shiftright("_k", 13).alias("_k")).agg(F.sum("_sum").alias("_sum")))
    before = Window.partitionBy("_up").orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    starts = None
    for level in reversed(totals):
        up = F.lit(0) if starts is None else F.shiftright("_k", 13)
        inside = level.withColumn("_up", up).withColumn("_in", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
        if starts is not None:
            above = starts.select(F.col("_k").alias("_parent"), F.col("_start").alias("_above"))
            inside = inside.join(above, F.col("_up").eqNullSafe(F.col("_parent")))
        start = F.col("_in") + (F.lit(0) if starts is None else F.col("_above"))
        starts = inside.select("_k", start.alias("_start"))
    starts = starts.select(F.struct(F.col("_k").alias("id")).alias("_range"), F.col("_start").alias("_base"))
    rows = Window.partitionBy("_range").orderBy(row_id, *order).rowsBetween(Window.unboundedPreceding, -1)
    summed = cut.withColumn("_in", F.coalesce(F.sum("_amount").over(rows), F.lit(0)))
    total = (F.col("_base") + F.col("_in")).cast("bigint")
    return summed.join(starts, "_range").withColumn(out, total).drop("_range", "_amount", "_in", "_base")


def unit_dense_rank(
    df: DataFrame, keys: Sequence[str], value: str, out: str, spread_on: Sequence[str], buckets: int = 100_000
) -> DataFrame:
    """Dense rank of ``value`` (within 0..1, highest first) per key, without sorting a key's rows in one task.

    Null keys and null values are values too; a null value ranks last. Distinct values are ranked inside equal-width buckets; a bucket starts after the distinct values of all higher
    buckets of its key. At most ``buckets`` + 1 counts per key pass through the running sum.
    """
    names, keys = list(keys), ["_keys"]
    df = df.withColumn("_keys", F.struct(*names, F.lit(0).alias("_one"))).withColumn("_value", F.struct(value))
    distinct = df.select(*keys, value, "_value").distinct().withColumn("_b", F.floor(F.col(value) * buckets).cast("int"))
    inside = Window.partitionBy(*keys, "_b").orderBy(F.desc(value))
    above = Window.partitionBy(*keys).orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        distinct.withColumn("_b", F.coalesce("_b", F.lit(-1)))
        .groupBy(*keys, "_b")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*keys, "_b", F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_start"))
    )
    ranked = (
        distinct.withColumn("_b", F.coalesce("_b", F.lit(-1)))
        .withColumn("_in", F.dense_rank().over(inside))
        .join(starts, [*keys, "_b"])
        .select(*keys, "_value", (F.col("_start") + F.col("_in")).cast("int").alias(out))
    )
    return attach_by_key(df, ranked, [*keys, "_value"], spread_on).drop("_matched", "_keys", "_value")


def group_median(df: DataFrame, keys: Sequence[str], value: str, out: str, per_e: int = 64, steps: int = 65_536) -> DataFrame:
    """One row per key with values: ``_keys`` (a struct of the keys) and the lower median of ``value``, exact.

    Rows are counted per value with map-side combine, so no buffer or task holds the values of a key. The running sum of
    a key's logarithmic buckets (``per_e`` for a factor e, at most about 190,000 in all) names the bucket of the median.
    That bucket alone is cut into ``steps`` equal parts between its ends, and the values of one part are ordered. Null
    keys are keys, null values are left out, NaN comes last.
    """

    def holding(rows: DataFrame, order: str) -> DataFrame:
        """The row of each key that holds the rank, which then counts from the row's start."""
        before = Window.partitionBy("_keys").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        start = F.coalesce(F.sum("_n").over(before), F.lit(0))
        found = rows.withColumn("_start", start).where("_start < _rank and _rank <= _start + _n")
        return found.withColumn("_rank", F.col("_rank") - F.col("_start")).drop("_n", "_start")

    v = F.col("_v")
    bucket = F.floor(F.least(F.log(F.abs(v)), F.lit(1000.0)) * per_e) + 1000 * per_e
    bucket = F.when(F.isnan(v), 2001 * per_e).when(v == 0, 0).otherwise(F.when(v < 0, -bucket).otherwise(bucket))
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(F.struct(*keys, F.lit(0).alias("_one")).alias("_keys"), F.col(value).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_b", bucket)
    )
    buckets = counts.groupBy("_keys", "_b").agg(F.sum("_n").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    middle = F.floor((F.sum("_n").over(Window.partitionBy("_keys")) + 1) / 2)
    step = F.when(F.col("_hi") > F.col("_lo"), F.floor((v - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * (steps - 1))).otherwise(0)
    inside = counts.join(holding(buckets.withColumn("_rank", middle), "_b"), ["_keys", "_b"]).withColumn("_s", step)
    parts = inside.groupBy("_keys", "_s").agg(F.sum("_n").alias("_n"), F.first("_rank").alias("_rank"))
    last = inside.drop("_rank").join(holding(parts, "_s"), ["_keys", "_s"])
    return holding(last, "_v").select("_keys", v.alias(out))
