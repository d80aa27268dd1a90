"""Mergeable quantile sketches with a bound on the relative error.

A sketch is rows: how many values of a group fall into each logarithmic bucket, with the least and the greatest of them.
Sketches of parts add up to exactly the sketch of the whole, in any order, so one that is kept per step answers for any
range of steps without the rows. A bucket spans less than a factor of (1 + error) / (1 - error). The number of buckets
of a group is bounded by the range of doubles, whatever the number of its rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_ERROR = 0.01
SKETCH = ["bucket", "n", "least", "most"]


def bucket_scale(error: float) -> tuple[float, int]:
    """Width of a bucket in natural logarithms, and what is added to make the numbers of positive values positive."""
    width = math.log((1 + error) / (1 - error))
    # The least positive double is about exp(-745).
    return width, math.ceil(746 / width)


def bucket_of(value: Column, error: float) -> Column:
    """Number of the bucket of a value, in the order of the values: 0 for zero, negative for negative values.

    Infinite values have buckets of their own at both ends.
    """
    width, shift = bucket_scale(error)
    size = F.abs(value)
    place = F.when(size == float("inf"), F.lit(2 * shift)).otherwise(F.ceil(F.log(size) / F.lit(width)) + F.lit(shift))
    return F.when(value == 0, F.lit(0)).otherwise(F.signum(value) * place).cast("int")


def quantile_sketch(df: DataFrame, measures: Sequence[str], by: Sequence[str], error: float = DEFAULT_ERROR) -> DataFrame:
    """(by, measure, bucket, n, least, most) of every numeric column in ``measures``. Null and NaN values do not count.

    Rows are counted before the shuffle, so a group that holds a third of them sends its buckets only.
    """
    if not 0 < error < 1:
        raise ValueError(f"error must lie between 0 and 1: {error}")
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(f"`{m}`").cast("double").alias("_value")) for m in measures])
    long = df.select(*by, F.inline(pairs)).where(F.col("_value").isNotNull() & ~F.isnan("_value"))
    return long.groupBy(*by, "measure", bucket_of(F.col("_value"), error).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.min("_value").alias("least"), F.max("_value").alias("most")
    )


def merge_sketches(sketch: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The sketch of the groups ``by``, from finer sketches of one error: of a whole table, or of a chosen range."""
    return sketch.groupBy(*by, "measure", "bucket").agg(
        F.sum("n").cast("bigint").alias("n"), F.min("least").alias("least"), F.max("most").alias("most")
    )


def sketch_quantiles(sketch: DataFrame, probabilities: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(by, measure, probability, n, value, low, high) of a merged sketch.

    The exact quantile is the value at rank ceil(probability * n), the first for 0. It lies between ``low`` and ``high``,
    which are values of the data; ``value`` differs from it by the error of the sketch at most, relative to it. Windows
    run over the buckets of a group, not over rows.
    """
    group = [*by, "measure"]
    order = Window.partitionBy(*group).orderBy("bucket")
    upto, total = F.sum("n").over(order), F.sum("n").over(Window.partitionBy(*group))
    ranked = sketch.select(*group, *SKETCH, upto.alias("_upto"), total.alias("_total"))
    asked = F.array(*[F.lit(float(p)) for p in probabilities])
    ranked = ranked.withColumn("probability", F.explode(asked))
    rank = F.greatest(F.ceil(F.col("probability") * F.col("_total")), F.lit(1))
    at = ranked.where((rank <= F.col("_upto")) & (rank > F.col("_upto") - F.col("n")))
    # The harmonic mean of the ends is equally far, relative to them, from both.
    middle = F.col("least") / ((1 + F.col("least") / F.col("most")) / 2)
    value = F.when(F.col("least") == F.col("most"), F.col("least")).otherwise(middle)
    return at.select(*group, "probability", F.col("_total").alias("n"), value.alias("value"), F.col("least").alias("low"), F.col("most").alias("high"))
