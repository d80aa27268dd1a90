"""Set operations over suites, checkpoints and benchmark names."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALL = "all"


def union_suites(suites: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [df.withColumn("suite", F.lit(name)) for name, df in suites.items()])


def checkpoints_in_both(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("exp", "step").intersect(b.select("exp", "step"))


def expand_benchmarks(requested: DataFrame, known: Sequence[str], by: str = "request_id") -> DataFrame:
    """Distinct benchmark names per request, with a request for just ``all`` replaced by every known benchmark.

    Only an ``all`` entry has to know whether it stands alone; that comes out of two aggregations, so the named entries
    are never joined with anything.
    """
    names = requested.groupBy(by, "benchmark").agg(F.count(F.lit(1)).alias("_n"))
    wants_all = F.col("benchmark") == ALL
    alone = names.groupBy(by).agg(F.sum("_n").alias("_n"), F.max(wants_all).alias("_all")).where("_all")
    every = F.explode(F.when(F.col("_n") == 1, F.array(*[F.lit(k) for k in known])).otherwise(F.array(F.lit(ALL))))
    return names.where(~wants_all).select(by, "benchmark").unionByName(alone.select(by, every.alias("benchmark")))


def benchmarks_unsupported(requested: DataFrame, known: Sequence[str], by: str = "request_id") -> DataFrame:
    """Requested names that are not registered, once a lone ``all`` is expanded; a caller treats any row as an error."""
    return expand_benchmarks(requested, known, by).where(~F.coalesce(F.col("benchmark").isin(list(known)), F.lit(False)))
