"""Row filters and document limits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SAVE_STEPS = 50


def save_step_filter(df: DataFrame, step: str = "step", save_steps: int = SAVE_STEPS) -> DataFrame:
    return df.where(F.pmod(F.col(step), F.lit(save_steps)) == 0)


def unique_docs(df: DataFrame, text: str, row_id: str, by: list[str] | None = None) -> DataFrame:
    """One row of every distinct text, per ``by`` columns: the one with the smallest id, rows without an id last.

    Copies meet as fixed-size digests with map-side partial aggregation, so they collapse before the shuffle. Of rows that
    share id and text the one with the smallest hash of its columns stays. Null texts are one text.
    """
    by = by or []
    # Maps have no hash.
    hashed = [F.to_json(f"`{f.name}`") if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in df.schema.fields]
    mark = F.xxhash64(*hashed)
    order = F.struct(F.col(row_id).isNull(), F.col(row_id), mark)
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    kept = df.groupBy(*by, F.sha2(F.col(text), 256).alias("_digest")).agg(F.min_by(row, order).alias("_row"))
    return kept.select("_row.*")


def limit_docs(df: DataFrame, by: list[str], row_id: str, max_samples: int | None) -> DataFrame:
    """At most ``max_samples`` rows per task, smallest ids first; all of them if the limit is absent.

    The rank filter is applied on each input partition first, so only that many rows per task and partition shuffle.
    """
    if max_samples is None:
        return df
    w = Window.partitionBy(*by).orderBy(row_id)
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= max_samples).drop("_r")


def doc_counts(df: DataFrame, by: list[str], text: str) -> DataFrame:
    """Original and effective (distinct) document counts per task."""
    digests = df.groupBy(*by, F.sha2(F.col(text), 256).alias("_digest")).agg(F.count(F.lit(1)).alias("_n"))
    return digests.groupBy(*by).agg(
        F.sum("_n").alias("original_num_docs"), F.count(F.lit(1)).alias("effective_num_docs")
    )
