"""Table scans, split scans, and the sinks for generations and metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, folder: str, name: str, *columns: str, spread: bool = False) -> DataFrame:
    """Scan one parquet table, reading only ``columns``.

    ``spread`` is for CPU-heavy per-row work: if the scan has fewer splits than the session has cores (a small single
    file), its rows are dealt out to all of them. A large table has more splits than cores and is left as it is.
    """
    df = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    if columns:
        df = df.select(*columns)
    cores = spark.sparkContext.defaultParallelism
    if spread and df.rdd.getNumPartitions() < cores:
        df = df.repartition(cores)
    return df


def scan_split(
    spark: SparkSession, path: str, split: str, fmt: str = "parquet", schema: str | None = None, **options: str
) -> DataFrame:
    """One named split of a dataset stored with ``split`` as partition folder; other folders are not read.

    ``fmt`` is any Spark file format. Give a ``schema`` for text formats, so that no inference job runs.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path).where(F.col("split") == split)


def write_splits(df: DataFrame, path: str, split: Column, fmt: str = "parquet", **options: str) -> None:
    writer = df.withColumn("split", split).write.format(fmt).options(**options)
    writer.mode("overwrite").partitionBy("split").save(path)


def sink_generations(
    df: DataFrame, path: str, partition_by: Sequence[str] = ("load_unit",), private: bool = True
) -> None:
    """Write generated rows, one folder per load unit. Rewriting a unit replaces only that unit's folder.

    The visibility flag is kept next to the data as a one-row table.
    """
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(f"{path}/data")
    df.sparkSession.range(1).select(F.lit(private).alias("private")).write.mode("overwrite").parquet(f"{path}/visibility")


def sample_counts(df: DataFrame, split: str = "split") -> DataFrame:
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("samples"))


def sink_metrics(df: DataFrame, path: str, run: str, metrics: dict[str, Column]) -> None:
    """One JSON row of run metrics, with ``train_samples`` as the row count, in the folder of its run.

    A repeated run replaces its row. ``commits.commit_metrics`` also does so in one step.
    """
    row = df.agg(F.count(F.lit(1)).alias("train_samples"), *[c.alias(n) for n, c in metrics.items()])
    writer = row.withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("run").json(path)
