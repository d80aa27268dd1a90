"""Result logs kept by a file manifest, so that a rescan reads only logs that are new or changed.

A store holds two committed tables. ``files`` has one row per file of the last listing: path, size, modification time and
digest of what the file holds. ``contents`` has the records of each digest. Listing opens no file; a file is opened if
its path is new or its size or time differ from the last listing. What it holds is kept only if no other file, under
this path or another, held the same. The records are committed first, then the listing, so a crash between the two
leaves the old listing and records that no file names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import fresh_path
from .commits import commit, current_state, read_committed
from .eval_logs import LOG_FILES, LOG_SCHEMA, locate

FILES_SCHEMA = "file string, path string, size bigint, modified timestamp, digest string"
#: Digest of a file without a record.
EMPTY = "empty"


@dataclass(frozen=True)
class Refresh:
    """What a rescan did: files listed, opened, and gone since the last listing; contents not held before."""

    listed: int
    opened: int
    gone: int
    added: int


def list_logs(spark: SparkSession, root: str) -> DataFrame:
    """(file, path, size, modified) of every log below ``root``. The content column is pruned, so no file is opened."""
    options = {"recursiveFileLookup": True, "pathGlobFilter": LOG_FILES}
    found = spark.read.format("binaryFile").options(**options).load(root)
    return found.select(
        F.col("_metadata.file_path").alias("file"), "path", F.col("length").alias("size"), F.col("modificationTime").alias("modified")
    )


def known_files(spark: SparkSession, store: str) -> DataFrame:
    """The files of the last listing; none for a new store."""
    if current_state(spark, f"{store}/files")[1] is None:
        return spark.createDataFrame([], FILES_SCHEMA)
    return read_committed(spark, f"{store}/files").drop("listing")


def known_contents(spark: SparkSession, store: str) -> DataFrame:
    if current_state(spark, f"{store}/contents")[1] is None:
        record = T.StructType([T.StructField("record", T._parse_datatype_string(f"struct<{LOG_SCHEMA}>"))])
        return spark.createDataFrame([], record.add("digest", "string"))
    return read_committed(spark, f"{store}/contents")


def literal_path(path: str) -> str:
    """A path in which no character stands for others."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def opened_records(spark: SparkSession, paths: list[str], compacted: bool) -> tuple[DataFrame, DataFrame]:
    """(file, digest) and (file, record) of the named files.

    A file of one record is digested as a whole. Compacted files are digested line by line, so that a large file needs no
    buffer; the order of their lines does not count.
    """
    raw = spark.read.text([literal_path(p) for p in paths], wholetext=not compacted)
    raw = raw.select(F.col("_metadata.file_path").alias("file"), "value").where(F.col("value").rlike(r"\S"))
    line = F.md5("value")
    sums = [F.sum(F.conv(F.substring(line, a, 8), 16, 10).cast("decimal(20,0)")).cast("string") for a in (1, 9, 17, 25)]
    digests = raw.groupBy("file").agg(F.md5(F.concat_ws(",", F.count(F.lit(1)).cast("string"), *sums)).alias("digest"))
    return digests, raw.select("file", F.from_json("value", f"struct<{LOG_SCHEMA}>").alias("record"))


def refresh_logs(spark: SparkSession, root: str, store: str, compacted: bool = False) -> Refresh:
    """Bring the store up to date with the logs below ``root``; one store serves one root.

    The names of the files that are opened go through the driver, as the names of all files do where Spark lists them.
    """
    listing = fresh_path(spark, "listing")
    known = known_files(spark, store)
    before = known.select("file", F.col("size").alias("_size"), F.col("modified").alias("_modified"), "digest")
    same = F.col("size").eqNullSafe(F.col("_size")) & F.col("modified").eqNullSafe(F.col("_modified"))
    joined = list_logs(spark, root).join(before, "file", "left")
    joined.select("file", "path", "size", "modified", F.when(same, F.col("digest")).alias("digest")).write.parquet(listing)
    listed = spark.read.schema(FILES_SCHEMA).parquet(listing)
    pending = [r[0] for r in listed.where("digest is null").select("path").collect()]
    gone = known.join(listed, "file", "left_anti").count()
    added = 0
    if pending:
        digests, records = opened_records(spark, pending, compacted)
        opened = fresh_path(spark, "digests")
        digests.write.parquet(opened)
        digests = spark.read.schema("file string, digest string").parquet(opened)
        held = known_contents(spark, store).select("digest").distinct()
        # One file stands for all that hold the same.
        new = digests.groupBy("digest").agg(F.min("file").alias("file")).join(held, "digest", "left_anti")
        added = new.count()
        if added:
            commit(records.join(new, "file").select("record", "digest"), f"{store}/contents", ["digest"], folders=False)
        found = digests.withColumnRenamed("digest", "_found")
        filled = F.coalesce("digest", "_found", F.lit(EMPTY)).alias("digest")
        listed = listed.join(found, "file", "left").select("file", "path", "size", "modified", filled)
    if pending or gone or current_state(spark, f"{store}/files")[1] is None:
        commit(listed.withColumn("listing", F.lit(0)), f"{store}/files", ["listing"], folders=False)
    return Refresh(listed.count(), len(pending), gone, added)


def scan_stored_logs(spark: SparkSession, store: str) -> DataFrame:
    """The rows that ``scan_eval_logs`` gives for the last listing, without opening a log."""
    files = known_files(spark, store).select("file", "digest")
    rows = known_contents(spark, store).join(files, "digest").select("record.*", "file")
    return locate(rows, F.col("file")).drop("file")
