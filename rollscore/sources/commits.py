"""Tables kept by key whose state changes in one step: data first, then a manifest, then one pointer to it.

A folder holds ``data/commit=<id>`` (rows, in folders by key), ``manifests/<id>`` (which commit holds which key) and
``current/<n>.json``, the pointers. Readers follow the pointer with the highest number. A pointer is renamed into its
place, and only where there is none, so a reader sees the old state or the new one, and of two writers one has to look
again. What a writer leaves behind when it dies is data that no manifest names.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATA, MANIFESTS, CURRENT = "data", "manifests", "current"


class CommitConflict(Exception):
    """Another writer has taken this number."""


def _files(spark: SparkSession, path: str):
    """The file context of a path, and a maker of paths, whatever file system it is on."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def _publish(spark: SparkSession, path: str, number: int, state: dict) -> None:
    """Put pointer ``number`` in place, or fail if it is there already."""
    files, to_path = _files(spark, path)
    jvm = spark._jvm
    draft = to_path(f"{path}/{CURRENT}/.{uuid.uuid4().hex}")
    flags = jvm.java.util.EnumSet.of(jvm.org.apache.hadoop.fs.CreateFlag.CREATE)
    parent = jvm.org.apache.hadoop.fs.Options.CreateOpts.createParent()
    options = spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.CreateOpts, 1)
    options[0] = parent
    out = files.create(draft, flags, options)
    out.write(bytearray(json.dumps(state).encode()))
    out.close()
    try:
        files.rename(draft, to_path(f"{path}/{CURRENT}/{number:012d}.json"), spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Py4JJavaError as error:
        files.delete(draft, False)
        if "FileAlreadyExistsException" in str(error.java_exception):
            raise CommitConflict(f"{path}: commit {number} is taken") from error
        raise


def current_state(spark: SparkSession, path: str) -> tuple[int, dict | None]:
    """Number and content of the newest pointer; (0, None) for a table that has none."""
    files, to_path = _files(spark, path)
    folder = to_path(f"{path}/{CURRENT}")
    if not files.util().exists(folder):
        return 0, None
    names = [s.getPath().getName() for s in files.util().listStatus(folder)]
    numbers = [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != "."]
    if not numbers:
        return 0, None
    number = max(numbers)
    text = spark.read.text(f"{path}/{CURRENT}/{number:012d}.json", wholetext=True).first()[0]
    return number, json.loads(text)


def _same(keys: Sequence[str], other: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{other}{k}")) for k in keys])


def _manifest(spark: SparkSession, path: str, state: dict | None, keys: Sequence[T.StructField]) -> DataFrame:
    schema = T.StructType([*keys, T.StructField("commit", T.StringType())])
    return spark.read.schema(schema).parquet(f"{path}/{MANIFESTS}/{state['manifest']}") if state else spark.createDataFrame([], schema)


def commit(
    df: DataFrame, path: str, keys: Sequence[str], attempts: int = 10, folders: bool = True, **notes: object
) -> int:
    """Replace the rows of every key in ``df`` by those in ``df``, all at once, and return the number of the new state.

    ``keys`` are the columns that a load replaces as a whole, and become folders, or without ``folders`` (for many small
    keys) only entries of the manifest. Other keys keep their rows. A repeated run replaces what it wrote. ``notes`` are kept with the pointer. The rows are written once; if another writer was
    faster, only the manifest is made again, from that writer's state. All commits of a table have one schema.
    """
    spark, keys = df.sparkSession, list(keys)
    name = uuid.uuid4().hex
    rest = [f for f in df.schema.fields if f.name not in keys]
    fields = [*rest, *[df.schema[k] for k in keys]]
    # Keys as text in folder names would come back as another type or without their nulls, so they stay in the rows too.
    by = [F.col(f"`{k}`").alias(f"_by_{k}") for k in keys] if folders else []
    written = f"{path}/{DATA}/commit={name}"
    df.select(*[F.col(f"`{f.name}`") for f in fields], *by).write.partitionBy(*[f"_by_{k}" for k in keys if folders]).parquet(written)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    brought = spark.read.schema(T.StructType([schema[k] for k in keys])).parquet(written).select(*keys).distinct()
    for attempt in range(attempts):
        number, state = current_state(spark, path)
        if state and T.StructType.fromJson(state["schema"]) != schema:
            raise ValueError(f"{path} holds other columns: {state['schema']}")
        old = _manifest(spark, path, state, [schema[k] for k in keys])
        new = brought.select(*[F.col(k).alias(f"_n_{k}") for k in keys])
        kept = old.join(new, _same(keys, "_n_"), "left_anti")
        manifest = f"{number + 1:012d}-{uuid.uuid4().hex}"
        kept.unionByName(brought.withColumn("commit", F.lit(name))).write.parquet(f"{path}/{MANIFESTS}/{manifest}")
        try:
            _publish(spark, path, number + 1, {"manifest": manifest, "schema": schema.jsonValue(), "keys": keys, "notes": notes})
            return number + 1
        except CommitConflict:
            if attempt + 1 == attempts:
                raise
            time.sleep(0.05 * 2**attempt)
    raise AssertionError


def read_committed(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The rows of the newest state, or of an earlier one by its number.

    Data and manifest meet on commit and key. Folders of commits of which no key is left are not read; the names of the
    others, one per commit, go through the driver, as their folders do when they are listed.
    """
    newest, state = current_state(spark, path)
    if number is not None and number != newest:
        text = spark.read.text(f"{path}/{CURRENT}/{number:012d}.json", wholetext=True).first()[0]
        state = json.loads(text)
    if state is None:
        raise FileNotFoundError(f"{path} has no committed state")
    schema, keys = T.StructType.fromJson(state["schema"]), state["keys"]
    manifest = _manifest(spark, path, state, [schema[k] for k in keys])
    named = manifest.select(F.col("commit").alias("_m_commit"), *[F.col(k).alias(f"_m_{k}") for k in keys])
    stored = spark.read.schema(T.StructType([*schema.fields, T.StructField("commit", T.StringType())])).parquet(f"{path}/{DATA}")
    live = [r[0] for r in manifest.select("commit").distinct().collect()]
    return stored.where(F.col("commit").isin(live)).join(named, (F.col("commit") == F.col("_m_commit")) & _same(keys, "_m_"), "left_semi").select(*schema.names)


def vacuum(spark: SparkSession, path: str, keep: int = 10) -> int:
    """Delete pointers and manifests older than the newest ``keep``, and commits that none of the kept ones names.

    Commits younger than the newest pointer may belong to a writer that is still at work and stay. Readers of a state
    that is given up fail; the number of deleted commits is returned.
    """
    files, to_path = _files(spark, path)
    newest, state = current_state(spark, path)
    if state is None:
        return 0
    util = files.util()
    pointers = {int(s.getPath().getName()[:-5]): s for s in util.listStatus(to_path(f"{path}/{CURRENT}")) if s.getPath().getName().endswith(".json")}
    kept = [spark.read.text(pointers[n].getPath().toString(), wholetext=True).first()[0] for n in pointers if n > newest - keep]
    manifests = {json.loads(t)["manifest"] for t in kept}
    fields = T.StructType.fromJson(state["schema"])
    named = [_manifest(spark, path, {"manifest": m}, [fields[k] for k in state["keys"]]).select("commit") for m in manifests]
    live = {r[0] for r in reduce(DataFrame.union, named).distinct().collect()}
    last = pointers[newest].getModificationTime()
    for status in util.listStatus(to_path(f"{path}/{MANIFESTS}")):
        if status.getPath().getName() not in manifests and status.getModificationTime() < last:
            files.delete(status.getPath(), True)
    for n in pointers:
        if n <= newest - keep:
            files.delete(pointers[n].getPath(), False)
    gone = 0
    for status in util.listStatus(to_path(f"{path}/{DATA}")):
        name = status.getPath().getName().removeprefix("commit=")
        if name not in live and status.getModificationTime() < last:
            gone += files.delete(status.getPath(), True)
    return gone


def notes(spark: SparkSession, path: str) -> dict:
    """What the last commit said beside its rows."""
    return (current_state(spark, path)[1] or {}).get("notes", {})


def commit_generations(df: DataFrame, path: str, keys: Sequence[str] = ("load_unit",), private: bool = True) -> int:
    """Generated rows by load unit. Rows and visibility change together; rewriting a unit replaces that unit alone."""
    return commit(df, path, keys, private=private)


def commit_metrics(df: DataFrame, path: str, run: str, metrics: dict[str, Column]) -> int:
    """One row of metrics for ``run``, with ``train_samples`` as the row count; a repeated run replaces its row."""
    row = df.agg(F.count(F.lit(1)).alias("train_samples"), *[c.alias(n) for n, c in metrics.items()])
    return commit(row.withColumn("run", F.lit(run)), path, ["run"])
