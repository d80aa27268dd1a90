"""Helpers shared by the operators: text batches, word hashes, scratch tables, connected components."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollscore.session import shared_dir

#: Text bytes handled at once inside a task.
CHUNK_BYTES = 8 << 20


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again: computed once, and its lineage is cut."""
    path = os.path.join(shared_dir(df.sparkSession), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(id_column: str, divisor: int, remainder: int):
    """True for the rows whose labels are not learned from."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % divisor == remainder


def chunks(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``CHUNK_BYTES`` of text, and one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // CHUNK_BYTES
        starts = np.flatnonzero(np.diff(part, prepend=-1))
        for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            yield batch.slice(a, b - a)


def texts_of(batch: pa.RecordBatch, text: str) -> pa.Array:
    """The texts of a batch, an empty one for null; its bytes start at 0, as some Arrow functions need."""
    texts = pc.fill_null(batch.column(text).cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = (texts.buffers()[2] or pa.py_buffer(b"")).slice(offsets[0], offsets[-1] - offsets[0])
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets - offsets[0]), data)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: pa.Array, normal=None) -> np.ndarray:
    """A 64-bit hash of each word after ``normal``, 0 where nothing is left of it; each different word is hashed once."""
    if not len(words):
        return np.empty(0, np.uint64)
    coded = words.dictionary_encode()
    different = coded.dictionary.to_pylist()
    if normal:
        different = map(normal, different)
    table = np.fromiter((xxhash.xxh3_64_intdigest(w) or 1 if w else 0 for w in different), np.uint64, len(coded.dictionary))
    return table[coded.indices.to_numpy()]


OUTER = re.compile(r"\A[\W_]+|[\W_]+\Z")


def bare(word: str) -> str:
    """Lower case, without the signs around it."""
    if word and word[0].isalnum() and word[-1].isalnum():
        return word.lower()
    return OUTER.sub("", word).lower()


def bare_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the bare words of each text in order, and the bounds between the texts."""
    words, bounds = split_words(texts)
    hashes = word_hashes(words, bare)
    left = np.concatenate([[0], np.cumsum(hashes != 0)])
    return hashes[hashes != 0], left[bounds]


def split_words(texts: pa.Array, lists=pc.ascii_split_whitespace) -> tuple[pa.Array, np.ndarray]:
    """All words in order, and for n texts the n + 1 bounds between them."""
    split = lists(texts)
    words, counts = split.flatten(), pc.list_value_length(split).to_numpy(zero_copy_only=False)
    real = pc.greater(pc.binary_length(words), 0)
    row = np.repeat(np.arange(len(counts)), counts)[real.to_numpy(zero_copy_only=False)]
    bounds = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(counts)))])
    return words.filter(real), bounds


def shingles(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``width`` words, and the bounds of each text's runs.

    A text with fewer words has its whole sequence as the one run; a text without words has none.
    """
    n = len(hashes)
    runs = np.zeros(n, np.uint64)
    lengths = np.diff(bounds)
    room = np.minimum(np.repeat(bounds[1:], lengths) - np.arange(n), width)
    for k in range(width):
        there = np.flatnonzero(room > k)
        runs[there] = mix(runs[there] * np.uint64(0x9E3779B97F4A7C15) + hashes[there + k] + np.uint64(k + 1))
    first = np.arange(n) == np.repeat(bounds[:-1], lengths)
    kept = (room == width) | first
    counts = np.where(lengths >= width, lengths - width + 1, np.minimum(lengths, 1))
    return runs[kept], np.concatenate([[0], np.cumsum(counts)])


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)``: the smallest node reachable, for every node that has a link to another.

    Alternates the large-star and small-star steps of distributed component search until nothing moves; each round
    is written to the shared folder. Each step groups by a node with a map-side minimum and joins on it, so a node
    with very many links is never gathered in one place. Null ends and loops are ignored.
    """
    pair = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    pair = written(pair.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = None
    while True:
        both = pair.union(pair.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u <> v").distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v")))
        pair = written(small.where("u <> v").distinct(), "small")
        state = pair.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if state == before:
            break
        before = state
    return pair.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node").union(
        pair.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
