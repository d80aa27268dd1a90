"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bare_words, chunks, mix, shingles, texts_of, written

#: Hash functions of a signature. A window holds at most four times an item's shingles, so at 0.8 containment each
#: function agrees with a chance of 0.19 at least, and all of them miss with a chance below 0.000002.
HASHES = 64
#: The bit filters of item keys and item shingles have so many bits for each value, and at most so many.
VALUE_BITS, MOST_BITS = 256, 1 << 24


def multipliers() -> np.ndarray:
    return np.random.default_rng(23).integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def key_of(size: int, number, value: np.ndarray) -> np.ndarray:
    """One number for (size partition, hash function, least value)."""
    return mix(value + np.uint64(size * 0x9E3779B97F4A7C15 % (1 << 64)) + np.atleast_1d(np.asarray(number, np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F))


def partition_of(n: int) -> int:
    """The size partition of a set: the power of two that holds it."""
    return 1 << max(0, int(n) - 1).bit_length()


def items_of(items: DataFrame, width: int) -> DataFrame:
    """(item, size, shingles, keys) of every item with a word. The size of an item of k < ``width`` words is -k."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = multipliers()
        for part in chunks(batches, "text"):
            words, bounds = bare_words(texts_of(part, "text"))
            runs, edges = shingles(words, bounds, width)
            out = []
            for item, n, x, y in zip(part.column("item").to_pylist(), np.diff(bounds).tolist(), edges[:-1], edges[1:], strict=True):
                own = np.unique(runs[x:y])
                if 0 < n < width and item is not None:
                    out.append((item, -n, own.view(np.int64).tolist(), key_of(0, n, own).view(np.int64).tolist()))
                elif len(own) and item is not None:
                    least = (own[:, None] * a).min(axis=0)
                    size = partition_of(len(own))
                    out.append((item, size, own.view(np.int64).tolist(), key_of(size, np.arange(HASHES), least).view(np.int64).tolist()))
            if out:
                c = list(zip(*out, strict=True))
                kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(c, kinds, strict=True)], ["item", "size", "shingles", "keys"])

    return items.mapInArrow(run, "item long, size long, shingles array<long>, keys array<long>")


def bit_filter(values: DataFrame) -> np.ndarray:
    """Which values modulo the length occur. The length follows the number of values and is bounded."""
    column = values.columns[0]
    n = values.count()
    bits = 1 << 16
    while bits < VALUE_BITS * n and bits < MOST_BITS:
        bits *= 2
    there = np.zeros(bits, bool)
    at = values.select(F.pmod(column, F.lit(bits)).cast("int").alias("bit")).distinct().toPandas().bit
    there[at.to_numpy(np.int64)] = True
    return there


def passes(there: np.ndarray, values: np.ndarray) -> np.ndarray:
    return there[(values & np.uint64(len(there) - 1)).astype(np.intp)]


def window_keys(runs: np.ndarray, edges: np.ndarray, sizes: list[int], there: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, key) of the window keys that pass the filter.

    Texts are cut into blocks of the smallest partition's size; the least values of blocks are merged in twos up to
    the largest. A window of a partition is two neighbouring blocks, so a passage of that size lies within one.
    """
    a = multipliers()
    size = sizes[0]
    lengths = np.diff(edges)
    count = -(-lengths // size)
    text = np.repeat(np.arange(len(lengths)), count)
    place = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    starts = edges[:-1][text] + place * size
    if not len(starts):
        return np.zeros(0, int), np.zeros(0, np.uint64)
    least = np.stack([np.minimum.reduceat(runs * m, starts) for m in a])
    rows, keys = [], []
    while True:
        if size in sizes:
            follows = np.append(text[1:] == text[:-1], False)
            nxt = np.where(follows, np.arange(len(text)) + 1, np.arange(len(text)))
            lone = ~follows & ~np.insert(follows[:-1], 0, False)
            used = np.flatnonzero(follows | lone)
            for k in range(HASHES):
                key = key_of(size, k, np.minimum(least[k][used], least[k][nxt[used]]))
                hit = passes(there, key)
                rows.append(text[used[hit]])
                keys.append(key[hit])
        if size >= sizes[-1]:
            break
        keep = np.flatnonzero(place % 2 == 0)
        least = np.minimum.reduceat(least, keep, axis=1)
        text, place, size = text[keep], place[keep] // 2, size * 2
    return np.concatenate(rows), np.concatenate(keys)


def near_hits(runs: np.ndarray, edges: np.ndarray, size: int, there: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(runs, edges, text numbers) of the stretches around shingles that may be an item's.

    Texts are cut into blocks of the largest partition's size. Blocks without such a shingle whose neighbours have none
    either are left out: no window with a shingle of an item reaches into them, so none is lost. Stretches begin where
    smaller blocks do too.
    """
    lengths = np.diff(edges)
    count = -(-lengths // size)
    text = np.repeat(np.arange(len(lengths)), count)
    if not len(text):
        return runs, np.zeros(1, int), text
    place = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    starts = edges[:-1][text] + place * size
    own = np.logical_or.reduceat(passes(there, runs), starts)
    follows = text[1:] == text[:-1]
    kept = own.copy()
    kept[1:] |= own[:-1] & follows
    kept[:-1] |= own[1:] & follows
    sizes = np.minimum(size, edges[1:][text] - starts)
    begins = kept & ~np.insert(kept[:-1] & follows, 0, False)
    stretch = np.cumsum(begins)[kept] - 1
    held = np.bincount(stretch, sizes[kept], minlength=int(begins.sum())).astype(int)
    return runs[np.repeat(kept, sizes)], np.concatenate([[0], np.cumsum(held)]), text[begins]


def short_keys(words: np.ndarray, bounds: np.ndarray, lengths: list[int], there: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, key, run) of the runs of as many words as short items have, those whose key passes the filter."""
    rows, keys, held = [np.zeros(0, int)], [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for k in lengths:
        runs, edges = shingles(words, bounds, k)
        key = key_of(0, k, runs)
        hit = passes(there, key)
        rows.append(np.repeat(np.arange(len(edges) - 1), np.diff(edges))[hit])
        keys.append(key[hit])
        held.append(runs[hit])
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(held)


def leaks(docs: DataFrame, items: DataFrame, containment: float, width: int) -> DataFrame:
    """(digest, items): texts, by a hash, that hold at least ``containment`` of an item's different shingles."""
    known = written(items_of(items, width), "items")
    met_sizes = sorted(r[0] for r in known.select("size").distinct().collect())
    sizes, lengths = [n for n in met_sizes if n > 0], [-n for n in met_sizes if n < 0]
    keyed = known.select("item", F.explode("keys").alias("key"))
    key_bits = bit_filter(keyed.select("key"))
    shingle_bits = bit_filter(known.select(F.explode("shingles").alias("s")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            if not met_sizes:
                continue
            words, bounds = bare_words(texts_of(part, "text"))
            runs, edges = shingles(words, bounds, width)
            text, key, short = short_keys(words, bounds, lengths, key_bits)
            whole = [(text, key)]
            if sizes:
                some, bounds_of, owner = near_hits(runs, edges, sizes[-1], shingle_bits)
                stretch, found = window_keys(some, bounds_of, sizes, key_bits)
                whole.append((owner[stretch], found))
            short_text, (text, key) = text, (np.concatenate(c) for c in zip(*whole, strict=True))
            digest = part.column("digest").to_pylist()
            out = []
            for t in np.unique(text):
                own = np.unique(np.concatenate([runs[edges[t] : edges[t + 1]], short[short_text == t]]))
                held = own[passes(shingle_bits, own)]
                out.append((digest[t], np.unique(key[text == t]).view(np.int64).tolist(), held.view(np.int64).tolist()))
            if out:
                c = list(zip(*out, strict=True))
                kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(c, kinds, strict=True)], ["digest", "keys", "held"])

    met = docs.mapInArrow(run, "digest long, keys array<long>, held array<long>").dropDuplicates(["digest"])
    met = written(met, "windows-met")
    pairs = met.select("digest", F.explode("keys").alias("key")).join(keyed, "key").select("digest", "item").distinct()
    checked = pairs.join(met.select("digest", "held"), "digest").join(known.select("item", "shingles"), "item")
    shared = F.size(F.array_intersect("held", "shingles"))
    return checked.where(shared >= containment * F.size("shingles")).groupBy("digest").agg(F.array_sort(F.collect_set("item")).alias("items"))


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    containment: float = 0.8,
    width: int = 5,
    result: str = "leaked_items",
) -> DataFrame:
    """All columns of ``docs`` and the ids of the items that a text holds, in order; an empty list where it holds none.

    An item counts as held if at least ``containment`` of its different ``width``-word shingles are anywhere in the
    whole text; words are compared without case and outer signs. Items are partitioned by size, texts are searched
    in overlapping windows of each partition's size by MinHash values, and what meets is verified exactly. An item
    with fewer words is one shingle, held by every text with these words in a row.

    Null and empty texts hold nothing, null and empty items are held by nothing, and an item without an id is left
    out. Items that share an id are found under it. Equal texts are verified once, found by a 64-bit hash; repeated
    rows all keep their row. Either table may be empty. A column named like the result is replaced.
    """
    named = items.select(F.col(f"`{item_id}`").cast("long").alias("item"), F.col(f"`{item_text}`").alias("text"))
    body = F.col(f"`{text}`")
    found = leaks(docs.select(body.alias("text"), F.xxhash64(body).alias("digest")), named, containment, width)
    found = written(found, "leaks").withColumnsRenamed({"digest": "__digest", "items": "__items"})
    joined = docs.drop(result).withColumn("__text_digest", F.xxhash64(body)).join(found, F.col("__text_digest") == F.col("__digest"), "left")
    return joined.withColumn(result, F.coalesce("__items", F.array().cast("array<long>"))).drop("__text_digest", "__digest", "__items")
