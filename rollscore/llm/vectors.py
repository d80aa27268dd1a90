"""Near copies among embeddings: randomised-rotation binary codes with correction factors, and exact recomputation."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, written

#: Vectors that meet in one task at once; larger buckets are cut into tiles.
TILE = 2048
#: Width of the confidence bound of an estimate, in standard errors: about 1 pair in 10,000 falls outside.
SURE = 4.0


def rotation(dim: int, number: int) -> np.ndarray:
    """A random orthogonal matrix, the same wherever it is drawn."""
    q, r = np.linalg.qr(np.random.default_rng([dim, number]).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def unit(data: list[bytes], dim: int) -> np.ndarray:
    """Vectors of one length from their bytes, scaled to length 1 in double precision without overflow."""
    x = np.frombuffer(b"".join(data), np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def bands_for(largest: int, threshold: float, recall: float) -> tuple[int, int]:
    """Bits of a band so that unrelated vectors meet in small buckets, and bands for the wanted recall at the threshold."""
    same = 1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi
    bits = min(24, max(6, math.ceil(math.log2(max(largest, 1) / 16))))
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - same**bits))) if same < 1 else 1


def coded(classes: DataFrame, bits: int, bands: int) -> DataFrame:
    """One row for each vector and band: the bucket, the binary code of the first rotation and its correction factor.

    Bands are cut from the signs after as many rotations as are needed. The factor is the inner product of a vector
    and its code, by which estimates from the code are unbiased.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, ids, labels, copies = (batch.column(c).to_pylist() for c in ("dim", "id", "label", "copies"))
            lists = batch.column("vec")
            for dim in sorted(set(dims)):
                at = [i for i, d in enumerate(dims) if d == dim]
                raw = np.array([lists[i].as_py() for i in at], np.float64)
                data = [r.tobytes() for r in raw]
                x = unit(data, dim)
                spun = [x @ rotation(dim, r) for r in range(-(-bits * bands // dim))]
                signs = np.concatenate([s >= 0 for s in spun], axis=1)[:, : bits * bands].reshape(len(at), bands, bits)
                keys = (signs * (1 << np.arange(bits))).sum(axis=2).astype(np.uint32)
                code = np.packbits(spun[0] >= 0, axis=1)
                factor = np.abs(spun[0]).sum(axis=1) / math.sqrt(dim)
                for b in range(bands):
                    bucket = [xxhash.xxh3_64_intdigest(f"{labels[i]}/{dim}/{b}/{k}") - (1 << 63) for i, k in zip(at, keys[:, b], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(bucket, pa.int64()),
                            pa.array(np.full(len(at), b, np.int32)),
                            pa.array([ids[i] for i in at], pa.int64()),
                            pa.array([copies[i] for i in at], pa.int64()),
                            pa.array(np.full(len(at), dim, np.int32)),
                            pa.array(data, pa.binary()),
                            pa.array([k.tobytes() for k in keys], pa.binary()),
                            pa.array([c.tobytes() for c in code], pa.binary()),
                            pa.array(factor),
                        ],
                        ["bucket", "band", "id", "copies", "dim", "vec", "keys", "code", "factor"],
                    )

    return classes.mapInArrow(
        run, "bucket long, band int, id long, copies long, dim int, vec binary, keys binary, code binary, factor double"
    )


def linked_pairs(x: np.ndarray, code: np.ndarray, factor: np.ndarray, side: np.ndarray | None, threshold: float):
    """Index pairs i < j of one tile with cosine at or above the threshold, block by block.

    The estimate of an inner product comes from the rotated vector and the other's code; where its upper bound stays
    below the threshold the pair is passed over, all others are recomputed from the vectors themselves.
    """
    n, dim = x.shape
    spun = x @ rotation(dim, 0)
    signs = np.where(np.unpackbits(code, axis=1)[:, :dim] == 1, 1.0, -1.0) / math.sqrt(dim)
    slack = SURE * np.sqrt(np.maximum(1 - factor**2, 0)) / factor / math.sqrt(max(dim - 1, 1))
    for a in range(0, n, 256):
        rows = np.arange(a, min(a + 256, n))
        upper = spun[rows] @ signs.T / factor + slack
        open_ = (upper >= threshold) & (np.arange(n) > rows[:, None])
        if side is not None:
            open_ &= side[rows][:, None] != side
        i, j = np.nonzero(open_)
        i = rows[i]
        good = np.concatenate([np.einsum("ij,ij->i", x[i[s : s + 65536]], x[j[s : s + 65536]]) >= threshold for s in range(0, len(i), 65536)] or [np.zeros(0, bool)])
        yield i[good], j[good]


def tile_result(rows: dict[str, list], threshold: float) -> list[tuple]:
    """For the vectors of a tile: how many links they gain here first, and links that join what is connected here."""
    dim, band = rows["dim"][0], rows["band"][0]
    x = unit(rows["vec"], dim)
    code = np.frombuffer(b"".join(rows["code"]), np.uint8).reshape(len(x), -1)
    keys = np.frombuffer(b"".join(rows["keys"]), np.uint32).reshape(len(x), -1)
    ids, copies = np.array(rows["id"]), np.array(rows["copies"])
    side = np.array(rows["part"]) if rows["low"][0] != rows["high"][0] else None
    gained = np.zeros(len(x), np.int64)
    order = np.argsort(ids, kind="stable")
    rank = np.empty(len(x), int)
    rank[order] = np.arange(len(x))
    label, joins = rank.copy(), set()
    for i, j in linked_pairs(x, code, np.array(rows["factor"]), side, threshold):
        new = ~(keys[i, :band] == keys[j, :band]).any(axis=1)
        np.add.at(gained, i[new], copies[j[new]])
        np.add.at(gained, j[new], copies[i[new]])
        while True:
            before = label.copy()
            least = np.minimum(label[i], label[j])
            np.minimum.at(label, i, least)
            np.minimum.at(label, j, least)
            if (label == before).all():
                break
        touched = np.unique(np.concatenate([i, j]))
        moved = touched[label[touched] != rank[touched]]
        joins.update(zip(ids[moved].tolist(), ids[order[label[moved]]].tolist(), strict=True))
    counted = np.flatnonzero(gained)
    return [*zip(ids[counted].tolist(), gained[counted].tolist(), [None] * len(counted), strict=True), *((a, 0, b) for a, b in joins)]


def joined(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Tiles are runs of rows with the same bucket, low and high."""
    names = ("bucket", "low", "high", "part", "band", "id", "copies", "dim", "vec", "keys", "code", "factor")
    held: dict[str, list] = {n: [] for n in names}
    out: list[tuple] = []

    def close() -> None:
        nonlocal held
        if len(held["id"]) > 1:
            out.extend(tile_result(held, threshold))
        held = {n: [] for n in names}

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["id", "gained", "other"])

    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in names]
        for row in zip(*columns, strict=True):
            if held["id"] and row[:3] != (held["bucket"][0], held["low"][0], held["high"][0]):
                close()
            for n, v in zip(names, row, strict=True):
                held[n].append(v)
        if len(out) > 50_000:
            yield batch_of(out)
            out.clear()
    close()
    if out:
        yield batch_of(out)


def near_vectors(
    df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = 0.93, recall: float = 0.998
) -> DataFrame:
    """(id_column, n_links, component_id, kept) for every row: vectors of one label with cosine at or above ``threshold``.

    Only links confirmed in double precision count. A pair exactly at the threshold is found with the chance
    ``recall`` (closer pairs more surely; a confidence bound of ``SURE`` errors is part of that), a pair below it
    never. Equal vectors of a label are one class with its number of copies, so a vector that repeats very often is
    one row. Classes meet where a band of their binary code agrees; bits and bands follow from the largest label, so
    unrelated vectors share small buckets at every size, and a bucket beyond ``TILE`` is cut into tiles that tasks
    share. A pair is counted in its first common band alone.

    Vectors that are null, empty, zero or hold null or non-finite components, and those with a null label or id, link
    with nothing; vectors of different lengths neither. Rows that share an id are vectors of their own, each with its own
    links, in one component. A row with a null id has a null component and is not kept. Other columns are not read.
    """
    v = F.col(f"`{vector}`")
    rows = df.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{label}`").cast("string").alias("label"), v.cast("array<double>").alias("vec"))
    sound = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)) & F.exists("vec", lambda x: x != 0)
    rows = rows.withColumn("ok", F.coalesce(sound & F.col("label").isNotNull() & F.col("id").isNotNull(), F.lit(False)))
    rows = rows.withColumn("h1", F.when(F.col("ok"), F.xxhash64("label", "vec"))).withColumn(
        "h2", F.when(F.col("ok"), F.xxhash64("vec", "label", F.lit(9)))
    )
    classes = rows.where("ok").groupBy("h1", "h2").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("vec").alias("vec")
    )
    classes = written(classes.withColumn("dim", F.size("vec")), "vector-classes")
    largest = classes.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    bits, bands = bands_for(largest, threshold, recall)
    # The id of a class is its hash from here on: vectors that share an id are classes of their own.
    dealt = written(coded(classes.drop("id").withColumnRenamed("h1", "id"), bits, bands), "vector-codes")
    sizes = dealt.groupBy("bucket").count().where("count > 1")
    tiles = F.ceil(F.col("count") / TILE).cast("int")
    tiled = (
        dealt.join(sizes, "bucket")
        .withColumn("part", F.pmod(F.xxhash64("id"), tiles).cast("int"))
        .withColumn("tile", F.explode(F.sequence(F.lit(0), tiles - 1)))
        .withColumn("low", F.least("part", "tile"))
        .withColumn("high", F.greatest("part", "tile"))
        .drop("count", "tile")
    )
    found = (
        tiled.repartition("bucket", "low", "high")
        .sortWithinPartitions("bucket", "low", "high")
        .mapInArrow(lambda b: joined(b, threshold), "id long, gained long, other long")
    )
    found = written(found, "vector-links")
    gained = found.groupBy(F.col("id").alias("h1")).agg(F.sum("gained").alias("gained"))
    owners = rows.where("ok").select("id", F.col("h1").alias("node")).distinct()
    shared = owners.groupBy("id").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first <> last")
    links = found.where("other is not null").select("id", "other").union(owners.join(shared, "id").select("node", "first"))
    reached = components(links, "id", "other").withColumnRenamed("node", "h1")
    judged = (
        classes.select("h1", "h2", "id", "copies")
        .join(gained, "h1", "left")
        .join(reached, "h1", "left")
        .select("h1", "h2", "id", (F.coalesce("gained", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "h1").alias("component"))
    )
    least = judged.groupBy("component").agg(F.min("id").alias("own"))
    named = judged.join(least, "component").select("h1", "h2", "n_links", "own")
    out = rows.select("id", "h1", "h2").join(named, ["h1", "h2"], "left")
    component = F.coalesce("own", "id")
    return out.select(
        F.col("id").alias(id_column),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
