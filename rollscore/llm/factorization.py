"""Factorization machine over the features of texts: fitting in numpy on a bounded sample, scoring in linear time."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks

#: Rows and features of a batch: for each feature of a document its document number and its feature number.
Features = tuple[np.ndarray, np.ndarray]
#: Features up to so far apart are looked up in a table, others by bisection.
TABLE = 1 << 22


@dataclass
class Machine:
    """``kept``: all feature numbers met in training, in order; ``strong``, ``weight`` and ``factor`` by place in ``kept``."""

    kept: np.ndarray
    strong: np.ndarray
    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def scores(self, rows: int, features: Features) -> np.ndarray:
        """Chance of label 1. Pairwise terms come from the square of sums less the sum of squares: linear time."""
        doc, feature = features
        place = self.places(feature)
        known = place >= 0
        doc, place = doc[known], place[known]
        x = values(rows, doc, self.strong[place])
        raw = self.bias + np.bincount(doc, self.weight[place] * x, rows)
        for factor in np.ascontiguousarray(self.factor.T):
            v = factor[place] * x
            raw += (np.bincount(doc, v, rows) ** 2 - np.bincount(doc, v * v, rows)) / 2
        return chance(raw)

    def places(self, feature: np.ndarray) -> np.ndarray:
        """The place of each feature in ``kept``, -1 if it was not met in training."""
        if not len(self.kept):
            return np.full(len(feature), -1)
        low, high = int(self.kept[0]), int(self.kept[-1])
        if high - low < TABLE:
            # One more place at the end is for all features outside.
            table = np.full(high - low + 2, -1, np.int32)
            table[self.kept - low] = np.arange(len(self.kept), dtype=np.int32)
            return table[np.where((feature >= low) & (feature <= high), feature - low, high - low + 1)]
        place = np.minimum(np.searchsorted(self.kept, feature), len(self.kept) - 1)
        return np.where(self.kept[place] == feature, place, -1)


def chance(raw: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(raw, -60, 60)))


def values(rows: int, doc: np.ndarray, strong: np.ndarray) -> np.ndarray:
    """What each feature of a document counts: 1 if it is strong; the others share a sum of squares of 1.

    So the many words of a long text that say little alone add no more noise than those of a short one, and pairs of
    them can still be learned.
    """
    others = np.maximum(np.bincount(doc[~strong], minlength=rows), 1)
    return np.where(strong, 1, 1 / np.sqrt(others)[doc]).astype(np.float32)


def evidence(rows: int, doc: np.ndarray, place: np.ndarray, y: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """For each feature the number of documents that have it, and how much its share differs by label, as a two-sample z."""
    ones = y.sum()
    zeros = max(rows - ones, 1)
    n = np.bincount(place, minlength=many)
    n1 = np.bincount(place, y[doc], many)
    p = n / rows
    gap = n1 / max(ones, 1) - (n - n1) / zeros
    return n, np.abs(gap) / np.sqrt(np.maximum(p * (1 - p), 1e-9) * (1 / max(ones, 1) + 1 / zeros))


def row_sums(bounds: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Sums of the stretches of ``entries`` between ``bounds``, 0 where one is empty."""
    out = np.zeros((len(bounds) - 1, *entries.shape[1:]), entries.dtype)
    filled = np.flatnonzero(np.diff(bounds))
    if len(filled):
        out[filled] = np.add.reduceat(entries, bounds[filled], axis=0)
    return out


def fit(
    rows: int,
    features: Features,
    y: np.ndarray,
    sample_weight: np.ndarray,
    rank: int = 8,
    epochs: int = 12,
    rate: float = 0.02,
    decay: float = 1e-4,
    strong_z: float = 4.0,
    trusted: int = 30,
    trusted_share: float = 0.01,
) -> Machine:
    """Weighted logistic loss by Adam over all features; a step touches only those that its documents have.

    No feature is left out. One whose own effect is sure (z of ``strong_z``, in 3 documents or more) counts in full, the
    others by ``values``. A feature of fewer than ``trusted`` documents, or than ``trusted_share`` of them, learns more
    slowly in proportion, as one that few documents have would learn these by heart.
    """
    doc, feature = features
    order = np.lexsort((feature, doc))
    doc, (kept, place) = doc[order].astype(np.int32), np.unique(feature[order], return_inverse=True)
    place = place.astype(np.int32)
    n, z = evidence(rows, doc, place, y, len(kept))
    strong = (z >= strong_z) & (n >= 3)
    trust = np.where(strong, 1, np.minimum(1, n / max(trusted, trusted_share * rows))).astype(np.float32)[:, None]
    x = values(rows, doc, strong[place])
    rng = np.random.default_rng(3)
    share = np.average(y, weights=sample_weight)
    bias = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
    # The first column holds the weights, the others the factors.
    state = rng.normal(0, 0.01, (len(kept), 1 + rank)).astype(np.float32)
    state[:, 0] = 0
    first, second = np.zeros_like(state), np.zeros_like(state)
    bias_first = bias_second = 0.0
    starts = np.searchsorted(doc, np.arange(rows + 1))
    dealt = rng.permutation(rows)
    batches = []
    for part in (dealt[at : at + 256] for at in range(0, rows, 256)):
        bounds = np.concatenate([[0], np.cumsum(starts[part + 1] - starts[part])])
        at = np.repeat(starts[part] - bounds[:-1], np.diff(bounds)) + np.arange(bounds[-1])
        own, inside = np.unique(place[at], return_inverse=True)
        by_feature = np.argsort(inside, kind="stable").astype(np.int32)
        feature_bounds = np.searchsorted(inside[by_feature], np.arange(len(own) + 1))
        batches.append((part, bounds, own, inside.astype(np.int32), by_feature, feature_bounds, x[at, None]))
    step = 0
    for _ in range(epochs):
        for k in rng.permutation(len(batches)):
            part, bounds, own, inside, by_feature, feature_bounds, xb = batches[k]
            old = state[own]
            v = old[inside] * xb
            sums = row_sums(bounds, v)
            raw = bias + sums[:, 0] + ((sums[:, 1:] ** 2).sum(1) - row_sums(bounds, (v[:, 1:] ** 2).sum(1))) / 2
            g = ((chance(raw) - y[part]) * sample_weight[part] / len(part)).astype(np.float32)
            # The gradient of a weight is the error, that of a factor the error times the sum of the others' factors.
            sums[:, 0] = 1
            v[:, 0] = 0
            each = np.repeat(sums, np.diff(bounds), axis=0) - v
            each *= np.repeat(g, np.diff(bounds))[:, None] * xb
            grad = row_sums(feature_bounds, each[by_feature]) + decay * old
            step += 1
            even, even_squares = 1 - 0.9**step, 1 - 0.999**step
            first[own] = 0.9 * first[own] + 0.1 * grad
            second[own] = 0.999 * second[own] + 0.001 * grad**2
            state[own] = old - rate * trust[own] * (first[own] / even) / (np.sqrt(second[own] / even_squares) + 1e-8)
            bias_first = 0.9 * bias_first + 0.1 * float(g.sum())
            bias_second = 0.999 * bias_second + 0.001 * float(g.sum()) ** 2
            bias -= rate * (bias_first / even) / (np.sqrt(bias_second / even_squares) + 1e-8)
    return Machine(kept, strong, float(bias), state[:, 0].copy(), state[:, 1:].copy())


def learn(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    extract: Callable[[pa.RecordBatch], Features],
    sample: int = 8000,
    id_column: str = "doc_id",
    **options,
) -> Machine | None:
    """A machine for ``label`` (0 or 1, other values are ignored), from at most about ``sample`` labelled documents.

    Half of the sample is drawn from either label, by a hash of the id; weights restore the true shares. The drawn
    ids are few by that bound, so they are broadcast onto the scan of the texts. All features of the drawn documents
    come to the driver as numbers, and all are trained (``fit``). None where either label is missing.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(id_column).isNotNull()).select(F.col(id_column).alias("id"), F.col(label).cast("int").alias("y"))
    known = known.groupBy("id").agg(F.max("y").alias("y"))
    sizes = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    if len(sizes) < 2:
        return None
    rates = {k: min(1.0, sample / 2 / n) for k, n in sizes.items()}
    draw = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1_000_003)) / 1_000_003.0
    drawn = known.where(draw < F.when(F.col("y") == 1, rates[1]).otherwise(rates[0]))
    joined = docs.withColumnRenamed(id_column, "id").join(F.broadcast(drawn), "id")

    def features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            doc, feature = extract(part)
            order = np.lexsort((feature, doc))
            ends = np.searchsorted(doc[order], np.arange(part.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(ends, pa.array(feature[order].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column("id").cast(pa.int64()), part.column("y"), lists], ["id", "y", "f"])

    got = joined.mapInArrow(features_of, "id long, y int, f array<int>").toArrow().combine_chunks()
    y = got["y"].to_numpy().astype(float)
    if y.sum() in (0, len(y)):
        return None
    lists = got["f"].combine_chunks()
    many = lists.value_lengths().to_numpy()
    flat = lists.flatten().to_numpy()
    doc = np.repeat(np.arange(len(y)), many)
    # Rows arrive in any order: they are numbered by id, and those that share an id by their features.
    order = np.lexsort((np.bincount(doc, flat, len(y)), many, got["id"].to_numpy()))
    number = np.empty(len(y), np.int64)
    number[order] = np.arange(len(y))
    weight = np.where(y[order] == 1, 1 / rates[1], 1 / rates[0])
    return fit(len(y), (number[doc], flat), y[order], weight / weight.mean(), **options)


def apply(
    docs: DataFrame,
    machine: Machine | None,
    extract: Callable[[pa.RecordBatch], Features],
    threshold: float,
    score: str = "score",
    predicted: str = "predicted",
) -> DataFrame:
    """All columns of ``docs`` with the score and the label; 0.0 and 0 everywhere if there was nothing to learn from."""
    kept = [f for f in docs.schema.fields if f.name not in (score, predicted)]
    schema = T.StructType([*kept, T.StructField(score, T.DoubleType()), T.StructField(predicted, T.IntegerType())])
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            s = machine.scores(part.num_rows, extract(part)) if machine else np.zeros(part.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*[part.column(n) for n in names], pa.array(s), pa.array((s >= threshold).astype(np.int32))], [*names, score, predicted]
            )

    return docs.mapInArrow(run, schema)
