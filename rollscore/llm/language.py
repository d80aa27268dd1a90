"""Language identification by a byte convolutional network, trained in numpy and applied to fixed-length windows."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, texts_of

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
SPAN = max(WIDTHS)
STEP = WINDOW - SPAN + 1
UNDETERMINED = "und"


def lowered(batch: pa.RecordBatch, text: str) -> pa.Array:
    return pc.utf8_lower(texts_of(batch, text))


def windows(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all texts in order: first byte of each in the buffer, its bytes used, and its text's number.

    Windows overlap by the widest filter less one, so every position of every filter is in one window; an empty text
    has one empty window.
    """
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    sizes = np.diff(offsets)
    count = np.maximum(1, -(-(sizes - SPAN + 1) // STEP))
    row = np.repeat(np.arange(len(texts)), count)
    place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[row] + place * STEP
    return start, np.minimum(WINDOW, offsets[row] + sizes[row] - start), row


def matrix(data: np.ndarray, start: np.ndarray, used: np.ndarray) -> np.ndarray:
    """The bytes of windows as rows, 0 after their end."""
    at = np.arange(WINDOW)
    inside = at < used[:, None]
    return np.where(inside, data[np.where(inside, start[:, None] + at, 0)] if len(data) else 0, 0).astype(np.uint8)


@dataclass
class ByteNet:
    """``embed`` (256 x EMBED), ``filters`` (SPAN x EMBED x all filters; narrow ones end in zeros), then a softmax."""

    classes: list[str]
    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def tables(self) -> np.ndarray:
        """What each byte at each offset adds to each filter."""
        return np.einsum("be,jef->jbf", self.embed, self.filters).astype(np.float32)

    def pair_tables(self) -> tuple[np.ndarray, np.ndarray]:
        """The same for two neighbouring bytes at once, for offsets 0 and 1, and for 2 and 3."""
        t = self.tables()
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, -1)
        return pair(t[0], t[1]), pair(t[2], t[3])

    def chances(self, pooled: np.ndarray) -> np.ndarray:
        z = np.maximum(pooled + self.bias, 0) @ self.out + self.out_bias
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def pooled(x: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The largest response of each filter over the positions of each window."""
    pair = x[:, :-1].astype(np.intp) * 256 + x[:, 1:]
    heard = tables[0][pair[:, : -(SPAN - 2)]]
    heard += tables[1][pair[:, SPAN - 2 :]]
    return heard.max(axis=1)


def fit(x: np.ndarray, y: np.ndarray, classes: list[str], epochs: int = 6, batch: int = 128, rate: float = 5e-3) -> ByteNet:
    """Cross-entropy by Adam, with balanced classes. The gradient of max pooling goes to the winning position."""
    rng, total = np.random.default_rng(7), FILTERS * len(WIDTHS)
    net = ByteNet(
        classes,
        rng.normal(0, 0.5, (256, EMBED)),
        rng.normal(0, 0.3, (SPAN, EMBED, total)),
        np.zeros(total),
        rng.normal(0, 0.1, (total, len(classes))),
        np.zeros(len(classes)),
    )
    used = np.concatenate([np.repeat((np.arange(SPAN) < w).astype(float)[:, None], FILTERS, 1) for w in WIDTHS], axis=1)
    net.filters *= used[:, None, :]
    net.embed[0] = 0
    weight = len(y) / (len(classes) * np.maximum(1, np.bincount(y, minlength=len(classes))))
    names = ("embed", "filters", "bias", "out", "out_bias")
    first = {n: np.zeros_like(getattr(net, n)) for n in names}
    second = {n: np.zeros_like(getattr(net, n)) for n in names}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            xb, yb = x[rows].astype(np.intp), y[rows]
            t = net.tables()
            heard = sum(t[j][xb[:, j : WINDOW - SPAN + 1 + j]] for j in range(SPAN))
            place = heard.argmax(axis=1)
            top = np.take_along_axis(heard, place[:, None, :], 1)[:, 0, :]
            p = net.chances(top)
            p[np.arange(len(yb)), yb] -= 1
            p *= (weight[yb] / len(yb))[:, None]
            hidden = np.maximum(top + net.bias, 0)
            back = (p @ net.out.T) * (hidden > 0)
            dt = np.zeros((SPAN, 256, total))
            column = np.broadcast_to(np.arange(total), place.shape)
            for j in range(SPAN):
                np.add.at(dt[j], (np.take_along_axis(xb, place + j, 1), column), back)
            grads = {
                "embed": np.einsum("jbf,jef->be", dt, net.filters, optimize=True),
                "filters": np.einsum("jbf,be->jef", dt, net.embed, optimize=True) * used[:, None, :],
                "bias": back.sum(axis=0),
                "out": hidden.T @ p + 1e-4 * net.out,
                "out_bias": p.sum(axis=0),
            }
            grads["embed"][0] = 0
            step += 1
            for n in names:
                first[n] = 0.9 * first[n] + 0.1 * grads[n]
                second[n] = 0.999 * second[n] + 0.001 * grads[n] ** 2
                move = first[n] / (1 - 0.9**step) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)
                setattr(net, n, getattr(net, n) - rate * move)
    return net


def sample_windows(df: DataFrame, text: str, label: str, seed_column: str, per_class: int) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Training windows of about ``per_class`` documents of each class, chosen by a hash: two places and a short cut of each."""
    named = df.select(
        F.col(f"`{text}`").alias("text"), F.col(f"`{label}`").cast("string").alias("label"), F.col(f"`{seed_column}`").cast("string").alias("id")
    ).where("label is not null and text is not null")
    sizes = {r.label: r["count"] for r in named.groupBy("label").count().collect()}
    if not sizes:
        return np.zeros((0, WINDOW), np.uint8), np.zeros(0, int), []
    rates = F.create_map(*[F.lit(v) for k, n in sorted(sizes.items()) for v in (k, min(1.0, per_class / n))])
    share = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1_000_003)) / 1_000_003.0

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks([batch], "text"):
                texts = lowered(part, "text")
                start, used, row = windows(texts)
                data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
                first = np.searchsorted(row, np.arange(len(texts)))
                count = np.bincount(row, minlength=len(texts))
                turn = np.array([zlib.crc32((x or "").encode()) for x in part.column("id").to_pylist()], np.int64)
                picks = [first + turn % count, first + turn // 7 % count, first + turn // 49 % count]
                kept = [used[picks[0]], used[picks[1]], np.minimum(used[picks[2]], 6 + turn % 60)]
                rows = np.concatenate([matrix(data, start[p], u) for p, u in zip(picks, kept, strict=True)])
                labels = part.column("label").to_pylist() * 3
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in rows], pa.binary()), pa.array(labels, pa.string())], ["x", "y"])

    got = (
        named.where(share < F.element_at(rates, F.col("label")))
        .mapInArrow(cut, "x binary, y string")
        .toPandas()
        .drop_duplicates()
        .sort_values(["y", "x"])
    )
    classes = sorted(sizes)
    x = np.frombuffer(b"".join(got.x), np.uint8).reshape(-1, WINDOW)
    return x, np.searchsorted(classes, got.y.to_numpy(str)) if len(got) else np.zeros(0, int), classes


def train(df: DataFrame, text: str = "text", label: str = "lang", id_column: str = "doc_id", per_class: int = 1500) -> ByteNet | None:
    """A net learned from the rows with a label; None if there is none.

    About ``per_class`` documents of each class are used (all of a smaller class), three windows of each. That bound
    on the sample is all that is limited; the driver holds classes x per_class x 3 windows of 256 bytes.
    """
    x, y, classes = sample_windows(df, text, label, id_column, per_class)
    return fit(x, y, classes) if len(x) else None


def predict(df: DataFrame, net: ByteNet | None, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """All columns of ``df`` with the language of the whole text, and the mean chance of it over all windows (0 to 1).

    Every window of a text is read, weighted by its bytes. Null texts, texts without a letter, and all texts where
    there was nothing to learn from are ``und`` with score 0. No shuffle: rows stay where they are, repeated ones
    each get a result; a task holds one chunk of texts at a time. Columns named like a result are replaced.
    """
    kept = [f for f in df.schema.fields if f.name not in (lang, score)]
    schema = T.StructType([*kept, T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())])
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = net.pair_tables() if net else None
        for part in chunks(batches, text):
            texts = lowered(part, text)
            letter = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
            if net is None:
                best, value = np.full(len(texts), UNDETERMINED, object), np.zeros(len(texts))
            else:
                chance = text_chances(net, tables, texts)
                best = np.array(net.classes, object)[chance.argmax(axis=1)]
                value = np.clip(chance.max(axis=1), 0, 1)
            best, value = np.where(letter, best, UNDETERMINED), np.where(letter, value, 0.0)
            yield pa.RecordBatch.from_arrays([*[part.column(n) for n in names], pa.array(best, pa.string()), pa.array(value)], [*names, lang, score])

    return df.mapInArrow(run, schema)


def text_chances(net: ByteNet, tables: tuple[np.ndarray, np.ndarray], texts: pa.Array, block: int = 256) -> np.ndarray:
    """The chance of each class for each text: the mean over its windows by bytes."""
    start, used, row = windows(texts)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    top = np.concatenate([pooled(matrix(data, start[a : a + block], used[a : a + block]), tables) for a in range(0, len(row), block)])
    weight = np.maximum(used, 1)[:, None]
    chance = net.chances(top) * weight
    edges = np.searchsorted(row, np.arange(len(texts)))
    return np.add.reduceat(chance, edges, axis=0) / np.add.reduceat(weight, edges, axis=0)


def learnable(held: Column) -> Column:
    """Rows to learn from: those not held out; a row without an id is held out."""
    return ~F.coalesce(held, F.lit(True))
