"""Fill-in-middle: texts cut at two seeded unit ranks, found in an indexable skip list, and put together again."""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, mix, texts_of

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: A node reaches the next lane with a chance of one in 2 ** LANE_BITS.
LANE_BITS = 2
RESULT = {"n_units": T.LongType(), "form": T.StringType(), "prefix_chars": T.LongType(), "middle_chars": T.LongType()}


def heights(n: int) -> np.ndarray:
    """The highest lane of each of ``n`` nodes: a seeded coin by rank, so all lists share one array."""
    coins = mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    lowest = coins & (~coins + np.uint64(1))
    return (np.log2(lowest.astype(np.float64)) // LANE_BITS).astype(np.int8)


class SkipList:
    """Units of a text by rank. Every link of a lane carries the units and the code points that it passes over.

    ``at`` holds the code point at which each unit starts, and the length of the text at its end.
    """

    def __init__(self, at: np.ndarray, tall: np.ndarray) -> None:
        """``tall``: the highest lane of each node. The first node is the head, which is in all lanes."""
        n = len(at) - 1
        self.lanes = []
        nodes, below = np.arange(n), None
        while len(nodes):
            ends = np.append(nodes[1:], n)
            down = nodes if below is None else np.searchsorted(below, nodes)
            self.lanes.append((ends - nodes, at[ends] - at[nodes], down))
            if len(nodes) == 1:
                break
            below = nodes
            up = nodes[tall[nodes] >= len(self.lanes)]
            nodes = up if len(up) and up[0] == 0 else np.insert(up, 0, 0)
            if len(nodes) == len(below):
                break

    def reach(self, rank: int) -> int:
        """Code points in front of the unit with this rank; all of them for the number of units."""
        units = points = node = 0
        for k in range(len(self.lanes) - 1, -1, -1):
            unit_widths, point_widths, down = self.lanes[k]
            while node < len(unit_widths) and units + unit_widths[node] <= rank:
                units += unit_widths[node]
                points += point_widths[node]
                node += 1
            if node == len(unit_widths):
                break
            node = down[node]
        return int(points)


def unit_starts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For all units of all texts: their first byte and first code point; the byte and the unit at which texts start.

    A unit is a run of the letters A-Z and a-z, or one other code point.
    """
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8, int(offsets[-1]))
    letter = ((data | 32) - np.uint8(97)) < 26
    first = (data & 0xC0) != 0x80
    begins = first.copy()
    begins[1:] &= ~(letter[1:] & letter[:-1])
    begins[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(begins)
    point = np.cumsum(first, dtype=np.int64) - 1
    return starts, point[starts], offsets, np.searchsorted(starts, offsets)


def draws(seed: int, number: int | None) -> tuple[int, int, int, int]:
    """Four unsigned integers of a document: the first bytes of the digest of ``seed:id``."""
    own = f"{seed}:{'' if number is None else number}".encode()
    return struct.unpack(">4I", hashlib.sha256(own).digest()[:16])


def fill_in_middle(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    seed: int = 1,
    plain_percent: int = 10,
    spm_percent: int = 20,
    result: str = "fim_text",
) -> DataFrame:
    """All columns of ``df`` with ``n_units``, ``form``, ``prefix_chars``, ``middle_chars`` and the text put in that form.

    Whole texts are cut in front of two units drawn from seed and id: the prefix ends at the smaller rank, the middle
    at the larger. The ranks are found by going down a skip list whose links carry both units and code points. Form psm
    is prefix, suffix, middle, each behind its mark; spm has the suffix first; plain is the text as it is.

    A null text counts as empty; an empty text, and one that holds a mark itself, stay plain, with null cuts. Rows that
    share an id and a text get the same cuts, a null id counts as an empty one. Columns named like the results are
    replaced. Row-local: an empty table stays empty, and repeated rows all stay.
    """
    kept = [f for f in df.schema.fields if f.name not in {*RESULT, result}]
    own = df.select(
        F.col(f"`{id_column}`").cast("long").alias("_id"),
        F.col(f"`{text}`").cast("string").alias("_text"),
        F.struct(*[F.col(f"`{f.name}`") for f in kept]).alias("_row"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tall = heights(1 << 12)
        for part in chunks(batches, "_text"):
            texts = texts_of(part, "_text")
            starts, points, offsets, first = unit_starts(texts)
            most = int(np.diff(first).max(initial=0))
            if most > len(tall):
                tall = heights(most)
            data = memoryview(texts.buffers()[2] or b"")
            columns = [[], [], [], [], []]
            for i, number in enumerate(part.column("_id").to_pylist()):
                body = bytes(data[offsets[i] : offsets[i + 1]])
                a, b = int(first[i]), int(first[i + 1])
                values = cut_text(body, starts[a:b] - offsets[i], points[a:b], tall, draws(seed, number), plain_percent, spm_percent)
                for column, value in zip(columns, values, strict=True):
                    column.append(value)
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)]
            yield pa.RecordBatch.from_arrays(
                [part.column("_row"), *arrays, pa.array(columns[-1], pa.large_binary()).cast(pa.large_string()).cast(pa.string())],
                ["_row", *RESULT, result],
            )

    schema = T.StructType(
        [own.schema["_row"], *[T.StructField(n, t) for n, t in RESULT.items()], T.StructField(result, T.StringType())]
    )
    done = own.mapInArrow(run, schema)
    return done.select(*[F.col("_row")[f.name].alias(f.name) for f in kept], *RESULT, f"`{result}`")


def cut_text(
    body: bytes, starts: np.ndarray, points: np.ndarray, tall: np.ndarray, h: tuple[int, int, int, int], plain: int, spm: int
) -> tuple[int, str, int | None, int | None, bytes]:
    """(units, form, code points of the prefix, of the middle, text in that form)."""
    n = len(starts)
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    if not n or h[2] % 100 >= 100 - plain or any(m in body for m in marks):
        return n, "plain", None, None, body
    # The last unit is a run of letters, one byte each, or one code point.
    last = len(body) - int(starts[-1]) if body[-1] < 128 else 1
    units = SkipList(np.append(points, points[-1] + last) - points[0], tall)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    to_prefix, to_middle = units.reach(a), units.reach(b)
    cuts = [int(starts[r]) if r < n else len(body) for r in (a, b)]
    prefix, middle, suffix = body[: cuts[0]], body[cuts[0] : cuts[1]], body[cuts[1] :]
    p, s, m = marks
    if h[3] % 100 < spm:
        return n, "spm", to_prefix, to_middle - to_prefix, b"".join([s, suffix, p, prefix, m, middle])
    return n, "psm", to_prefix, to_middle - to_prefix, b"".join([p, prefix, s, suffix, m, middle])


def restored(output: Column | str, form: Column | str) -> Column:
    """The text that was cut, from the output and its form alone."""
    c, form = (F.col(x) if isinstance(x, str) else x for x in (output, form))
    whole = F.length(c)

    def between(start: Column, stop: Column) -> Column:
        return F.substring(c, start, F.greatest(stop - start, F.lit(0)))

    p, s, m = (F.instr(c, x) for x in (PREFIX, SUFFIX, MIDDLE))
    size = F.lit(len(PREFIX))
    middle = between(m + size, whole + 1)
    psm = F.concat(between(p + size, s), middle, between(s + size, m))
    spm = F.concat(between(p + size, m), middle, between(s + size, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(c)
