"""The order of any epoch from row numbers alone: a keyed permutation of 0 .. n - 1 as a Spark expression."""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.algebra import let
from ..functions.text import as_col

ROUNDS = 4


def _halves(n: int) -> tuple[int, int]:
    """Two numbers near the root of ``n`` whose product is ``n`` or up to a root more."""
    a = isqrt(max(n - 1, 0)) + 1
    return a, max(1, -(-n // a))


def _turned(x: Column, n: int, seed: int, epoch: int | Column, back: bool) -> Column:
    """One keyed permutation of the numbers below the product of the halves.

    A Feistel network: in turn each half is moved by a hash of the other, which can be undone whatever the hash is.
    """
    a, b = _halves(n)
    epoch = F.lit(epoch) if isinstance(epoch, int) else epoch

    def moved(own: Column, other: Column, size: int, k: Column) -> Column:
        by = F.pmod(F.xxhash64(other, F.lit(seed), epoch, k), F.lit(size).cast("long"))
        return F.pmod(own - by if back else own + by, F.lit(size).cast("long"))

    def step(s: Column, k: Column) -> Column:
        left = k % 2 == 0
        return F.struct(
            F.when(left, moved(s["l"], s["r"], a, k)).otherwise(s["l"]).alias("l"),
            F.when(left, s["r"]).otherwise(moved(s["r"], s["l"], b, k)).alias("r"),
        )

    low = F.pmod(x, F.lit(b).cast("long"))
    start = F.struct(((x - low) / b).cast("long").alias("l"), low.alias("r"))
    last = 2 * ROUNDS - 1
    rounds = F.sequence(F.lit(last if back else 0), F.lit(0 if back else last))
    return F.aggregate(rounds, start, step, lambda s: s["l"] * b + s["r"])


def _walked(c: Column | str, n: int, seed: int, epoch: int | Column, back: bool) -> Column:
    """The permutation again and again until it gives a number below ``n``, which keeps it one to one.

    At most a root of ``n`` numbers lie above, so the walk is over after that many steps, and only about one row in a root of
    ``n`` has to walk at all.
    """
    if not 0 <= n < 1 << 53:
        raise ValueError("n must lie in 0 .. 2 ** 53")
    a, b = _halves(n)
    x = as_col(c).cast("long")
    steps = F.sequence(F.lit(1), F.lit(a * b - n + 1))

    def walk(first: Column) -> Column:
        rest = F.aggregate(steps, first, lambda v, _: F.when(v < n, v).otherwise(_turned(v, n, seed, epoch, back)))
        return F.when(first < n, first).otherwise(rest)

    return F.when((x >= 0) & (x < n), let(_turned(x, n, seed, epoch, back), walk))


def epoch_position(ordinal: Column | str, n: int, seed: int = 42, epoch: int | Column = 0) -> Column:
    """The place of row ``ordinal`` (0 .. n - 1, without gaps) in the order of an epoch; null for other numbers.

    Nothing is sorted or shuffled: rows are numbered once, and every seed and epoch gives another order of all ``n`` places. The
    same number has the same place however the rows are partitioned.
    """
    return _walked(ordinal, n, seed, epoch, back=False)


def epoch_ordinal(position: Column | str, n: int, seed: int = 42, epoch: int | Column = 0) -> Column:
    """The row that has a place in an epoch: what a reader of some batches of it has to fetch."""
    return _walked(position, n, seed, epoch, back=True)
