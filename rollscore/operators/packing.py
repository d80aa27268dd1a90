"""Packing token arrays into rows of one length without cutting documents: best fit on the histogram of lengths."""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shaping import PACKED_LENGTH

#: Pieces numbered in one window partition, on average.
PART_ROWS = 100_000


@dataclass(frozen=True)
class Placing:
    """Pieces of one size with ranks from ``rank`` on: ``each`` of them to a row, rows from ``row`` on, first at ``at``."""

    size: int
    rank: int
    count: int
    row: int
    each: int
    at: int


def best_fit(counts: dict[int, int], length: int) -> list[Placing]:
    """Best-fit decreasing for ``counts`` pieces of each size, row by row of equal free space instead of piece by piece.

    Pieces go by size, largest first, to the row with the least free space that holds them, else to a new row. A row that takes
    a piece stays the best fit for the next one of that size, so it takes as many as it can; rows with equal free space
    have consecutive numbers and are filled together. The work depends on the number of different sizes, not on the
    number of pieces.
    """
    free: list[int] = []
    rows: dict[int, list[tuple[int, int]]] = {}
    placed: list[Placing] = []
    used = 0

    def put_back(space: int, first: int, n: int) -> None:
        if n and space:
            if space not in rows:
                rows[space] = []
                insort(free, space)
            rows[space].append((first, n))

    for size in sorted(counts, reverse=True):
        left, rank = counts[size], 0
        while left:
            at = bisect_left(free, size)
            if at < len(free):
                space = free[at]
                first, n = rows[space].pop()
                if not rows[space]:
                    del rows[space], free[at]
            else:
                space, first = length, used
                n = -(-left // (length // size))
                used += n
            each = space // size
            full, rest = divmod(min(left, n * each), each)
            if full:
                placed.append(Placing(size, rank, full * each, first, each, length - space))
                put_back(space - each * size, first, full)
            if rest:
                placed.append(Placing(size, rank + full * each, rest, first + full, rest, length - space))
                put_back(space - rest * size, first + full, 1)
            taken = full + (rest > 0)
            put_back(space, first + taken, n - taken)
            rank += full * each + rest
            left -= full * each + rest
    return placed


def pack_whole(
    df: DataFrame, row_id: str, tokens: str = "tokens", length: int = PACKED_LENGTH, part_rows: int = PART_ROWS
) -> DataFrame:
    """(packed_row, tokens, documents): rows of at most ``length`` tokens in which documents lie whole, side by side.

    ``documents`` lists (id, size) in order. Only a document longer than a row is cut, into full rows and a rest that is
    packed like a document. The pieces are counted by size: that histogram, at most ``length`` numbers whatever the data
    size, is what the driver packs by best fit. Each piece then finds its row from its rank among the pieces of its size;
    ranks are counted in parts of about ``part_rows`` pieces, so a size that very many documents share is no hot key. A
    row is put together from at most ``length`` tokens.

    Null and empty arrays add nothing and are in no row; rows that share an id, or have none, are documents of their own. The order
    of documents is a hash order that repeats, up to rows that are equal. An empty table gives an empty one.
    """
    if length < 1:
        raise ValueError("a row holds at least one token")
    own = df.select(F.col(f"`{row_id}`").alias("id"), F.col(f"`{tokens}`").alias("t")).where(F.size("t") > 0)
    # The number of a piece in its document, and the place of its first token.
    starts = F.sequence(F.lit(0), F.size("t") - 1, F.lit(length))
    pieces = own.select("id", "t", F.posexplode(starts).alias("nth", "start")).select(
        "id", "nth", F.slice("t", F.col("start") + 1, F.lit(length)).alias("t")
    )
    sized = pieces.withColumn("size", F.size("t")).withColumn("mark", F.xxhash64("id", "nth", "t"))
    counts = {r["size"]: r["n"] for r in own.select(F.size("t").alias("n")).groupBy("n").agg(F.count(F.lit(1)).alias("c")).selectExpr(
        f"inline(filter(array(struct(cast({length} as int) as size, c * (n div {length}) as n), struct(n % {length} as size, c as n)), x -> x.size > 0 and x.n > 0))"
    ).groupBy("size").agg(F.sum("n").alias("n")).collect()}
    spark = df.sparkSession
    placings = spark.createDataFrame(
        [(p.size, p.rank, p.count, p.row, p.each, p.at) for p in best_fit(counts, length)],
        "size int, rank long, count long, row long, each int, at int",
    )

    parts = max(1, -(-sum(counts.values()) // part_rows))
    dealt = sized.withColumn("part", F.pmod("mark", F.lit(parts)).cast("int"))
    before = Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        dealt.groupBy("size", "part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("size", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    inside = Window.partitionBy("size", "part").orderBy("mark", F.asc_nulls_first("id"), "nth")
    ranked = dealt.withColumn("in", F.row_number().over(inside) - 1).join(bases, ["size", "part"]).withColumn("rank", F.col("base") + F.col("in"))
    by_size = placings.groupBy("size").agg(F.sort_array(F.collect_list(F.struct("rank", "count", "row", "each", "at"))).alias("placings"))
    found = ranked.join(by_size, "size").withColumn(
        "p", F.element_at(F.filter("placings", lambda p: (p["rank"] <= F.col("rank")) & (F.col("rank") < p["rank"] + p["count"])), 1)
    )
    nth = F.col("rank") - F.col("p.rank")
    located = found.select(
        (F.col("p.row") + F.floor(nth / F.col("p.each"))).alias("packed_row"),
        F.struct((F.col("p.at") + F.pmod(nth, F.col("p.each")) * F.col("size")).alias("at"), "id", "size", "t").alias("piece"),
    )
    rows = located.groupBy("packed_row").agg(F.array_sort(F.collect_list("piece"), lambda a, b: (a["at"] - b["at"]).cast("int")).alias("pieces"))
    return rows.select(
        "packed_row",
        F.flatten(F.col("pieces.t")).alias("tokens"),
        F.transform("pieces", lambda p: F.struct(p["id"].alias("id"), p["size"].alias("size"))).alias("documents"),
    )
