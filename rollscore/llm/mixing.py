"""Mixing sources to target weights: Sainte-Lague quotas of equal blocks by source and shard, then seeded blocks."""

from __future__ import annotations

from collections.abc import Sequence
from math import lcm

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollscore.operators.skew import attach_by_key

from .common import written

#: Rows of a shard, on average. A shard is laid out in one task.
SHARD_ROWS = 100_000
#: Copies of one document that travel as one row.
COPIES = 4096
#: Words of a block at most, and blocks that the smallest target has at least.
MOST_BLOCK, LEAST_BLOCKS = 1024, 256


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def seeded(*parts: Column) -> Column:
    """A number below 2 ** 60 from the md5 of the parts, the same on any cluster."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]).cast("binary")), 1, 15), 16, 10).cast("long")


def apportion(df: DataFrame, group: Sequence[str], votes: str, seats: str, tie: str, out: str) -> DataFrame:
    """Adds the seats of each row by Sainte-Lague: of the quotients votes / 1, 3, 5 ... of a group, the highest win.

    ``seats`` is the number to give in the row's group; equal quotients go by ``tie``. All but a few seats are certain:
    a row has at least votes * (seats - n / 2) / all votes of them and at most votes * (seats + n / 2) / all votes, each
    rounded, for the n rows of its group. Only the quotients between, about 4 a row, are listed and ranked.
    """
    all_rows = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    v, n = F.col(votes).cast("double"), F.count(F.when(F.col(votes) > 0, 1)).over(all_rows)
    share = v / F.sum(v).over(all_rows)
    least = F.when(v > 0, F.greatest(F.floor(share * (F.col(seats) - n / 2) + 0.5) - 1, F.lit(0))).otherwise(F.lit(0)).cast("long")
    most = F.when((v > 0) & (F.col(seats) > 0), F.floor(share * (F.col(seats) + n / 2) + 0.5) + 1).otherwise(F.lit(0)).cast("long")
    bounds = df.withColumns({"_least": least, "_most": most})
    # A row without an open quotient keeps one entry, which never wins.
    ranks = F.when(F.col("_most") > F.col("_least"), F.sequence(F.col("_least") + 1, F.col("_most")))
    listed = bounds.withColumn("_given", F.sum("_least").over(all_rows)).select("*", F.explode_outer(ranks).alias("_k"))
    quotient = v / (2 * F.col("_k") - 1)
    place = F.row_number().over(all_rows.orderBy(F.desc_nulls_last(quotient), tie, "_k"))
    won = F.col("_k").isNotNull() & (place <= F.col(seats) - F.col("_given"))
    counted = listed.withColumn("_won", won.cast("long")).groupBy(*df.columns, "_least").agg(F.sum("_won").alias("_more"))
    return counted.select(*df.columns, (F.col("_least") + F.col("_more")).alias(out))


def source_targets(sizes: DataFrame, weights: Sequence[int], percent: int, epochs: int) -> DataFrame:
    """(source, source_size, rows) with ``number``, ``target``, ``block`` and ``blocks``.

    Targets fill like water: in order of size by weight, a source stops at ``epochs`` times its size while its share of
    what is left, by weight, would be above that. The first one that is not above sets the level of all others.
    """
    everything = Window.partitionBy(F.lit(0))
    number = F.row_number().over(everything.orderBy(F.asc_nulls_last("source")))
    common = lcm(*weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(F.col("number") - 1, F.lit(len(weights))).cast("int") + 1)
    wide, narrow = "decimal(22,0)", "decimal(12,0)"
    own = sizes.withColumn("number", number).withColumn("weight", weight).withColumns(
        {"cap": (F.col("source_size") * epochs * 100).cast(wide), "place": F.col("source_size").cast(wide) * common / F.col("weight")}
    )
    # Exact: the weight divides the common multiple.
    order = everything.orderBy("place", "number")
    filled = own.withColumns(
        {
            "wish": (F.sum("source_size").over(everything) * percent).cast(wide),
            "all_caps": F.sum("cap").over(everything).cast(wide),
            "nth": F.row_number().over(order),
            "before": F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast(wide),
            "left": F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)).cast(narrow),
        }
    )
    left = F.col("wish") - F.col("before")
    below = left.cast(wide) * F.col("weight").cast(narrow) < F.col("cap") * F.col("left")
    level = F.min(F.when(below, F.struct("nth", left.cast(wide).alias("words"), F.col("left").alias("weights")))).over(everything)
    levelled = filled.withColumn("level", level)
    # weight * percent words over (100 * the weights left)
    shared = (F.col("level.words") * F.col("weight").cast(narrow)).cast("double") / (F.col("level.weights") * 100).cast("double")
    capped = F.col("level").isNull() | (F.col("nth") < F.col("level.nth"))
    aimed = levelled.withColumn("target", F.when(capped, F.col("cap").cast("double") / 100).otherwise(shared))
    smallest = F.min(F.when(F.col("target") > 0, F.col("target"))).over(everything)
    block = F.greatest(F.lit(1), F.least(F.lit(MOST_BLOCK), F.floor(smallest / LEAST_BLOCKS))).cast("long")
    blocked = aimed.withColumn("block", F.coalesce(block, F.lit(1).cast("long")))
    total = F.least("wish", "all_caps").cast("long")
    seats = F.expr("(2 * total + 100 * block) div (200 * block)")
    return apportion(
        blocked.withColumn("total", total).withColumn("seats", seats).select("source", "number", "source_size", "rows", "target", "block", "seats"),
        [],
        "target",
        "seats",
        "number",
        "blocks",
    ).drop("seats")


def mix_sources(
    df: DataFrame,
    id_column: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: Sequence[int] = (5, 2, 1),
    percent: int = 150,
    epochs: int = 2,
    seed: int = 1,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, passes, parts) for every row: the words that the mix takes of it.

    The sources in code-point order, null last, weigh ``weights`` in turn and share ``percent`` of all words; a target
    stops at ``epochs`` times the words of its source and the excess is shared again. The words are given out as blocks of equal
    size: by highest quotients to the sources, then to the shards of a source. In a shard the documents lie one after
    the other in seeded order and are cut in equal blocks. Its quota is whole passes over the shard, and for the rest a run
    of neighbouring blocks from a seeded one on; as the order is seeded, that is a seeded choice of documents of which
    two at most are taken in part.

    ``passes`` is how often the whole document is taken; ``parts`` lists ranges of its words (start, end) taken once more.
    Blocks have at most 1,024 words, and so few that the smallest target has 256 of them; a source below 256 words is
    met to the word. Neither table size nor skew changes the rule.

    Nulls: a null text or one without words has size 0 and is never taken; null sources are one source; null ids are
    documents. Rows equal in id, source and size travel as one row with their number, 4,096 at most, and each copy gets its
    own result, so one id may hold any share of the rows. Other columns are not read, whatever their names. An empty
    table gives an empty one. One row per source goes through a single window; shards have about ``shard_rows`` rows
    each, and one row per shard of a source goes through a window by source.
    """
    sized = df.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{source}`").alias("source"), word_count(text).alias("size"))
    items = written(sized.groupBy("id", "source", "size").agg(F.count(F.lit(1)).alias("copies")), "mix-items")
    words = F.col("size") * F.col("copies")
    sizes = items.groupBy("source").agg(F.sum(words).alias("source_size"), F.sum("copies").alias("rows"))
    sources = written(source_targets(sizes, weights, percent, epochs), "mix-sources")

    some = items.select(
        "id", "source", "size", "copies", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {COPIES}"))).alias("part")
    ).withColumn("copies", F.least(F.lit(COPIES).cast("long"), F.col("copies") - F.col("part") * COPIES))
    place = seeded(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("part"))
    named = attach_by_key(
        some.withColumn("place", place), sources.select("source", "number", "rows", "source_size", "target"), ["source"], ["place"]
    ).drop("_matched")
    shards = F.ceil(F.col("rows") / shard_rows)
    lined = named.withColumn("shard", F.pmod("place", shards).cast("long")).drop("rows")

    totals = lined.groupBy("number", "shard").agg(F.sum(words).alias("shard_words"))
    blocks = totals.join(sources.select("number", F.col("blocks").alias("seats"), "block"), "number").withColumn(
        "shard_blocks", F.expr("IF(shard_words = 0, 0, greatest(1, (2 * shard_words + block) div (2 * block)))")
    )
    possible = F.sum("shard_blocks").over(Window.partitionBy("number")) * epochs
    quotas = apportion(blocks.withColumn("seats", F.least("seats", possible)), ["number"], "shard_blocks", "seats", "shard", "quota")
    turned = quotas.withColumn("first", first_block(seed))
    runs = turned.select(
        "number",
        "shard",
        "shard_words",
        F.expr("IF(shard_blocks = 0, 0, quota div shard_blocks)").alias("passes"),
        F.expr("IF(shard_blocks = 0, 0, first * shard_words div shard_blocks)").alias("start"),
        F.expr(
            """IF(shard_blocks = 0, 0, IF(first + quota % shard_blocks <= shard_blocks,
                (first + quota % shard_blocks) * shard_words div shard_blocks,
                shard_words + (first + quota % shard_blocks - shard_blocks) * shard_words div shard_blocks))"""
        ).alias("stop"),
    )

    line = Window.partitionBy("number", "shard").orderBy("place", F.asc_nulls_first("id"), "part", "size")
    laid = lined.withColumn("at", F.sum(words).over(line) - words).join(runs, ["number", "shard"])
    each = laid.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))).withColumn(
        "at", F.col("at") + F.col("copy") * F.col("size")
    )

    def met(shift: Column) -> Column:
        a, b = F.greatest("start", F.col("at") + shift), F.least("stop", F.col("at") + shift + F.col("size"))
        return F.struct((a - F.col("at") - shift).alias("start"), (b - F.col("at") - shift).alias("end"))

    parts = F.filter(F.array(met(F.lit(0)), met(F.col("shard_words"))), lambda p: p["end"] > p["start"])
    found = each.withColumn("parts", parts)
    once = F.aggregate("parts", F.lit(0).cast("long"), lambda s, p: s + p["end"] - p["start"])
    return found.select(
        F.col("id").alias(id_column), "source", "size", "source_size", "target", (F.col("passes") * F.col("size") + once).alias("taken"), "passes", "parts"
    )


def first_block(seed: int) -> Column:
    """The seeded block at which a shard's run begins."""
    drawn = F.pmod(seeded(F.lit(seed), F.lit("run"), F.col("number"), F.col("shard")), F.greatest("shard_blocks", F.lit(1)))
    return drawn.cast("long")
