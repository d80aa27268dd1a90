"""Exact n-gram Jaccard join as a blocked sparse product of the document by n-gram incidence matrix."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, components, mix, shingles, split_words, texts_of, word_hashes, written

#: Members that are compared with one leader in one block.
BLOCK = 256
#: Leaders of different components that a block offers in the second round, and those that a class is multiplied with.
LEADERS = 8
NEAREST = 4
#: Sums of two set sizes are cut into steps, each so many hundredths of the one before.
STEP = 140
#: The lowest bits of a block's number tell its step.
STEP_BITS = 4
#: Bits of the filter that keeps sets without a candidate out of the shuffle.
FILTER_BITS = 1 << 23
#: Words of 64 parity bits in the sketch of a set.
PARITIES = 8


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def sets_of(part: pa.RecordBatch, width: int) -> list[np.ndarray]:
    """The sorted different shingle hashes of each text. Words: runs without ASCII white space, A-Z lower-cased."""
    words, bounds = split_words(pc.ascii_lower(texts_of(part, "text")))
    runs, edges = shingles(word_hashes(words), bounds, width)
    return [np.unique(runs[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def class_of(row: np.ndarray) -> int:
    """Documents with the same set are one class, one row of the matrix; its number is a hash of the set."""
    return xxhash.xxh3_64_intdigest(row.tobytes()) - (1 << 63)


def parities(row: np.ndarray) -> np.ndarray:
    """A sketch of a set: columns are dealt over bits, and a bit tells whether its number of columns is odd.

    Bits in which two sketches differ stand for at least one column each that only one of the sets has.
    """
    odd = np.bincount((row >> np.uint64(20)).astype(np.int64) % (64 * PARITIES), minlength=64 * PARITIES) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def room(n: Column, m: Column, own: Column, other: Column, percent: int) -> Column:
    """In how many more bits the sketches of two sets of ``n`` and ``m`` columns might differ if the sets were similar."""
    differ = sum((F.bit_count(own[k].bitwiseXOR(other[k])) for k in range(PARITIES)), F.lit(0))
    return n + m - 2 * F.ceil(percent * (n + m) / F.lit(100 + percent)) - differ


def may_link(n: Column, m: Column, own: Column, other: Column, percent: int) -> Column:
    """Whether the sketches of two sets leave room for the similarity. No similar pair is refused."""
    return room(n, m, own, other, percent) >= 0


def steps(percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sums, blocks, spare): for pairs whose sizes add up to ``sums`` at most, into how many blocks the columns are cut.

    Similar sets whose sizes add up to s differ in s * (100 - percent) / (100 + percent) columns at most, each of which
    spoils one block. With ``spare`` blocks and one more than that, so many are the same in both. Sums up to the first
    leave room for no difference.
    """
    sums, blocks, spare = [(99 + percent) // (100 - percent) if percent < 100 else 1 << 40], [0], [0]
    while sums[-1] < 1 << 40:
        low, high = sums[-1], max(sums[-1] + 1, sums[-1] * STEP // 100)
        differ = high * (100 - percent) // (100 + percent)
        free = (differ + 1) * math.exp(-low * percent / (100 + percent) / (differ + 1))
        sums.append(high)
        spare.append(int(free + 3 * math.sqrt(free)))
        blocks.append(differ + 1 + spare[-1])
    return np.array(sums), np.array(blocks), np.array(spare)


def block_hashes(rows: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, whose): one for each block of columns that a row has any of, at each step that the row may be paired in.

    Two similar sets share a hash: at the step of their sizes more than ``spare`` blocks are the same in both. A set that
    has more empty blocks than that shows the empty ones too. Third: how many hashes of one step each row shares with any
    similar one at least.
    """
    sums, blocks, spare = steps(percent)
    sizes = np.array([len(r) for r in rows], np.int64)
    columns = np.concatenate([*rows, np.empty(0, np.uint64)])
    first = np.maximum(np.searchsorted(sums, sizes + (percent * sizes + 99) // 100), 1)
    last = np.searchsorted(sums, sizes + 100 * sizes // percent)
    hashes, whose, need = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], np.full(len(rows), 1 << 30)
    for k in range(int((last - first).max(initial=-1)) + 1):
        on = (first + k <= last) & (sizes > 0)
        if not on.any():
            continue
        step = np.where(on, first + k, 0)
        own = np.repeat(np.flatnonzero(on), sizes[on])
        column = columns[np.repeat(on, sizes)]
        place = ((column >> np.uint64(32)) * blocks[step][own].astype(np.uint64)) >> np.uint64(32)
        starts = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (own[1:] != own[:-1])]))
        total, place, own = np.add.reduceat(mix(column), starts), place[starts], own[starts]
        free = blocks[step] - np.bincount(own, minlength=len(rows))
        need[on] = np.minimum(need, np.maximum(spare[step] + 1 - free, 1))[on]
        empty, shown = [], []
        for i in np.flatnonzero(on & (free > spare[step])):
            empty.append(np.setdiff1d(np.arange(blocks[step[i]], dtype=np.uint64), place[slice(*np.searchsorted(own, [i, i + 1]))]))
            shown.append(np.full(len(empty[-1]), i))
        total = np.concatenate([total, np.zeros(sum(map(len, empty)), np.uint64)])
        place, own = np.concatenate([place, *empty]), np.concatenate([own, *shown])
        at = step[own].astype(np.uint64)
        low = np.uint64((1 << STEP_BITS) - 1)
        hashes.append(mix(mix(total + at) + place) & ~low | at & low)
        whose.append(own)
    return np.concatenate(hashes), np.concatenate(whose), need


def documents(df: DataFrame, width: int, percent: int | None = None) -> DataFrame:
    """(id, n, class, sketch) of each row, and where ``percent`` is given its blocks (block, class), with a null ``n``.

    ``need`` is the least number of blocks of one step that the class shares with any similar one; it stands where the
    blocks are given. Rows without an id have no blocks, and of rows of one class in a task one has. The rows of documents have numbers of
    their own in ``block``, which only deal them out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        number = TaskContext.get().partitionId() << 40
        for part in chunks(batches, "text"):
            rows = sets_of(part, width)
            sizes = pa.array([len(r) for r in rows], pa.int64())
            found = [class_of(r) if len(r) else None for r in rows]
            sketches = pa.array([parities(r) if len(r) else None for r in rows], pa.list_(pa.int64()))
            own = pa.array(signed(mix(np.arange(number, number + len(rows), dtype=np.uint64))))
            number += len(rows)
            if len(seen) > 1_000_000:
                seen.clear()
            known = part.column("id").is_valid().to_pylist()
            new = {c: r for c, r, k in zip(found, rows, known, strict=True) if k and c is not None and c not in seen}
            new = new if percent is not None else {}
            seen.update(new)
            classes, held = np.array(list(new), np.int64), list(new.values())
            least = {}
            for a in range(0, len(held), 500):
                hashes, whose, need = block_hashes(held[a : a + 500], percent)
                least |= zip(classes[a : a + 500].tolist(), need.tolist(), strict=True)
                none = [pa.nulls(len(hashes), t) for t in (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32())]
                own_classes = pa.array(classes[a : a + 500][whose])
                yield pa.RecordBatch.from_arrays([*none[:2], own_classes, none[2], pa.array(signed(hashes)), none[3]], names)
            need = pa.array([least.get(c) for c in found], pa.int32())
            yield pa.RecordBatch.from_arrays([part.column("id"), sizes, pa.array(found, pa.int64()), sketches, own, need], names)

    names = ["id", "n", "class", "sketch", "block", "need"]
    return df.mapInArrow(run, "id long, n long, class long, sketch array<long>, block long, need int")


def overlaps(df: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """Exact overlap counts of candidate pairs (a, b): the product of each leading row with blocks of its partners.

    A leader with many partners is repeated for every ``BLOCK`` of them. Each set travels once for each of its roles;
    a bit filter of fixed size keeps most sets without a role from travelling.
    """
    sized = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = pairs.join(sized, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int").alias("block"))
    leads = sized.select("a", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    roles = dealt.select(F.col("b").alias("class"), "a", "block", F.lit(1).alias("member")).union(
        leads.select(F.col("a").alias("class"), "a", "block", F.lit(0).alias("member"))
    )
    # Written, as a join with a union may be planned as a union of joins, each of which reads and cuts all texts again.
    roles = written(roles, "roles")
    bits = roles.select(F.pmod("class", F.lit(FILTER_BITS)).cast("int").alias("bit")).distinct().toPandas().bit
    wanted = np.zeros(FILTER_BITS, bool)
    wanted[bits.to_numpy(np.int64)] = True
    packed = np.packbits(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        has_role = np.unpackbits(packed).astype(bool)
        seen: set[int] = set()
        for part in chunks(batches, "text"):
            if len(seen) > 1_000_000:
                seen.clear()
            rows = [(class_of(r), r) for r in sets_of(part, width) if len(r)]
            new = {c: r for c, r in rows if has_role[c % FILTER_BITS] and c not in seen}
            seen.update(new)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(new), pa.int64()), pa.array([r.tobytes() for r in new.values()], pa.binary())], ["class", "row"]
            )

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead, whose = None, None
        for batch in batches:
            a, b, member, data = (batch.column(c) for c in ("a", "class", "member", "row"))
            out = []
            for x, y, m, d in zip(a.to_pylist(), b.to_pylist(), member.to_pylist(), data, strict=True):
                row = np.frombuffer(d.as_buffer(), np.uint64)
                if not m:
                    lead, whose = row, x
                elif whose == x:
                    at = np.minimum(np.searchsorted(lead, row), len(lead) - 1)
                    out.append((x, y, len(lead), len(row), int((lead[at] == row).sum())))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["a", "b", "na", "nb", "shared"])

    return (
        df.mapInArrow(run, "class long, row binary")
        .dropDuplicates(["class"])
        .join(roles, "class")
        .repartition("a", "block")
        .sortWithinPartitions("a", "block", "member")
        .mapInArrow(multiply, "a long, b long, na long, nb long, shared long")
    )


def links_of(df: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs of classes whose sets are similar enough, by exact counts."""
    counted = overlaps(df, pairs, width)
    return counted.where(100 * F.col("shared") >= percent * (F.col("na") + F.col("nb") - F.col("shared"))).select("a", "b")


def in_several(index: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of the index with their ``component``, of blocks that are in several components."""
    known = found.withColumnRenamed("node", "class")
    block = Window.partitionBy("block")
    return (
        index.join(known, "class", "left")
        .withColumn("component", F.coalesce("component", "class"))
        .repartition("block")
        .withColumn("low", F.min("component").over(block))
        .withColumn("high", F.max("component").over(block))
        .where("low <> high")
        .select("block", "class", "component")
        .dropDuplicates(["block", "class"])
    )


def nearest(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b): for each class b the classes a of other components that its sketch is closest to, of those its blocks offer.

    ``rows``: blocks with class, component, size and sketch. Each block offers one class of each slot of components,
    other ones than the next block does, so a class of a large group meets many others of it.
    """
    slot = F.pmod(F.xxhash64("component", "block"), F.lit(LEADERS)).alias("slot")
    lead = F.min_by(F.struct("class", "component", "n", "sketch"), F.xxhash64("class", "block")).alias("lead")
    left = room(F.col("n"), F.col("lead.n"), F.col("sketch"), F.col("lead.sketch"), percent)
    met = (
        rows.join(rows.groupBy("block", slot).agg(lead).drop("slot"), "block")
        .where((F.col("component") != F.col("lead.component")) & (left >= 0))
        .select(F.col("lead.class").alias("a"), F.col("class").alias("b"), left.alias("left"))
        .distinct()
    )
    place = F.row_number().over(Window.partitionBy("b").orderBy(F.desc("left"), "a"))
    return met.withColumn("place", place).where(F.col("place") <= NEAREST).select("a", "b")


def with_enough(index: DataFrame, sketches: DataFrame) -> DataFrame:
    """The blocks (block, class, low) of several classes, without those of classes that have too few of a step for any link.

    A class that shares fewer blocks with all others together than it must share with a similar one is similar to none
    of that step.
    """
    step = F.col("block").bitwiseAND(F.lit((1 << STEP_BITS) - 1)).alias("step")
    block = Window.partitionBy("block")
    return (
        index.select("block", "class")
        .repartition("class")
        .dropDuplicates(["class", "block"])
        .withColumn("step", step)
        .withColumn("shared", F.count(F.lit(1)).over(Window.partitionBy("class", "step")))
        .join(sketches.select("class", "need"), "class")
        .where("shared >= need")
        .select("block", "class")
        .repartition("block")
        .withColumn("low", F.min("class").over(block))
        .withColumn("high", F.max("class").over(block))
        .where("low <> high")
        .drop("high")
    )


def plausible(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose sketches leave room for the similarity; the others are not multiplied."""
    own = sketches.select(F.col("class").alias("a"), F.col("n").alias("n"), F.col("sketch").alias("own"))
    other = sketches.select(F.col("class").alias("b"), F.col("n").alias("m"), F.col("sketch").alias("other"))
    both = pairs.join(own, "a").join(other, "b")
    return both.where(may_link(F.col("n"), F.col("m"), F.col("own"), F.col("other"), percent)).select("a", "b")


def similar_classes(df: DataFrame, index: DataFrame, sketches: DataFrame, width: int, percent: int) -> DataFrame:
    """(node, component) of the linked classes. Every two similar classes get one component.

    ``index``: the blocks that several classes have, (block, class, low), with the smallest of these classes.
    ``sketches``: class, size and sketch, one row for each class.

    1. Each class is multiplied with one leader, the class with which it shares most of those blocks whose smallest class
       that is, then in blocks that join several components with the nearest ones of a few. Components merge after each
       round. So near copies, however many, become few components by a few products each.
    2. In blocks that still join several components, all pairs of different components within the size bounds meet.
       Pairs whose sketches differ too much are refused at once, the others are multiplied. Pairs within one component
       need no product.
    """
    shared = index.where("class <> low").groupBy(F.col("low").alias("a"), F.col("class").alias("b")).agg(F.count(F.lit(1)).alias("shared"))
    star = shared.groupBy("b").agg(F.max_by("a", F.struct("shared", "a")).alias("a")).select("a", "b")
    star = written(plausible(star, sketches, percent), "star")
    found = written(components(links_of(df, star, width, percent)), "star-components")

    mixed = written(in_several(index.select("block", "class"), found).join(sketches, "class"), "mixed")
    near = written(nearest(mixed, percent).join(star, ["a", "b"], "left_anti"), "near")
    second = links_of(df, near, width, percent)
    found = written(components(second.union(found.select("component", "node"))), "near-components")

    done = star.union(near)
    done = done.union(done.select("b", "a")).distinct()
    mixed = written(in_several(mixed.select("block", "class"), found).join(sketches, "class"), "mixed")
    x, y = mixed.alias("x"), mixed.alias("y")
    n, m = F.col("x.n"), F.col("y.n")
    pairs = (
        x.join(y, F.col("x.block") == F.col("y.block"))
        .where((n < m) | ((n == m) & (F.col("x.class") < F.col("y.class"))))
        .where((100 * n >= percent * m) & (F.col("x.component") != F.col("y.component")))
        .where(may_link(n, m, F.col("x.sketch"), F.col("y.sketch"), percent))
        .select(F.col("x.class").alias("a"), F.col("y.class").alias("b"))
        .distinct()
        .join(done, ["a", "b"], "left_anti")
    )
    rest = written(links_of(df, written(pairs, "rest-pairs"), width, percent), "rest-links")
    return components(rest.union(found.select("component", "node")))


def near_copies(df: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = 4, percent: int = 85) -> DataFrame:
    """(id_column, n_shingles, component_id) for every row of ``df``: the classes of the Jaccard similarity join.

    Two documents link where 100 * intersection >= percent * union of their sets of ``width``-word shingles; the
    component is the smallest id reachable by links. A text with fewer words is one shingle; null and empty texts
    have none and link with nothing. Rows with a null id take no part and get a null component. Repeated rows, and
    rows that share an id, each keep their row; their sets all count. Only the id and the text are read, so other
    columns may have any name. An empty table gives an empty result. Ids are integers.

    The join is exact but for 64-bit hashes: of n different sets, about n * n / 2^65 pairs share a number by chance.
    """
    docs = df.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    block = Window.partitionBy("block")
    sets = (
        documents(docs, width, percent)
        .repartition("block")
        .withColumn("low", F.min("class").over(block))
        .withColumn("high", F.max("class").over(block))
        .where("n is not null or low <> high")
        .drop("high")
    )
    # Documents and blocks are written together, so that the texts are cut once for both.
    sets = written(sets, "sets")
    rows, index = sets.where("n is not null"), sets.where("n is null").select("block", "class", "low")
    known = docs.where("id is not null")
    least = rows.where("id is not null and class is not null").groupBy("class").agg(F.min("id").alias("least"))
    sketches = rows.where("id is not null and need is not null").dropDuplicates(["class"]).select("class", "n", "sketch", "need")
    index = written(with_enough(index, sketches), "index")
    sketches = sketches.drop("need")
    found = similar_classes(known, index, sketches, width, percent)
    reached = found.join(least, found.node == least["class"]).groupBy("component").agg(F.min("least").alias("component_id"))
    named = least.join(found, least["class"] == found.node, "left").join(reached, "component", "left")
    named = named.select("class", F.coalesce("component_id", "least").alias("component_id"))
    out = rows.join(named, "class", "left")
    return out.select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"),
    )
