"""SentencePiece encoding and decoding by a relational lattice over the different words of the corpus."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollscore.session import fresh_path

from .common import chunks

SPACE = "▁"
#: Text bytes of a block; documents of a block share one list of words.
BLOCK_BYTES = 12 << 20
#: The words in most blocks, at most so many, are sent to all tasks as hash and cuts, 16 bytes each; the others are joined.
FREQUENT = 1_000_000
#: The seed of Spark's own 64-bit hash.
SEED = 42
#: Words that leave a task at once.
SENT = 20_000
#: Words that leave the lattice at once, or edges of one word after which it leaves.
EDGED = 4000
EDGES = "array<struct<cost:double,size:int,start:int>>"
#: Stands for the word that is a NUL character; no other word has these two characters.
NUL_WORD = "\x01\x02"
#: Bits of a mask in which cuts between characters are kept.
BITS = 62
#: Bits of a block's number that count the blocks of one task; the task's number stands above them.
BLOCK_BITS = 32
#: Different words of a block that are spelled at once, and words of texts that leave at once.
SPELLED = 20_000
SENT_CODES = 100_000


@dataclass
class Vocabulary:
    """``pieces``: text, id and score of the ordinary pieces. ``kind``: bpe (merges by score) or unigram (best sum)."""

    pieces: list[tuple[str, int, float]]
    bytes_from: int | None
    unknown: int
    kind: str = "bpe"

    @staticmethod
    def load(path: str, kind: str = "bpe") -> Vocabulary:
        """From a public model file, read by the driver. The number of pieces is fixed by the model."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        other = lambda i: model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
        own = [(model.id_to_piece(i), i, model.get_score(i)) for i in ids if not other(i)]
        return Vocabulary(own, next((i for i in ids if model.is_byte(i)), None), model.unk_id(), kind)

    def units(self) -> re.Pattern:
        """Stretches that no piece reaches across: a word with the spaces before it, spaces alone, or a lone character."""
        joinable = {c for p, _, _ in self.pieces if len(p) > 1 for c in p} - {SPACE}
        letters = "".join(map(re.escape, sorted(joinable)))
        if any(SPACE in p.lstrip(SPACE) for p, _, _ in self.pieces):
            return re.compile(f"[{SPACE}{letters}]+|.", re.DOTALL)
        return re.compile((f"{SPACE}*[{letters}]+|" if letters else "") + f"{SPACE}+|.", re.DOTALL)


def normal(text: str) -> str:
    return SPACE + text.replace(" ", SPACE) if text else ""


def lattice(words: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(word, blocks, edges): all substrings of a word that are pieces, each as (cost, size, start), in that order.

    A substring is looked up in the pieces, which the model bounds, where the word is; so no row is made for a substring
    and nothing is grouped. Words without an edge are left out.
    """
    longest = max((len(p) for p, _, _ in vocabulary.pieces), default=1)
    least = 2 if vocabulary.kind == "bpe" else 1
    cost = {p: -s for p, _, s in vocabulary.pieces if len(p) >= least}
    begun = {p[:3] for p in cost}

    def edges_of(word: str) -> list[tuple[float, int, int]]:
        n, out = len(word), []
        for start in range(n - least + 1):
            # Where no piece begins with the next three characters, only shorter ones are left to try.
            top = min(longest, n - start) if word[start : start + 3] in begun else min(2, n - start)
            for size in range(least, top + 1):
                c = cost.get(word[start : start + size])
                if c is not None:
                    out.append((c, size, start))
        out.sort()
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, blocks = batch.column("word").to_pylist(), batch.column("blocks").to_pylist()
            kept, edges = [], []
            for i, word in enumerate(words):
                if found := edges_of(word):
                    kept.append(i)
                    edges.append(found)
                # What leaves at once is bounded by edges: a long word has many.
                if len(kept) == EDGED or i == len(words) - 1 or (found and len(found) > EDGED):
                    if kept:
                        yield edge_batch([words[k] for k in kept], [blocks[k] for k in kept], edges)
                    kept, edges = [], []

    return words.select("word", "blocks").mapInArrow(run, f"word string, blocks long, edges {EDGES}")


def edge_batch(words: list[str], blocks: list[int], edges: list[list[tuple[float, int, int]]]) -> pa.RecordBatch:
    ends = np.cumsum([0, *map(len, edges)]).astype(np.int32)
    columns = zip(*(e for x in edges for e in x), strict=True)
    parts = [pa.array(c, k) for c, k in zip(columns, (pa.float64(), pa.int32(), pa.int32()), strict=True)]
    lists = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(parts, ["cost", "size", "start"]))
    return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(blocks, pa.int64()), lists], ["word", "blocks", "edges"])


def merged(n: Column) -> Column:
    """Cuts of a word by merges: edges in order of score, then size and place, each taken if two parts fill it just then.

    That is the order in which pairs are merged one by one, since no piece of the vocabulary comes of a piece with a
    worse score. The cuts are bits; a taken edge clears those inside it.
    """
    small = f"""
        array(aggregate(edges, shiftleft(1L, n + 1) - 1L, (m, e) ->
            IF((shiftright(m, e.start) & 1L) = 1L AND (shiftright(m, e.start + e.size) & 1L) = 1L
               AND bit_count(shiftright(m, e.start + 1) & (shiftleft(1L, e.size - 1) - 1L)) = 1,
               m & ~shiftleft(shiftleft(1L, e.size - 1) - 1L, e.start + 1), m)))"""
    bit = lambda p: f"(shiftright(m[({p}) div {BITS}], cast(({p}) % {BITS} AS int)) & 1L)"
    large = f"""
        aggregate(edges, transform(sequence(0, n div {BITS}), k -> shiftleft(1L, {BITS}) - 1L), (m, e) ->
            IF({bit("e.start")} = 1L AND {bit("e.start + e.size")} = 1L
               AND aggregate(sequence(e.start + 1, e.start + e.size - 1), 0L, (c, p) -> c + {bit("p")}) = 1L,
               transform(m, (w, k) -> IF(k < (e.start + 1) div {BITS} OR k > (e.start + e.size - 1) div {BITS}, w,
                   aggregate(sequence(e.start + 1, e.start + e.size - 1), w, (v, p) ->
                       IF(p div {BITS} = k, v & ~shiftleft(1L, cast(p % {BITS} AS int)), v)))), m))"""
    return F.when(n < BITS, F.expr(small)).otherwise(F.expr(large))


def best_path(found: DataFrame, unknown: float) -> DataFrame:
    """Cuts of words by the best sum of scores (Viterbi): edges by their end, then back from the last character.

    A character that is no piece costs ``unknown``; of equal sums the first edge by start stays.
    """
    steps = f"""
        aggregate(
            array_sort(concat(transform(edges, e -> struct(e.start + e.size AS stop, e.start AS start, e.cost AS cost)),
                transform(filter(sequence(0, n - 1), i -> NOT exists(edges, e -> e.start = i AND e.size = 1)),
                    i -> struct(i + 1 AS stop, i AS start, {unknown}D AS cost)))),
            transform(sequence(0, n), p -> struct(IF(p = 0, 0D, double('inf')) AS cost, -1 AS start)),
            (s, e) -> IF(s[e.start].cost + e.cost < s[e.stop].cost,
                transform(s, (x, p) -> IF(p = e.stop, struct(s[e.start].cost + e.cost AS cost, e.start AS start), x)), s))"""
    back = f"""
        aggregate(sequence(n, 0, -1),
            struct(n AS at, transform(sequence(0, n div {BITS}), k -> 0L) AS m),
            (s, p) -> IF(p = s.at, struct(path[p].start AS at,
                transform(s.m, (w, k) -> IF(p div {BITS} = k, w | shiftleft(1L, cast(p % {BITS} AS int)), w)) AS m), s),
            s -> s.m)"""
    return found.withColumn("path", F.expr(steps)).select("word", "blocks", F.expr(back).alias("cuts"))


def cut(words: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(word, blocks, cuts): the places at which a word is cut into pieces, as bits. Words without an edge are left out."""
    found = lattice(words, vocabulary).withColumn("n", F.length("word"))
    if vocabulary.kind == "bpe":
        return found.select("word", "blocks", merged(F.col("n")).alias("cuts"))
    return best_path(found, max((-s for _, _, s in vocabulary.pieces), default=0.0) + 10)


def packed(values: np.ndarray) -> bytes:
    """Small whole numbers, compressed byte plane by byte plane."""
    return zstandard.compress(np.ascontiguousarray(values.astype(np.uint32).view(np.uint8).reshape(-1, 4).T).tobytes(), 3)


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view(np.uint32).reshape(-1)


def digest_of(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data) - (1 << 63)


def blocks_of(df: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Documents of a task in blocks: their ids, the different words of the block, and each text as word numbers.

    A block is named by the numbers of its task and of the block in it: 8 bytes that travel beside each rare word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, block = vocabulary.units(), TaskContext.get().partitionId() << BLOCK_BITS
        ids, ends, digests, codes, numbers, size = [], [], [], [], {}, 0

        def close() -> pa.RecordBatch:
            words = zstandard.compress("\x00".join(NUL_WORD if w == "\x00" else w for w in numbers).encode(), 3)
            row = [block, ids, ends, digests, words, packed(np.concatenate([*codes, np.zeros(0, np.uint32)]))]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], BLOCK)

        for batch in chunks(batches, "text"):
            for number, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                absent, text = text is None, text or ""
                codes.append(np.array([numbers.setdefault(u, len(numbers)) for u in unit.findall(normal(text))], np.uint32))
                ids.append(number)
                ends.append(len(codes[-1]) + (ends[-1] if ends else 0))
                digests.append(None if absent else digest_of(text.encode()))
                size += len(text)
                if size > BLOCK_BYTES:
                    yield close()
                    ids, ends, digests, codes, numbers, size = [], [], [], [], {}, 0
                    block += 1
        if ids:
            yield close()

    return df.mapInArrow(run, "block long, ids array<long>, ends array<long>, digests array<long>, words binary, codes binary")


BLOCK = ["block", "ids", "ends", "digests", "words", "codes"]


def words_of(data: bytes) -> list[str]:
    """The words of a block by number."""
    words = zstandard.decompress(data).decode().split("\x00")
    return ["\x00" if w == NUL_WORD else w for w in words] if NUL_WORD in words else words


def word_table(blocks: DataFrame) -> DataFrame:
    """(word, blocks): the different words of all texts with the number of blocks they are in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("words").to_pylist():
                words = words_of(data)
                for a in range(0, len(words), SENT):
                    yield pa.RecordBatch.from_arrays([pa.array(words[a : a + SENT], pa.string())], ["word"])

    return blocks.select("words").mapInArrow(run, "word string").groupBy("word").agg(F.count(F.lit(1)).alias("blocks"))


def frequent_words(found: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes in order, cuts) of the short words in most blocks, ``most`` at most.

    Words are counted by steps of block numbers, an eighth of a doubling wide. As many steps from the top as hold ``most``
    words are taken whole, so no words are sorted and only what is sent comes to the driver.
    """
    step = F.floor(F.log2("blocks") * 8).cast("int")
    short = found.where((F.col("blocks") > 1) & F.col("cut").isNotNull()).withColumn("step", step)
    taken, least = 0, None
    for r in sorted(short.groupBy("step").agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True):
        taken += r["n"]
        if taken > most:
            break
        least = r["step"]
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    top = short.where(F.col("step") >= least).select(F.xxhash64("word").alias("h"), "cut").toArrow()
    hashes, cuts = top["h"].to_numpy(), top["cut"].to_numpy()
    order = np.argsort(hashes, kind="stable")
    return hashes[order], cuts[order]


def looked_up(words: list[str], hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word stands among the frequent ones, and whether it does."""
    own = np.fromiter((xxhash.xxh64_intdigest(w.encode(), SEED) for w in words), np.uint64, len(words)).view(np.int64)
    at = np.minimum(np.searchsorted(hashes, own), max(len(hashes) - 1, 0))
    return at, hashes[at] == own if len(hashes) else np.zeros(len(words), bool)


def rare_words(blocks: DataFrame, sent: Broadcast) -> DataFrame:
    """(block, number, word) of the words that are not among the frequent ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("words").to_pylist(), strict=True):
                words = words_of(data)
                known = looked_up(words, sent.value[0])[1]
                rare = [i for i in np.flatnonzero(~known).tolist() if len(words[i]) > 1]
                for a in range(0, len(rare), SENT):
                    some = rare[a : a + SENT]
                    arrays = [pa.repeat(pa.scalar(block, pa.int64()), len(some)), pa.array(some, pa.int32()), pa.array([words[i] for i in some], pa.string())]
                    yield pa.RecordBatch.from_arrays(arrays, ["block", "number", "word"])

    return blocks.select("block", "words").mapInArrow(run, "block long, number int, word string")


class Speller:
    """Ids of a word from its cuts, and the bytes of ids."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.ids = {p: i for p, i, _ in vocabulary.pieces}
        self.unknown, self.bytes_from = vocabulary.unknown, vocabulary.bytes_from
        table = {i: p.replace(SPACE, " ").encode() for p, i, _ in vocabulary.pieces}
        if self.bytes_from is not None:
            table |= {self.bytes_from + b: bytes([b]) for b in range(256)}
        most = max([*table, self.unknown])
        spelled = [table.get(i, " ⁇ ".encode() if i == self.unknown else b"") for i in range(most + 1)]
        self.data = np.frombuffer(b"".join(spelled), np.uint8)
        self.ends = np.cumsum([len(x) for x in spelled])
        self.sizes = np.array([len(x) for x in spelled])

    def spell(self, word: str, cuts: int | list[int] | None) -> list[int]:
        """``cuts``: one mask of a short word, the masks of a long one, or None where every character stands alone."""
        if cuts is None:
            parts = word
        elif isinstance(cuts, int):
            parts, a, left = [], 0, cuts >> 1
            while left:
                step = (left & -left).bit_length()
                parts.append(word[a : a + step])
                a, left = a + step, left >> step
        else:
            at = [i for i in range(len(word) + 1) if cuts[i // BITS] >> i % BITS & 1]
            parts = [word[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        out = []
        for p in parts:
            if p in self.ids:
                out.append(self.ids[p])
            elif self.bytes_from is not None:
                out.extend(self.bytes_from + b for b in p.encode())
            else:
                out.append(self.unknown)
        return out

    def text(self, ids: np.ndarray) -> bytes:
        """The text of ids, without the space put before it."""
        return gather(self.data, self.ends[ids] - self.sizes[ids], self.sizes[ids]).tobytes()[1:]


def gather(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Stretches of ``data`` one after the other."""
    total = np.cumsum(sizes)
    return data[np.repeat(starts - total + sizes, sizes) + np.arange(total[-1])] if len(sizes) else data[:0]


def encode(
    df: DataFrame,
    vocabulary: Vocabulary,
    id_column: str = "doc_id",
    text: str = "text",
    frequent: int = FREQUENT,
) -> DataFrame:
    """(id_column, ids, n_tokens, round_trip) for every row: the ids of the whole text, and whether they decode to it.

    Texts are cut into words that no piece reaches across. The different words of the corpus, not the texts, go
    through the lattice. Texts travel as blocks of word numbers beside the words of the block; the words that most blocks
    hold, ``frequent`` at most, are sent to all tasks by their 64-bit hash (that bound is the size of what is sent), the
    others are joined.

    A null text has null ids, 0 tokens and a null round trip, an empty text no ids. Characters without a piece become byte
    pieces, or the unknown piece where a model has none. A text that holds the space sign of the pieces itself decodes
    to a space there, so its round trip is false. Repeated rows and rows that share an id keep their rows; only the
    id (an integer) and the text are read. One word is never cut over tasks.
    """
    spark = df.sparkSession
    own = df.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    blocks = bucketed(blocks_of(own, vocabulary), "block", "piece_blocks")
    # The cuts of a short word are one number; only a long word has a list of them.
    short = F.size("cuts") == 1
    found = cut(word_table(blocks), vocabulary)
    found = found.select("word", "blocks", F.when(short, F.col("cuts")[0]).alias("cut"), F.when(~short, F.col("cuts")).alias("cuts"))
    found = bucketed(found, "word", "piece_lexicon")
    sent = spark.sparkContext.broadcast(frequent_words(found, frequent))
    rare = rare_words(blocks, sent).join(found.select("word", "cut", "cuts"), "word")
    rare = rare.groupBy("block").agg(F.collect_list(F.struct("number", "cut", "cuts")).alias("rare"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller, (hashes, common) = Speller(vocabulary), sent.value
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in batch.schema.names}
                words = words_of(row["words"].as_py())
                at, known = looked_up(words, hashes)
                cuts, lists = np.zeros(len(words), np.int64), {}
                cuts[known] = common[at[known]]
                if row["rare"].is_valid:
                    numbers, masks, long = row["rare"].values.flatten()
                    numbers = numbers.to_numpy()
                    cuts[numbers] = masks.fill_null(0).to_numpy()
                    there = np.flatnonzero(long.is_valid())
                    lists = dict(zip(numbers[there].tolist(), long.take(pa.array(there)).to_pylist(), strict=True))
                yield from spelled_block(row, *spelled_words(words, cuts, lists, speller), speller)

    return blocks.join(rare, "block", "left").mapInArrow(run, "id long, ids array<int>, n_tokens int, round_trip boolean").withColumnRenamed("id", id_column)


def spelled_words(words: list[str], cuts: np.ndarray, lists: dict[int, list[int]], speller: Speller) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words one after the other, and how many each word has. ``cuts``: one mask a word, 0 for none.

    ``lists`` has the masks of long words. Words are spelled some at a time, so few ids stand as Python objects.
    """
    parts, sizes = [np.zeros(0, np.int32)], np.zeros(len(words), np.int32)
    for a in range(0, len(words), SPELLED):
        own = [speller.spell(w, lists.get(a + i, c or None)) for i, (w, c) in enumerate(zip(words[a : a + SPELLED], cuts[a : a + SPELLED].tolist(), strict=True))]
        sizes[a : a + len(own)] = [len(x) for x in own]
        parts.append(np.array([x for ids in own for x in ids], np.int32))
    return np.concatenate(parts), sizes


def spelled_block(row: dict, flat: np.ndarray, sizes: np.ndarray, speller: Speller) -> Iterator[pa.RecordBatch]:
    """The documents of one block with the ids of their texts, some at a time."""
    starts = np.cumsum(sizes, dtype=np.int64) - sizes
    codes = unpacked(row["codes"].as_py())
    ids, ends, digests = (row[n].as_py() for n in ("ids", "ends", "digests"))
    a = 0
    while a < len(ids):
        first = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, first + SENT_CODES)))
        code = codes[first : ends[b - 1]]
        counts = sizes[code]
        tokens = gather(flat, starts[code], counts)
        bounds = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])[np.array([first, *ends[a:b]]) - first]
        absent = np.array([d is None for d in digests[a:b]])
        same = [None if d is None else digest_of(speller.text(tokens[x:y])) == d for d, x, y in zip(digests[a:b], bounds[:-1], bounds[1:], strict=True)]
        lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32), mask=np.append(absent, False)), pa.array(tokens, pa.int32()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[a:b], pa.int64()), lists, pa.array(np.diff(bounds).astype(np.int32)), pa.array(same, pa.bool_())], RESULT
        )
        a = b


RESULT = ["id", "ids", "n_tokens", "round_trip"]


def bucketed(df: DataFrame, key: str, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, dealt by ``key``, so that what belongs to a key can join in place."""
    spark = df.sparkSession
    name = f"{name}_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(parts, key).option("path", fresh_path(spark, name)).saveAsTable(name)
    return spark.table(name)


def decode(df: DataFrame, vocabulary: Vocabulary, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All columns of ``df`` with the text of ``ids``: null for null, empty for none. Ids that are no piece add nothing."""
    kept = [f for f in df.schema.fields if f.name != text]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller = Speller(vocabulary)
        for batch in batches:
            out = []
            for x in batch.column(ids).to_pylist():
                known = None if x is None else np.array([i for i in x if i is not None and 0 <= i < len(speller.sizes)], np.int64)
                out.append(None if known is None else speller.text(known).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(out, pa.string())], [*names, text])

    return df.select(*[F.col(f"`{n}`") for n in names]).mapInArrow(run, T.StructType([*kept, T.StructField(text, T.StringType())]))
