"""Spelling variants: edits of each word probed against Bloom filters by length, then an exact join to the vocabulary."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix, written

#: The letters of a word: A-Z are lower-cased first, so that they are not among them.
LETTERS = r"a-z\x{C0}-\x{FF}"
ALPHABET = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], np.uint32)
#: Bits of the filters for each word, for all words at most, and of a block; tests for each word.
WORD_BITS, MOST_BITS, BLOCK_BITS, TESTS = 16, 1 << 28, 512, 4
#: Words handled at once inside a task, and edits or letters of them.
PROBED, AT_ONCE = 2048, 200_000
BASE = np.uint64(0x9E3779B97F4A7C15)
#: BASE * UNDO is 1 modulo 2 ** 64.
UNDO = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def corpus_words(df: DataFrame, id_column: str, text: str, least_size: int, damage: int | None) -> DataFrame:
    """(word, n): the words of at least ``least_size`` letters in all texts, with their number."""
    low = F.translate(F.col(f"`{text}`"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = F.regexp_extract_all(low, F.lit(f"[{LETTERS}]{{{least_size},}}"), F.lit(0))
    number = F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit(""))
    found = df.select(number.alias("id"), F.explode(runs).alias("run"))
    word = F.col("run")
    if damage:
        h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
        at = F.pmod(h, F.length("run")).cast("int")
        cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
        word = F.when(h % damage == 0, cut).otherwise(word)
    return found.select(word.alias("word")).where(F.length("word") >= least_size).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def by_size(words: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, row numbers, letters as one row of numbers a word), for the words of each size."""
    texts = words.to_pylist()
    sizes = np.array([len(w) for w in texts])
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        data = "".join([texts[i] for i in at]).encode("utf-32-le")
        yield size, at, np.frombuffer(data, np.uint32).reshape(len(at), size)


def powers(size: int) -> np.ndarray:
    return np.cumprod(np.append(np.uint64(1), np.full(size - 1, BASE)), dtype=np.uint64)


def spelled(letters: np.ndarray) -> np.ndarray:
    """The letters of words as values of a polynomial, so that an edit changes one or two terms."""
    return (letters.astype(np.uint64) * powers(letters.shape[1])).sum(axis=1, dtype=np.uint64)


class Shard:
    """The Bloom filter of the words of one size: a word sets a few bits of one block."""

    def __init__(self, start: int, blocks: int) -> None:
        self.start, self.blocks = start, blocks

    def bits(self, values: np.ndarray) -> list[np.ndarray]:
        """The bits of each value, counted over the filters of all sizes."""
        h = mix(values + np.uint64(1))
        block = (h >> np.uint64(32)) * np.uint64(self.blocks) >> np.uint64(32)
        first = np.uint64(self.start) + block * np.uint64(BLOCK_BITS)
        tests = mix(h)
        return [first + ((tests >> np.uint64(9 * k)) & np.uint64(BLOCK_BITS - 1)) for k in range(TESTS)]

    def holds(self, words: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Whether all bits of each value are set; the flat numbers of those that may be there."""
        left = np.arange(values.size)
        for bit in self.bits(values.reshape(-1)):
            bit = bit[left]
            left = left[(words[(bit >> np.uint64(6)).astype(np.intp)] >> (bit & np.uint64(63)) & np.uint64(1)) == 1]
        return left


def filters(vocabulary: DataFrame, most_bits: int = MOST_BITS) -> tuple[dict[int, Shard], np.ndarray]:
    """One filter for each word size, and the bits of all of them.

    The sizes of the filters follow the number of words; together they have ``most_bits`` or little more, which bounds what is
    sent. A fuller filter lets more edits through to the join and loses none.
    """
    counts = {r["size"]: r["n"] for r in vocabulary.groupBy(F.length("word").alias("size")).agg(F.count(F.lit(1)).alias("n")).collect()}
    each = min(WORD_BITS, most_bits / max(1, sum(counts.values())))
    shards, at = {}, 0
    for size in sorted(counts):
        blocks = max(1, int(-(-counts[size] * each // BLOCK_BITS)))
        shards[size] = Shard(at, blocks)
        at += blocks * BLOCK_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [b for size, _, letters in by_size(batch.column(0)) for b in shards[size].bits(spelled(letters))]
            bit = np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)
            word, first = np.unique(bit >> np.uint64(6), return_index=True)
            masks = np.bitwise_or.reduceat(np.uint64(1) << (bit & np.uint64(63)), first) if len(first) else bit
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(masks.view(np.int64))], ["at", "mask"])

    packed = vocabulary.select("word").mapInArrow(run, "at long, mask long").groupBy("at").agg(F.bit_or("mask").alias("mask")).toArrow()
    bits = np.zeros(at // 64, np.uint64)
    bits[packed["at"].to_numpy()] = packed["mask"].to_numpy().view(np.uint64)
    return shards, bits


def edits(letters: np.ndarray, shards: dict[int, Shard], bits: np.ndarray) -> Iterator[tuple[np.ndarray, list[str]]]:
    """(row, word): edits of words of one size that the filters let through.

    One letter replaced by a later one of the alphabet, or one taken out: each near pair is met from one of its sides.
    """
    rows, size = letters.shape
    power, value = powers(size), spelled(letters)
    shard, shorter = shards.get(size), shards.get(size - 1)
    alphabet = ALPHABET.astype(np.uint64)
    width = max(1, AT_ONCE // (rows * len(ALPHABET)))
    for i in range(0, size if shard else 0, width):
        here = letters[:, i : i + width]
        step = (alphabet - here[:, :, None].astype(np.uint64)) * power[i : i + width, None]
        row, place, letter = np.unravel_index(shard.holds(bits, value[:, None, None] + step), step.shape)
        later = ALPHABET[letter] > here[row, place]
        row, place, letter = row[later], place[later] + i, ALPHABET[letter[later]]
        for some in parts_of(len(row), size):
            changed = letters[row[some]].copy()
            changed[np.arange(len(changed)), place[some]] = letter[some]
            yield row[some], texts_of(changed)
    terms = letters.astype(np.uint64) * power
    before = np.cumsum(terms, axis=1, dtype=np.uint64)
    width = max(1, AT_ONCE // rows)
    for i in range(0, size if shorter else 0, width):
        here = slice(i, i + width)
        left = before[:, here] - terms[:, here] + (value[:, None] - before[:, here]) * UNDO
        row, place = np.unravel_index(shorter.holds(bits, left), left.shape)
        place = place + i
        # Of equal neighbours the first one is taken out.
        first = (place == 0) | (letters[row, place] != letters[row, place - 1])
        row, place = row[first], place[first]
        for some in parts_of(len(row), size):
            cut = np.ones((len(row[some]), size), bool)
            cut[np.arange(len(cut)), place[some]] = False
            yield row[some], texts_of(letters[row[some]][cut].reshape(len(cut), size - 1))


def parts_of(n: int, size: int) -> Iterator[slice]:
    """Rows cut so that a part has about ``AT_ONCE`` letters."""
    step = max(1, AT_ONCE // size)
    return (slice(i, i + step) for i in range(0, n, step))


def texts_of(letters: np.ndarray) -> list[str]:
    size = letters.shape[1]
    whole = np.ascontiguousarray(letters, "<u4").tobytes().decode("utf-32-le")
    return [whole[i : i + size] for i in range(0, len(whole), size)]


def near_words(vocabulary: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """(a, b, n_a, n_b): all pairs of different words of (word, n) that one inserted, deleted or replaced letter parts.

    Each pair comes once. ``word`` holds letters of the alphabet alone and is unique. Edits that the filters let
    through are shuffled by word and joined, which removes those that are no word.
    """
    shards, bits = filters(vocabulary, most_bits)
    sent: Broadcast = vocabulary.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PROBED):
                part = batch.slice(at, PROBED)
                for _, rows, letters in by_size(part.column("word")):
                    for row, found in edits(letters, shards, sent.value):
                        own = part.take(pa.array(rows[row]))
                        yield pa.RecordBatch.from_arrays([own.column("word"), own.column("n"), pa.array(found, pa.string())], ["a", "n_a", "b"])

    dealt = vocabulary.select("word", "n").repartition("word")
    probed = dealt.mapInArrow(run, "a string, n_a long, b string")
    return probed.join(vocabulary.select(F.col("word").alias("b"), F.col("n").alias("n_b")), "b").select("a", "b", "n_a", "n_b")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): from each (word, form) along the forms to the last, in steps that double.

    A form occurs several times as often as its word, so the way never turns back and is as long as a logarithm.
    """
    way = written(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        on = way.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = way.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        longer = written(longer, "forms")
        way = longer.drop("moved")
        if longer.where("moved").isEmpty():
            return way


def group_variants(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    least_size: int = 6,
    least_count: int = 5,
    times: int = 5,
    damage: int | None = None,
    most_bits: int = MOST_BITS,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words with at least ``least_size`` letters and ``least_count`` places.

    A word is a whole run of letters (A-Z, which are lower-cased, a-z and U+00C0 to U+00FF) anywhere in a text. Words
    are near if one inserted, deleted or replaced letter parts them. The form of a word is the near word that occurs most, the
    smallest in code-point order of equal ones, if it occurs at least ``times`` as often; the root is the last form of forms. With
    ``damage`` a run loses the letter crc32(id:run) mod its length where ``damage`` divides that number: misspellings to find.

    Null and empty texts have no words, a null id counts as an empty one in the crc32, repeated rows count again. Words without
    a near word have 0 of them, no form, and are their own root. An empty table, or one without such words, gives an empty
    result. Other columns are not read. Words are counted where they are read before they are shuffled, so a frequent
    word is no hot key; a word has a few hundred edits, whatever the number of words.
    """
    if times < 2:
        raise ValueError("a form must occur at least twice as often as its word")
    counted = corpus_words(df, id_column, text, least_size, damage).where(F.col("n") >= least_count)
    vocabulary = written(counted, "vocabulary")
    pairs = near_words(vocabulary, most_bits)

    def side(word: str, n: str, other: str, other_n: str) -> Column:
        return F.struct(F.col(word).alias("word"), F.col(other).alias("near"), F.col(other_n).alias("near_n"))

    both = pairs.select(F.explode(F.array(side("a", "n_a", "b", "n_b"), side("b", "n_b", "a", "n_a"))).alias("p")).select("p.*")
    near = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    often = -F.col("best.less") >= times * F.col("n")
    judged = vocabulary.join(near, "word", "left").select(
        "word",
        F.when(often, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(often, -F.col("best.less")).alias("form_n"),
    )
    judged = written(judged, "variants")
    last = roots(judged.where("form is not null"))
    return judged.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
