"""The mix against a plain version that gives out one block after the other."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
from collections import defaultdict
from fractions import Fraction

import pytest

from rollscore.llm.mixing import mix_sources

WEIGHTS = (5, 2, 1)


def targets(sizes, percent=150, epochs=2):
    """Shares by weight; what is above a cap is shared again until none is."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(order)}
    out, left, open_ = {}, Fraction(sum(sizes.values()) * percent, 100), set(sizes)
    while open_:
        total = sum(weight[s] for s in open_)
        above = [s for s in open_ if left * weight[s] / total >= epochs * sizes[s]]
        if not above:
            out |= {s: left * weight[s] / total for s in open_}
            break
        for s in above:
            out[s] = Fraction(epochs * sizes[s])
        left -= sum(out[s] for s in above)
        open_ -= set(above)
    return order, out


def seats_of(votes, seats):
    """One seat after the other to the highest quotient, ties to the first."""
    won = [0] * len(votes)
    heap = [(-float(v), i) for i, v in enumerate(votes) if v > 0]
    heapq.heapify(heap)
    for _ in range(seats if heap else 0):
        _, i = heapq.heappop(heap)
        won[i] += 1
        heapq.heappush(heap, (-float(votes[i]) / (2 * won[i] + 1), i))
    return won


def seeded(*parts):
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:15], 16)


def plain_version(rows, shard_rows, seed=1):
    sized = [(i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, s, t in rows]
    sizes, count = defaultdict(int), defaultdict(int)
    for _, s, n in sized:
        sizes[s] += n
        count[s] += 1
    order, target = targets(sizes)
    block = max(1, min(1024, int(min((t for t in target.values() if t), default=0) / 256)))
    total = min(Fraction(sum(sizes.values()) * 150, 100), sum(2 * n for n in sizes.values()))
    quota = dict(zip(order, seats_of([target[s] for s in order], int(total / block + Fraction(1, 2))), strict=True))
    out = []
    for number, s in enumerate(order, 1):
        shards = defaultdict(list)
        copies = defaultdict(int)
        for i, own, n in sized:
            if own == s:
                copies[i, n] += 1
        for (i, n), c in copies.items():
            for part in range(0, (c - 1) // 4096 + 1):
                place = seeded(seed, "" if i is None else i, part)
                here = min(4096, c - 4096 * part)
                shards[place % -(-count[s] // shard_rows)] += [(place, i is not None, i, part, n)] * here
        names = sorted(shards)
        words = [sum(d[-1] for d in shards[k]) for k in names]
        blocks = [0 if not w else max(1, (2 * w + block) // (2 * block)) for w in words]
        won = seats_of(blocks, min(quota[s], 2 * sum(blocks)))
        for k, w, m, q in zip(names, words, blocks, won, strict=True):
            first = seeded(seed, "run", number, k) % max(1, m)
            taken = [q // m if m else 0] * w
            for j in range(q % m if m else 0):
                b = (first + j) % m
                for at in range(b * w // m, (b + 1) * w // m):
                    taken[at] += 1
            at = 0
            for _, _, i, _, n in sorted(shards[k], key=lambda d: (d[0], d[1], d[2] or 0, d[3], d[4])):
                out.append((i, s, n, sizes[s], sum(taken[at : at + n])))
                at += n
    return out, target


def rows_for(seed, copies=0):
    rng = random.Random(seed)
    rows = []
    for i in range(600):
        source = rng.choice(["b", "b", "b", "b", "a", "é", "B", None, "z"])
        rows.append((i, source, " ".join(["w"] * int(rng.expovariate(0.05)))))
    rows += [(1000 + k, s, t) for k, (s, t) in enumerate([("empty", None), ("empty", ""), ("one", " x\x0b "), ("b", "w " * 8000)])]
    return rows + [(None, "a", "null id"), (None, "a", "null id"), (5, "a", "same id")] + rows[:30] + [(7, "hot", "a b c")] * copies


@pytest.mark.parametrize(("seed", "copies", "shard_rows"), [(1, 0, 100_000), (2, 0, 40), (3, 9000, 500)])
def test_equals_plain_version(spark, seed, copies, shard_rows):
    rows = rows_for(seed, copies)
    wide = [(*r, 1, "x", "y") for r in rows]
    df = spark.createDataFrame(wide, "doc_id long, source string, text string, size int, taken string, shard string").repartition(7)
    got = mix_sources(df, shard_rows=shard_rows).collect()
    want, target = plain_version(rows, shard_rows)
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(((r.doc_id, r.source, r.size, r.source_size, r.taken) for r in got), key=key) == sorted(want, key=key)
    for r in got:
        assert r.target == pytest.approx(float(target[r.source]))
        assert r.taken == r.passes * r.size + sum(p.end - p.start for p in r.parts) <= 2 * r.size
        assert all(0 <= p.start < p.end <= r.size for p in r.parts)


def test_near_target_and_reruns_agree(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    a = mix_sources(docs, shard_rows=20).drop("parts").collect()
    b = mix_sources(docs.repartition(13), shard_rows=20).drop("parts").collect()
    assert sorted(map(str, a)) == sorted(map(str, b))
    taken, target = defaultdict(int), {}
    for r in a:
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - t) <= 0.01 * t + 1 for s, t in target.items())


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "a", "x"), (2, "b", None)]])
def test_small_tables(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mix_sources(df).collect()
    assert len(got) == len(rows) and all(r.taken <= 2 * r.size for r in got)
