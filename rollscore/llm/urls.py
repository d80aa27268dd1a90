"""URL rules by a range join: keys on which a rule is one interval, and a sorted sweep with a stack of open rules."""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ends a host label in a key; sorts before every character of a host or path.
LABEL = "\x01"
#: Sorts after every character.
LAST = "\U0010ffff"


def host_of(url: Column) -> Column:
    """Lower case (A-Z only): from the first ``://`` up to ``/``, ``?``, ``#`` or the end; empty where there is none."""
    raw = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty where there is no host part."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: Column) -> Column:
    """Labels from the last to the first, each ended by ``LABEL``: a domain is a prefix of all its subdomains.

    An empty host is empty, so a rule without a host covers every host. ``LABEL`` inside a host is written otherwise.
    """
    plain = F.replace(F.replace(host, F.lit("\x02"), F.lit("\x02b")), F.lit(LABEL), F.lit("\x02a"))
    return F.when(host == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(plain, r"\.")), LABEL), F.lit(LABEL)))


def key_of(host: Column, path: Column, width: Column) -> Column:
    """The sort key of a rule; a url probed for rules with paths of ``width`` characters has its path as tail besides.

    Path length and path come first, then the reversed host, so that one rule covers one interval: the keys which
    its own key begins. The tail keeps the urls of one host apart, so a host with very many urls can be cut.
    """
    return F.concat(F.lpad(width.cast("string"), 9, "0"), F.substring(path, F.lit(1), width), F.lit("/"), reversed_host(host))


def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key, rules before urls of the same key. Keeps the stack of rules whose interval is open.

    The intervals are nested or apart, so the top of the stack is the longest rule that covers a url.
    """
    stack: list[tuple[str, str, str]] = []
    for batch in batches:
        out: list[tuple] = []
        for key, host, path, rule, verdict in zip(*(batch.column(c).to_pylist() for c in SWEPT), strict=True):
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if rule is not None:
                stack.append((key, rule, verdict))
            elif stack:
                out.append((host, path, *stack[-1][1:]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*out, strict=True)], list(SWEPT[1:]))


SWEPT = ("key", "host", "path", "rule", "verdict")


def cut_points(keyed: DataFrame, parts: int, each: int = 50) -> list[str]:
    """Up to ``parts`` - 1 keys that cut the rows into about equal ranges, drawn from ``each`` x ``parts`` keys at most."""
    drawn = keyed.select("key", F.xxhash64("key").alias("h")).orderBy("h").limit(each * parts)
    keys = sorted(r.key for r in drawn.collect())
    return sorted({keys[len(keys) * i // parts] for i in range(1, parts)}) if keys else []


def match_rules(df: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """All columns of ``df`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules``: host, path, verdict (allow or block). A rule fits its host and all subdomains where the url's path
    starts with the rule's; the longest text of host and path wins, and of equal rules the one that blocks. Without a
    fitting rule, ``rule`` is null and ``verdict`` the ``default``.

    Each different address is probed once for every path length among the rules, so a url that repeats very often is
    one row. Probes and rules are dealt to key ranges, a rule to every range that its interval meets, and each range
    is swept in order. To the driver come the different path lengths and the cut points, never urls or rules.

    Null urls and urls without ``://`` have an empty host and path, fit no rule that names a host, and keep their row.
    Rules with a null part are ignored. Repeated rows all stay. Columns of ``df`` named like a result are replaced;
    the order of rules and rows does not matter; either table may be empty.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = df.drop("host", "path", "rule", "verdict").withColumn("host", host_of(df[url])).withColumn("path", path_of(df[url]))
    rules = (
        rules.select("host", "path", "verdict")
        .dropna()
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("rule", F.concat("host", "path"))
    )
    widths = [r[0] for r in rules.select(F.length("path")).distinct().collect()]
    own = rules.withColumn("key", key_of(F.col("host"), F.col("path"), F.length("path")))
    if not widths:
        return named.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    probe = F.filter(F.array(*[F.lit(w) for w in sorted(widths)]), lambda w: w <= F.length("path"))
    probes = (
        named.groupBy("host", "path")
        .agg(F.lit(0).alias("one"))
        .withColumn("width", F.explode(probe))
        .select(F.concat(key_of(F.col("host"), F.col("path"), F.col("width")), "path").alias("key"), "host", "path")
    )
    cuts = cut_points(probes, parts)

    @F.pandas_udf("int")
    def part_of(keys: pd.Series) -> pd.Series:
        return keys.map(lambda k: bisect.bisect_right(cuts, k)).astype("int32")

    dealt = probes.select(
        part_of("key").alias("part"), "key", "host", "path", *[F.lit(None).cast("string").alias(c) for c in ("rule", "verdict")]
    ).union(
        own.withColumn("part", F.explode(F.sequence(part_of("key"), part_of(F.concat("key", F.lit(LAST)))))).select(
            "part", *SWEPT
        )
    )
    found = (
        dealt.repartition(parts, "part")
        .sortWithinPartitions("part", "key", F.col("rule").isNull())
        .mapInArrow(sweep, "host string, path string, rule string, verdict string")
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict")).alias("best"))
        .select("host", "path", "best.rule", "best.verdict")
    )
    return named.join(found, ["host", "path"], "left").select(
        *[c for c in named.columns], "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
