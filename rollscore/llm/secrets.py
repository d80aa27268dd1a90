"""Secret scan: base patterns, and a battery of randomness tests on encoded-looking runs. SQL functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "random")

#: The same matches, found faster: a match can only start at one of four letters; runs that are too short are passed
#: over, and a run is tried at its first symbol alone.
FAST_ASSIGN = r"(?=[pstaPSTA])" + ASSIGN
LONG_ACCESS = r"AKIA[A-Z0-9]{12,}+"
LONG_HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"

#: A run that may be an encoded secret: 20 or more symbols of an encoding with a digit among them, and its padding.
RUN = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{20,}+={0,2}"

#: Encodings in the order they are tried: name, pattern of the whole run, alphabet in symbol order.
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = (
    ("hex", r"\A(?=.*[0-9])(?=.*[a-f])[0-9a-f]+\z", DIGITS + "abcdef"),
    ("hex_upper", r"\A(?=.*[0-9])(?=.*[A-F])[0-9A-F]+\z", DIGITS + "ABCDEF"),
    ("base32", r"\A(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+=*\z", UPPER + "234567"),
    ("base36", r"\A(?=.*[0-9])(?=.*[a-z])[a-z0-9]+\z", DIGITS + LOWER),
    ("base62", r"\A(?=.*[a-z])(?=.*[A-Z])(?=.*[0-9])[A-Za-z0-9]+\z", DIGITS + UPPER + LOWER),
    ("base64", r"\A(?=.*[a-z])(?=.*[A-Z])(?=.*[0-9])[A-Za-z0-9+/]+=*\z", UPPER + LOWER + DIGITS + "+/"),
    ("base64url", r"\A(?=.*[a-z])(?=.*[A-Z])(?=.*[0-9])[A-Za-z0-9_-]+=*\z", UPPER + LOWER + DIGITS + "-_"),
)
BINS = 64


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Every match of ``pattern`` from the left, as structs of start, end (code points) and the ``group`` as value.

    The pieces between the matches give the offsets; texts without a match are only searched once.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    each = F.arrays_zip(found.alias("m"), value.alias("value"), F.split(text, pattern, -1).alias("gap"))
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    step = F.aggregate(
        F.filter(each, lambda x: x["m"].isNotNull()),
        F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda s, x: F.struct(
            (s["at"] + F.length(x["gap"]) + F.length(x["m"])).alias("at"),
            F.concat(
                s["out"],
                F.array(
                    F.struct(
                        (s["at"] + F.length(x["gap"])).alias("start"),
                        (s["at"] + F.length(x["gap"]) + F.length(x["m"])).alias("end"),
                        x["value"].alias("value"),
                    )
                ),
            ).alias("out"),
        ),
        lambda s: s["out"],
    )
    return F.when(text.rlike(pattern), step).otherwise(empty)


def upper_tail(z: Column) -> Column:
    """The chance that a standard normal value exceeds ``z`` (logistic approximation, error below 0.0002)."""
    return 1 / (1 + F.exp(1.5976 * z + 0.07056 * z * z * z))


def inferred(run: Column) -> Column:
    """Encoding, its alphabet, and the run without padding; nulls where no encoding fits."""
    body = F.regexp_replace(run, "=+$", "")
    encoding, alphabet = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, pattern, letters in reversed(ENCODINGS):
        encoding = F.when(run.rlike(pattern), F.lit(name)).otherwise(encoding)
        alphabet = F.when(run.rlike(pattern), F.lit(letters)).otherwise(alphabet)
    return F.struct(encoding.alias("encoding"), alphabet.alias("alphabet"), body.alias("body"))


def total(values: Column, f=lambda x: x) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + F.coalesce(f(x).cast("double"), F.lit(0.0)))


def evidence(found: Column) -> Column:
    """For each candidate, the combined chance that a truly random run looks as uneven as it does.

    Three tests: chi-squared evenness over the encoding's alphabet, runs above and below the middle symbol, and the
    correlation of neighbouring symbol values. Their chances are combined by Fisher's sum of logarithms. The passes
    see to it that each sum is taken once.
    """
    tail = 1_000_000_000
    first = F.transform(
        found,
        lambda c: F.struct(
            *[c[x].alias(x) for x in ("start", "end", "encoding", "v")],
            F.size(c["v"]).cast("double").alias("n"),
            F.length(c["alphabet"]).cast("double").alias("k"),
            F.transform(c["v"], lambda x: (x * 2 >= F.length(c["alphabet"])).cast("int")).alias("high"),
            (total(c["v"]) / F.size(c["v"])).alias("middle"),
        ),
    )
    second = F.transform(
        first,
        lambda c: F.struct(
            *[c[x].alias(x) for x in ("start", "end", "encoding", "n", "k")],
            total(
                F.array_distinct(c["v"]), lambda x: F.pow(F.size(F.filter(c["v"], lambda y: y == x)).cast("double"), 2.0)
            ).alias("same"),
            total(c["high"]).alias("n1"),
            (1 + total(F.zip_with(F.slice(c["high"], 2, tail), c["high"], lambda x, y: (x != y).cast("int")))).alias("turns"),
            total(c["v"], lambda x: (x - c["middle"]) * (x - c["middle"])).alias("power"),
            total(
                F.zip_with(F.slice(c["v"], 2, tail), c["v"], lambda x, y: (x - c["middle"]) * (y - c["middle"]))
            ).alias("lag"),
        ),
    )
    third = F.transform(
        second,
        lambda c: F.struct(
            *[c[x].alias(x) for x in ("start", "end", "encoding", "n", "turns")],
            ((c["k"] / c["n"] * c["same"] - c["n"] - c["k"] + 1) / F.sqrt(2 * (c["k"] - 1) * (1 - 1 / c["n"]))).alias("chi"),
            (2 * c["n1"] * (c["n"] - c["n1"]) / c["n"] + 1).alias("mean"),
            ((F.when(c["power"] > 0, c["lag"] / c["power"]).otherwise(1.0) + 1 / c["n"]) * F.sqrt(c["n"])).alias("serial"),
        ),
    )
    chances = F.transform(
        third,
        lambda c: F.struct(
            *[c[x].alias(x) for x in ("start", "end", "encoding", "n")],
            F.array(
                upper_tail(c["chi"]),
                2
                * upper_tail(
                    F.abs(c["turns"] - c["mean"])
                    / F.sqrt(F.greatest((c["mean"] - 1) * (c["mean"] - 2) / (c["n"] - 1), F.lit(1e-9)))
                ),
                2 * upper_tail(F.abs(c["serial"])),
            ).alias("p"),
        ),
    )
    halves = F.transform(
        chances,
        lambda c: F.struct(
            *[c[x].alias(x) for x in ("start", "end", "encoding", "n")],
            total(c["p"], lambda x: -F.ln(F.greatest(F.least(x, F.lit(1.0)), F.lit(1e-30)))).alias("h"),
        ),
    )
    return F.transform(
        halves,
        lambda c: F.struct(
            *[c[x].alias(x) for x in ("start", "end", "encoding")],
            F.floor(F.log2(c["n"])).cast("int").alias("size_class"),
            F.least(F.exp(-c["h"]) * (1 + c["h"] + c["h"] * c["h"] / 2), F.lit(1.0)).alias("p"),
        ),
    )


def candidates(text: Column) -> Column:
    """The encoded-looking runs of a text with their test results."""
    runs = F.transform(
        matches(text, RUN),
        lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), inferred(x["value"]).alias("b")),
    )
    coded = F.transform(
        F.filter(runs, lambda x: x["b"]["encoding"].isNotNull()),
        lambda x: F.struct(
            x["start"].alias("start"),
            x["end"].alias("end"),
            x["b"]["encoding"].alias("encoding"),
            x["b"]["alphabet"].alias("alphabet"),
            F.transform(F.split(x["b"]["body"], ""), lambda c: (F.instr(x["b"]["alphabet"], c) - 1).cast("double")).alias("v"),
        ),
    )
    return evidence(coded)


def thresholds(found: DataFrame, fdr: float) -> dict[tuple[str, int], float]:
    """For each encoding and size class (power of two), the least combined chance that still counts as a finding.

    Truly random runs have chances spread evenly over 0 to 1, so twice their number above one half estimates them
    all; what exceeds their even share above a threshold is false. The least threshold whose false share is at most
    ``fdr`` is taken, class by class, because short runs pass by luck far more often than long ones. Chances are
    counted in ``BINS`` bins over all rows; the counts are at most encodings x size classes x bins and only these
    reach the driver. A class without an admissible threshold gives no findings.
    """
    rows = (
        found.select(F.explode("candidates").alias("c"))
        .groupBy("c.encoding", "c.size_class", F.least(F.floor(F.col("c.p") * BINS), F.lit(BINS - 1)).alias("bin"))
        .count()
        .collect()
    )
    counts: dict[tuple[str, int], list[int]] = {}
    for r in rows:
        counts.setdefault((r["encoding"], r["size_class"]), [0] * BINS)[int(r["bin"])] += r["count"]
    out = {}
    for stratum, c in counts.items():
        even = 2 * sum(c[BINS // 2 :]) / BINS
        for b in range(BINS):
            found_here = sum(c[b:])
            if found_here and max(0.0, found_here - even * (BINS - b)) <= fdr * found_here:
                out[stratum] = b / BINS
                break
    return out


def scan_secrets(df: DataFrame, text: str = "text", fdr: float = 0.05, prefix: str = "") -> DataFrame:
    """All columns of ``df`` and ``{prefix}findings``: an array of structs (kind, start, end), in order of start, kind.

    Kinds: ``assign`` (a name such as password, then a value of 8 or more), ``access`` (AKIA and 12 or more),
    ``hex`` (32 or more), ``random`` (a run of 20 or more symbols of an encoding that passes the randomness battery
    within the false-discovery rate of its encoding and size class). Offsets count code points; the end is
    exclusive. Null and empty texts have no findings. Repeated rows each get their own findings; no shuffle of
    texts takes place, one small count over all rows comes first. A column named like the result is replaced.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    limits = thresholds(df.select(candidates(body).alias("candidates")), fdr)
    table = F.create_map(*[F.lit(x) for (e, s), t in sorted(limits.items()) for x in (f"{e}/{s}", t)]) if limits else None

    def kind(i: int, spans: Column) -> Column:
        return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.lit(i).alias("kind"), x["end"].alias("end")))

    spans = [
        kind(0, F.filter(matches(body, FAST_ASSIGN, 2), lambda x: F.length(x["value"]) >= 8)),
        kind(1, matches(body, LONG_ACCESS)),
        kind(2, matches(body, LONG_HEX)),
    ]
    if table is not None:
        spans.append(
            kind(
                3,
                F.filter(
                    candidates(body),
                    lambda x: x["p"] >= F.coalesce(F.element_at(table, F.concat_ws("/", x["encoding"], x["size_class"])), F.lit(math.inf)),
                ),
            )
        )
    names = F.array(*map(F.lit, KINDS))
    return df.withColumn(
        f"{prefix}findings",
        F.transform(
            F.array_sort(F.concat(*spans)),
            lambda x: F.struct(F.get(names, x["kind"]).alias("kind"), x["start"].alias("start"), x["end"].alias("end")),
        ),
    )
