"""Answers that are equal as mathematics: a key that equal answers share, as a Spark expression.

An answer's symbols are folded into postfix and evaluated modulo a large prime at two fixed points (randomised identity
testing): equal expressions always agree, different ones with a chance of about their degree in two thousand million for each
point. Sets, tuples, intervals, unions and matrices are taken apart first and compared part by part.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from functools import cache
from importlib.resources import files

from pyspark import SparkContext
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.classic.column import Column as ClassicColumn
from pyspark.sql.classic.column import _to_seq

from .text import as_col

#: A prime P for which Q = (P - 1) / 2 is prime too and the first 19 primes are squares modulo P. So squares have a root that is a
#: square again, roots of products are products of roots, and exponents of squares are numbers modulo the prime Q.
P = 1931011319
Q = (P - 1) // 2
#: Answers longer than this are compared as text: folds copy what they have gathered.
MOST_CHARS = 1000
#: Exact integers are kept below this.
SMALL = 1 << 31
ROOTS = range(2, 10)
LEAST_SQUARE = 71
# Symbols that stand for themselves (fixed values).
GREEK = "alpha beta gamma delta epsilon theta lambda mu pi rho sigma tau phi omega infty".split()
SYMBOL = r"\\(?:" + "|".join(GREEK) + ")"
TOKEN = rf"\d+(?:\.\d+)?|\.\d+|\\frac|\\sqrt|\\root[2-9]|{SYMBOL}|[a-zA-Z]|[-+*/^()\[\]{{}}]"
VALUE = "struct<m:bigint,e:bigint,k:bigint,r:double>"
# Marks between parts: items of a list, parts of a tuple, members of a union.
ITEM, PART, MEMBER = "\x01", "\x02", "\x03"
#: One spelling for each operation: pattern, replacement, and what texts hold if the pattern is found in them.
SPELLINGS = [
    (r"\\cdot|\\times|[\x{d7}\x{b7}]", "*", "\\cdot \\times \xd7 \xb7"),
    (r"\\div|\x{f7}", "/", "\\div \xf7"),
    (r"\x{2212}", "-", "\u2212"),
    (r"\x{221e}", r"\\infty", "\u221e"),
    (r"\x{3c0}", r"\\pi", "\u03c0"),
    (r"\x{222a}", r"\\cup", "\u222a"),
    (r"\^\{?\\circ\}?|\x{b0}", "", "\\circ \xb0"),
    (r"\\frac(\d)(?=[\d{])", r"\\frac{$1}", "\\frac"),
    (r"(\\frac\{[^{}]*\})(\d)", "$1{$2}", "\\frac"),
    (r"\\sqrt\[([2-9])\]", r"\\root$1", "\\sqrt["),
    (r"(\\sqrt|\\root[2-9])([0-9a-zA-Z])", "$1{$2}", "\\sqrt \\root"),
    # A whole number in front of a fraction of numbers is a mixed number.
    (r"(?<![\d.a-zA-Z)}\]^/*])(\d+)\\frac\{(\d+)\}\{(\d+)\}", r"($1+\\frac{$2}{$3})", "\\frac"),
    # A divisor or power in percent stays text.
    (r"(?<![/^\d.])(\d+(?:\.\d+)?|\.\d+)\\?%", "($1/100)", "%"),
    (r"\A[a-zA-Z](?:=(?!.*=)|\\in(?!f))", "", "= \\in"),
]

def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def prepared(norm: Column) -> Column:
    """Normalised answer text with one spelling for each operation, and without an assigned name."""
    for pattern, replacement, _ in SPELLINGS:
        norm = F.regexp_replace(norm, pattern, replacement)
    return norm


def is_expression(c: Column) -> Column:
    """Whether the text is made of known symbols. Letters alone, and runs of three of them, are words."""
    words = r"\A[a-zA-Z]{2,}\z|(?:(?<![\\a-zA-Z])|(?<=\\pi))[a-zA-Z]{3,}"
    # Taking symbols out, unlike matching a repeated group, needs no stack for long texts.
    return (F.length(c) <= MOST_CHARS) & (c != "") & (F.regexp_replace(c, TOKEN, "") == "") & ~c.rlike(words)


def coded(c: Column) -> Column:
    """Symbols in order, with the products that are not written, coded by rank: d number, x name, 0 opening, 1 sum, 2 product,
    3 sign, 4 power, 9 closing."""

    def kind(t: Column) -> Column:
        """d number, x name, f fraction or root; every other symbol is its own kind."""
        first = F.substring(t, 1, 1)
        return (
            F.when(t.isin("\\frac", "\\sqrt") | t.startswith("\\root"), F.lit("f"))
            .when(first.between("0", "9") | (first == "."), F.lit("d"))
            .when(first.between("a", "z") | first.between("A", "Z") | (first == "\\"), F.lit("x"))
            .otherwise(t)
        )

    def code(found: Column) -> Column:
        texts, kinds = found["texts"], found["kinds"]

        def one(own_kind: Column, i: Column) -> Column:
            t = F.get(texts, i)

            def placed(z: Column) -> Column:
                k, after_value = z["kind"], z["after"]
                own = (
                    F.when(k.isin("d", "x"), F.concat(k, t))
                    .when(k == "f", F.when(t == "\\frac", F.lit("0F")).when(t == "\\sqrt", F.lit("0R2")).otherwise(F.concat(F.lit("0R"), F.substring(t, 6, 1))))
                    .when(k.isin("(", "["), F.lit("0("))
                    .when(k == "{", F.lit("0{"))
                    .when(k.isin(")", "]"), F.lit("9("))
                    .when(k == "}", F.lit("9{"))
                    .when(k.isin("*", "/"), F.concat(F.lit("2"), k))
                    .when(k == "^", F.lit("4^"))
                    .when(after_value, F.concat(F.lit("1"), k))
                    .when(k == "-", F.lit("3-"))
                )
                nothing = (k == "+") & ~after_value
                return (
                    F.when(after_value & k.isin("d", "x", "f", "(", "["), F.array(F.lit("2*"), own))
                    .when(nothing, F.array().cast("array<string>"))
                    .otherwise(F.array(own))
                )

            after = F.coalesce(F.get(kinds, i - 1).isin("d", "x", ")", "]", "}"), F.lit(False))
            return let(F.struct(own_kind.alias("kind"), after.alias("after")), placed)

        return F.flatten(F.transform(kinds, one))

    def with_kinds(found: Column) -> Column:
        return F.struct(found.alias("texts"), F.transform(found, kind).alias("kinds"))

    return let(let(F.regexp_extract_all(c, F.lit(TOKEN), F.lit(0)), with_kinds), code)


def postfix(codes: Column) -> Column:
    """Codes in the order of evaluation; what stays open stays in it and has no value."""
    texts = "array<string>"
    start = F.struct(F.array().cast(texts).alias("out"), F.array().cast(texts).alias("open"))

    def last_kept(stack: Column, kept: Callable[[Column], Column]) -> Column:
        return F.coalesce(F.array_max(F.transform(stack, lambda x, i: F.when(kept(x), i + 1))), F.lit(0))

    def cut(stack: Column, n: Column) -> tuple[Column, Column]:
        return F.slice(stack, F.lit(1), n), F.reverse(F.slice(stack, n + 1, F.size(stack)))

    def step(s: Column, t: Column) -> Column:
        out, stack, rank = s["out"], s["open"], F.substring(t, 1, 1)

        def both(a: Column, b: Column) -> Column:
            return F.struct(a.alias("out"), b.alias("open"))

        def operator(n: Column) -> Column:
            left, popped = cut(stack, n)
            return both(F.concat(out, popped), F.concat(left, F.array(t)))

        def closed(n: Column) -> Column:
            left, popped = cut(stack, n)
            fits = F.coalesce(F.get(left, n - 1) == F.concat(F.lit("0"), F.substring(t, 2, 1)), F.lit(False))
            below = F.slice(left, F.lit(1), F.greatest(n - 1, F.lit(0)))
            under = F.slice(left, F.lit(1), F.greatest(n - 2, F.lit(0)))
            over = F.coalesce(F.get(left, n - 2), F.lit(""))
            done = F.concat(out, popped)
            return (
                F.when(~fits, both(F.concat(done, F.array(F.lit("0?"))), left))
                .when(over == "0F", both(done, F.concat(under, F.array(F.lit("0f")))))
                .when(over == "0f", both(F.concat(done, F.array(F.lit("2/"))), under))
                .when(over.startswith("0R"), both(F.concat(done, F.array(over)), under))
                .otherwise(both(done, below))
            )

        stays = last_kept(stack, lambda x: F.when(t == "4^", F.substring(x, 1, 1) <= rank).otherwise(F.substring(x, 1, 1) < rank))
        return (
            F.when(rank.isin("d", "x"), both(F.concat(out, F.array(t)), stack))
            .when(rank.isin("0", "3"), both(out, F.concat(stack, F.array(t))))
            .when(rank == "9", let(last_kept(stack, lambda x: F.substring(x, 1, 1) == "0"), closed))
            .otherwise(let(stays, operator))
        )

    return F.aggregate(codes, start, step, lambda s: F.concat(s["out"], F.reverse(s["open"])))


def power_mod(base: Column, exponent: Column, modulus: int) -> Column:
    start = F.struct(F.lit(1).cast("long").alias("r"), base.alias("b"))

    def step(s: Column, i: Column) -> Column:
        return F.struct(
            F.when(F.getbit(exponent, i) == 1, s["r"] * s["b"] % modulus).otherwise(s["r"]).alias("r"), (s["b"] * s["b"] % modulus).alias("b")
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(30)), start, step, lambda s: s["r"])


def value_of(m: Column, e: Column, k: Column, r: Column) -> Column:
    """m: modulo P. e: modulo Q, for exponents. k: the exact integer if it is a small one. r: as a real number."""
    return F.struct(m.cast("long").alias("m"), e.cast("long").alias("e"), k.cast("long").alias("k"), r.cast("double").alias("r"))


def number(text: Column) -> Column:
    def parsed(t: Column) -> Column:
        dot = F.instr(t, ".")
        places = F.when(dot > 0, F.length(t) - dot).otherwise(F.lit(0))
        return F.struct(places.alias("places"), F.replace(t, F.lit("."), F.lit("")).try_cast("bigint").alias("digits"), t.try_cast("double").alias("real"))

    def valued(z: Column) -> Column:
        places, digits = z["places"], z["digits"]
        ten = F.when(places <= 18, F.rpad(F.lit("1"), places + 1, F.lit("0")).try_cast("bigint"))

        def modulo(p: int) -> Column:
            return F.when(places == 0, digits % p).otherwise(digits % p * power_mod(ten % p, F.lit(p - 2).cast("long"), p) % p)

        return value_of(modulo(P), modulo(Q), F.when((places == 0) & (digits < SMALL), digits), z["real"])

    return let(let(text, parsed), valued)


def name(t: Column, point: Column) -> Column:
    """A name's value is a square that is drawn from name and point."""
    h = F.crc32(F.concat(t, point).cast("binary"))
    real = F.when(t == "x\\pi", F.lit(3.141592653589793)).otherwise(0.5 + h / F.lit(2.0**31))
    return value_of((h % P) * (h % P) % P, (h * 7919 + 13) % Q, F.lit(None), real)


def calculated(op: Column, x: Column, y: Column) -> Column:
    exact = F.pmod(y["k"], F.lit(P - 1))
    m = (
        F.when(op == "1+", (x["m"] + y["m"]) % P)
        .when(op == "1-", (x["m"] - y["m"] + P) % P)
        .when(op == "2*", x["m"] * y["m"] % P)
        .when((op == "2/") & (y["m"] != 0), x["m"] * power_mod(y["m"], F.lit(P - 2).cast("long"), P) % P)
        .when((op == "4^") & ((x["m"] != 0) | (y["k"] >= 0)), power_mod(x["m"], F.coalesce(exact, y["e"]), P))
    )
    e = (
        F.when(op == "1+", (x["e"] + y["e"]) % Q)
        .when(op == "1-", (x["e"] - y["e"] + Q) % Q)
        .when(op == "2*", x["e"] * y["e"] % Q)
        .when((op == "2/") & (y["e"] != 0), x["e"] * power_mod(y["e"], F.lit(Q - 2).cast("long"), Q) % Q)
        .when((op == "4^") & (x["e"] != 0), power_mod(x["e"], F.pmod(y["k"], F.lit(Q - 1)), Q))
    )
    r = (
        F.when(op == "1+", x["r"] + y["r"])
        .when(op == "1-", x["r"] - y["r"])
        .when(op == "2*", x["r"] * y["r"])
        .when((op == "2/") & (y["r"] != 0), F.try_divide(x["r"], y["r"]))
        .when(op == "4^", F.pow(x["r"], y["r"]))
    )
    whole = F.when(x["k"].isNotNull() & (y["k"] >= 0) & (F.abs(r) < SMALL), F.round(r).cast("long"))
    k = (
        F.when(op == "1+", x["k"] + y["k"])
        .when(op == "1-", x["k"] - y["k"])
        .when(op == "2*", x["k"] * y["k"])
        .when((op == "2/") & (y["k"] != 0) & (F.try_mod(x["k"], y["k"]) == 0), (x["k"] / y["k"]).cast("long"))
        .when(op == "4^", whole)
    )
    return let(k, lambda v: value_of(m, e, F.when(F.abs(v) < SMALL, v), r))


def root_exponents() -> list[int]:
    """The exponent of each root in ROOTS. Even exponents give squares, odd ones keep the sign."""
    inverse = [pow(i, -1, Q) for i in ROOTS]
    return [v if v % 2 == i % 2 else v + Q for i, v in zip(ROOTS, inverse, strict=True)]


def rooted(n: Column, x: Column) -> Column:
    """The n-th root: of a negative number the real one for an odd n. Square roots of whole numbers leave out the squares."""
    exponent = F.element_at(F.array(*[F.lit(v).cast("long") for v in root_exponents()]), n - 1)
    root = 1.0 / n
    real = F.when(n % 2 == 0, F.pow(x["r"], root)).otherwise(F.signum(x["r"]) * F.pow(F.abs(x["r"]), root))
    whole = F.when((n == 2) & (x["k"] >= 0), x["k"])
    top = F.floor(F.sqrt(whole.cast("double")) + 0.5)

    def of_square(outside: Column) -> Column:
        left = F.when(outside > 1, (whole / (outside * outside)).cast("long") % P).otherwise(x["m"])
        return value_of(outside * power_mod(left, exponent, P) % P, F.lit(None), F.lit(None), real)

    # Squares of the primes up to 67 come out of themselves.
    squares = F.filter(F.sequence(F.lit(LEAST_SQUARE).cast("long"), top), lambda i: whole % (i * i) == 0)
    outside = F.when(whole >= LEAST_SQUARE**2, F.array_max(squares))
    exact = value_of(top % P, top % Q, top, real)
    return F.when(top * top == whole, exact).otherwise(let(F.coalesce(outside, F.lit(1).cast("long")), of_square))


def evaluated(codes: Column, point: Column) -> Column:
    """The value of codes in postfix; null where they make no expression."""
    nothing = F.lit(None).cast(VALUE)

    def step(stack: Column, t: Column) -> Column:
        rank, size = F.substring(t, 1, 1), F.size(stack)
        x, y = F.get(stack, size - 2), F.get(stack, size - 1)

        def pushed(drop: int, value: Column) -> Column:
            return F.concat(F.slice(stack, F.lit(1), F.greatest(size - drop, F.lit(0))), F.array(value))

        minus = value_of((P - y["m"]) % P, (Q - y["e"]) % Q, -y["k"], -y["r"])
        binary = let(F.struct(x.alias("x"), y.alias("y")), lambda z: calculated(t, z["x"], z["y"]))
        return (
            F.when(rank == "d", pushed(0, number(F.substring(t, F.lit(2), F.length(t)))))
            .when(rank == "x", pushed(0, name(t, point)))
            .when(rank == "3", pushed(1, minus))
            .when(t.startswith("0R"), pushed(1, rooted(F.substring(t, 3, 1).cast("int"), y)))
            .when(rank.isin("1", "2", "4"), pushed(2, binary))
            .otherwise(F.concat(stack, F.array(nothing, nothing)))
        )

    return F.aggregate(
        codes,
        F.array().cast(f"array<{VALUE}>"),
        step,
        lambda s: F.when((F.size(s) == 1) & F.get(s, F.lit(0))["m"].isNotNull(), F.get(s, F.lit(0))),
    )


def scalar(c: Column) -> Column:
    """(key, value) of one expression: residues and signs at two points, and the real value where no name occurs."""

    def of_codes(codes: Column) -> Column:
        def keyed(v: Column) -> Column:
            def one(x: Column) -> Column:
                sign = F.when(x["m"] == 0, "0").when(F.isnan(x["r"]), "?").when(x["r"] < 0, "-").otherwise("+")
                return F.concat(sign, x["m"].cast("string"))

            constant = ~F.exists(codes, lambda t: t.startswith("x") & (t != "x\\pi"))
            key = F.concat(one(F.get(v, F.lit(0))), F.lit("|"), one(F.element_at(v, -1)))
            return F.struct(F.coalesce(key, F.concat(F.lit("text:"), c)).alias("key"), F.when(constant & key.isNotNull(), F.get(v, F.lit(0))["r"]).alias("value"))

        # Without a name the value is the same at both points.
        named = F.exists(codes, lambda t: t.startswith("x"))
        points = F.when(named, F.array(F.lit("1"), F.lit("2"))).otherwise(F.array(F.lit("1")))
        return let(F.transform(points, lambda point: evaluated(codes, point)), keyed)

    def of_whole(n: Column) -> Column:
        """What evaluation gives for a whole number, which is below the prime."""
        residue = F.when(n == 0, F.lit("00")).when(n < 0, F.concat(F.lit("-"), (n + P).cast("string"))).otherwise(F.concat(F.lit("+"), n.cast("string")))
        return F.struct(F.concat(residue, F.lit("|"), residue).alias("key"), n.cast("double").alias("value"))

    text = F.struct(F.concat(F.lit("text:"), c).alias("key"), F.lit(None).cast("double").alias("value"))
    whole = c.rlike(r"\A(?:\d{1,9}|-[1-9]\d{0,8})\z")
    return F.when(whole, let(c.try_cast("bigint"), of_whole)).when(is_expression(c), let(postfix(coded(c)), of_codes)).otherwise(text)


def marked(c: Column) -> Column:
    """Commas outside all brackets, inside one, and unions, each as its own mark."""
    found = F.regexp_extract_all(c, F.lit(r"(?s)\\cup|\\[a-zA-Z]+|\\.|."), F.lit(0))
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("out"))

    def step(s: Column, t: Column) -> Column:
        depth = s["depth"] + F.when(t.isin("(", "[", "{", "\\{"), 1).when(t.isin(")", "]", "}", "\\}"), -1).otherwise(0)
        sign = (
            F.when((t == ",") & (s["depth"] == 0), ITEM).when((t == ",") & (s["depth"] == 1), PART).when((t == "\\cup") & (s["depth"] == 0), MEMBER).otherwise(t)
        )
        return F.struct(depth.alias("depth"), F.concat(s["out"], sign).alias("out"))

    listed = (c.contains(",") | c.contains("\\cup")) & (F.length(c) <= MOST_CHARS)
    return F.when(listed, F.aggregate(found, start, step, lambda s: s["out"])).otherwise(c)


def taken_apart(c: Column) -> Column:
    """(kind, items): a matrix by rows, a set, list or union by members, and each tuple or interval by its parts."""
    matrix = r"(?s)\A\\begin\{([pbBvV]?)matrix\}(.*)\\end\{\1matrix\}\z"
    braced = c.rlike(r"(?s)\A\\\{.*\\\}\z") | (c.rlike(r"(?s)\A\{[^{}]*\}\z"))
    body = F.when(braced, F.regexp_replace(c, r"(?s)\A\\?\{|\\?\}\z", "")).otherwise(c)

    def item(p: Column) -> Column:
        tuple_like = p.rlike(rf"(?s)\A[(\[].*{PART}.*[)\]]\z")
        ends = F.concat(F.substring(p, 1, 1), F.substring(p, -1, 1))
        parts = F.split(F.substring(p, F.lit(2), F.length(p) - 2), PART)
        return F.struct(
            F.when(tuple_like, ends).otherwise(F.lit("")).alias("ends"),
            F.when(tuple_like, parts).otherwise(F.array(F.replace(p, F.lit(PART), F.lit(",")))).alias("cells"),
        )

    rows = F.transform(
        F.split(F.regexp_extract(c, matrix, 2), r"\\\\"), lambda row: F.struct(F.lit("").alias("ends"), F.split(row, "&").alias("cells"))
    )
    fence = F.translate(F.regexp_extract(c, matrix, 1), "pbB", "")
    listed = let(
        marked(body),
        lambda m: F.struct(
            F.when(m.contains(MEMBER), F.lit("union")).when(m.contains(ITEM), F.lit("set")).otherwise(F.lit("")).alias("kind"),
            F.transform(F.split(m, f"[{ITEM}{MEMBER}]"), item).alias("items"),
        ),
    )
    return F.when(c.rlike(matrix), F.struct(F.concat(F.lit("matrix"), fence).alias("kind"), rows.alias("items"))).otherwise(listed)


def expression_key(norm: Column | str) -> Column:
    """(key, value) of a normalised answer. Answers with the same key are equal; null for null.

    Numbers, names, sums, products, fractions, powers and roots are compared by value, so ``1/2+x`` has the key of
    ``(2x+1)/2``. The members of sets, comma lists and unions have no order and count once; tuples, intervals (with
    their open and closed ends) and matrix rows have one. A set of one member is that member, ``x=`` in front of an
    answer is dropped. Whatever is not understood keeps its text. Roots of sums may be judged different although they are equal; the
    ``value`` is the real number if there is no name in the answer.

    Built from SQL functions alone, whose lambdas Spark walks node by node: some 0.2 ms of a core for each answer.
    ``answer_key`` gives the same rows faster.
    """

    def joined(apart: Column) -> Column:
        def of_item(i: Column) -> Column:
            return F.struct(i["ends"].alias("ends"), F.transform(i["cells"], scalar).alias("cells"))

        def keyed(items: Column) -> Column:
            keys = F.transform(items, lambda i: F.concat(i["ends"], F.concat_ws(";", F.transform(i["cells"], lambda x: x["key"]))))
            ordered = F.when(apart["kind"].isin("set", "union"), F.array_sort(F.array_distinct(keys))).otherwise(keys)
            single = (apart["kind"] == "") & (F.get(items, F.lit(0))["ends"] == "")
            return F.struct(
                F.concat(apart["kind"], F.lit(":"), F.array_join(ordered, " & ")).alias("key"),
                F.when(single, F.get(F.get(items, F.lit(0))["cells"], F.lit(0))["value"]).alias("value"),
            )

        return let(F.transform(apart["items"], of_item), keyed)

    norm = as_col(norm)
    return F.when(norm.isNotNull(), let(prepared(norm), lambda c: let(taken_apart(c), joined)))


@cache
def compiled_key(application: str) -> object:
    """AnswerKey.java as a function of Spark's, compiled by the compiler that Spark brings and handed to all executors as a jar."""
    spark = SparkSession.active()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    loader = spark._jsparkSession.sharedState().jarClassLoader()
    compiler = jvm.org.codehaus.janino.SimpleCompiler()
    compiler.setParentClassLoader(loader)
    compiler.cook(files(__package__).joinpath("AnswerKey.java").read_text("utf-8"))
    jar = os.path.join(tempfile.mkdtemp(prefix="rollscore-"), "answer-key.jar")
    with zipfile.ZipFile(jar, "w") as out:
        for name, body in compiler.getBytecodes().items():
            out.writestr(f"{name.replace('.', '/')}.class", bytes(body))
    spark._jsparkSession.sessionState().resourceLoader().addJar(jar)

    def array(kind: object, values: list) -> object:
        made = gateway.new_array(kind, len(values))
        for i, v in enumerate(values):
            made[i] = v
        return made

    texts = [array(jvm.java.lang.String, list(x)) for x in (*zip(*SPELLINGS, strict=True), GREEK)]
    made = loader.loadClass("AnswerKey").getConstructors()[0].newInstance(
        array(jvm.java.lang.Object, [*texts, array(gateway.jvm.long, root_exponents())])
    )
    # Asked for by its types: a plain call may also find the variant for functions of Scala, which refuses this one.
    sql = "org.apache.spark.sql"
    types = array(jvm.java.lang.Class, [loader.loadClass(f"{sql}.api.java.UDF1"), loader.loadClass(f"{sql}.types.DataType")])
    kind = jvm.org.apache.spark.sql.types.DataType.fromDDL("key string, value double")
    return loader.loadClass(f"{sql}.functions").getMethod("udf", types).invoke(None, array(jvm.java.lang.Object, [made, kind]))


def answer_key(norm: Column | str) -> Column:
    """What ``expression_key`` gives, compiled: some microseconds for each answer, and native too. Null for null."""
    context = SparkContext._active_spark_context
    if context is None:
        return expression_key(norm)
    return ClassicColumn(compiled_key(context.applicationId).apply(_to_seq(context, [as_col(norm)._jc])))
