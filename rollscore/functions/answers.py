"""Pull answers out of completions and compare them with gold answers, as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .algebra import answer_key
from .text import as_col, py_strip

BOX = "\\boxed{"
LETTERS = ["A", "B", "C", "D"]
# What a box holds up to its closing brace, with braces nested up to three deep. No loop gives back what it took.
NESTED = r"\A((?:[^{}]++|\{(?:[^{}]++|\{(?:[^{}]++|\{[^{}]*+\})*+\})*+\})*+)\}"
# Decimal places kept when two numeric answers are compared (fixed value).
PRECISION = 5


def extract_code(c: Column | str, language: str = "python") -> Column:
    """Body of the last fenced block of ``language``, or an empty string."""
    blocks = F.regexp_extract_all(as_col(c), F.lit(f"(?s)```{language}\\n(.*?)```"), F.lit(1))
    return F.coalesce(F.try_element_at(blocks, F.lit(-1)), F.lit(""))


def extract_answer(c: Column | str) -> Column:
    """Answer shown by a completion: the answer tags, else the first box up to the first brace, else the last line.

    A closing answer tag in front of the opening one gives an empty string, and a box that never closes loses its last
    character, as slicing with those positions does.
    """
    c = as_col(c)
    opened, closed = F.instr(c, "<answer>"), F.instr(c, "</answer>")
    start = opened + F.lit(len("<answer>"))
    tagged = F.substring(c, start, F.greatest(closed - start, F.lit(0)))

    box_start = F.instr(c, BOX) + F.lit(len(BOX))
    brace = F.position(F.lit("}"), c, box_start)
    box_end = F.when(brace > 0, brace).otherwise(F.length(c))
    boxed = F.substring(c, box_start, F.greatest(box_end - box_start, F.lit(0)))

    last_line = F.substring_index(py_strip(c), "\n", -1)
    return (
        F.when((opened > 0) & (closed > 0), py_strip(tagged))
        .when(F.instr(c, BOX) > 0, py_strip(boxed))
        .otherwise(last_line)
    )


def boxed_answer(c: Column | str) -> Column:
    """Content of the last balanced box, braces nested to any depth; null without one.

    One pass over braces and the text between them keeps the depth and the boxes that are still open. Of nested boxes
    the outermost one closes last, so the box closed last is the answer. A single box that is not nested deeply needs no
    such pass.
    """
    c = as_col(c)
    tail = F.substring(c, F.instr(c, BOX), F.length(c))
    tokens = F.regexp_extract_all(tail, F.lit(r"\\boxed\{|[{}]|[^{}\\]++|\\"), F.lit(0))
    opened = "array<struct<start:int,depth:int>>"
    state = F.struct(
        F.lit(1).alias("at"),
        F.lit(0).alias("depth"),
        F.array().cast(opened).alias("open"),
        F.lit(0).alias("start"),
        F.lit(0).alias("size"),
    )

    def step(s: Column, t: Column) -> Column:
        closes, opens = t == "}", (t == "{") | (t == BOX)
        deeper = s["depth"] + F.when(opens, 1).when(closes & (s["depth"] > 0), -1).otherwise(0)
        top = F.try_element_at(s["open"], F.lit(-1))
        done = F.coalesce(closes & (top["depth"] == s["depth"]), F.lit(False))
        box = F.array(F.struct((s["at"] + len(BOX)).alias("start"), deeper.alias("depth")))
        return F.struct(
            (s["at"] + F.length(t)).alias("at"),
            deeper.alias("depth"),
            F.when(t == BOX, F.concat(s["open"], box))
            .when(done, F.slice(s["open"], 1, F.greatest(F.size(s["open"]) - 1, F.lit(0))))
            .otherwise(s["open"])
            .alias("open"),
            F.when(done, top["start"]).otherwise(s["start"]).alias("start"),
            F.when(done, s["at"] - top["start"]).otherwise(s["size"]).alias("size"),
        )

    found = F.aggregate(tokens, state, step, lambda s: F.when(s["start"] > 0, F.substring(tail, s["start"], s["size"])))
    before, after = F.substring_index(c, BOX, 1), F.substring_index(c, BOX, -1)
    alone = F.octet_length(before) + F.octet_length(after) + F.lit(len(BOX)) == F.octet_length(c)
    content = F.substring_index(after, "}", 1)
    flat = alone & after.contains("}") & ~content.contains("{")
    nested = F.when(alone, F.nullif(F.regexp_extract(after, NESTED, 1), F.lit("")))
    return F.when(flat, content).otherwise(F.coalesce(nested, F.when(F.instr(c, BOX) > 0, found)))


def normalize_answer(c: Column | str) -> Column:
    """Canonical answer text; null if nothing is left.

    Drops math delimiters, sizing commands, text wrappers, spacing and a closing period; unifies fraction commands;
    removes thousands commas when the whole answer is one number.
    """
    c = as_col(c)
    steps = [
        (r"\\text\w*\{([^{}]*)\}|\\mathrm\{([^{}]*)\}|\\mbox\{([^{}]*)\}", "$1$2$3"),
        (r"\\(?:left|right)(?![a-zA-Z])|(?<!\\)\\[!,;: ]", ""),
        (r"\\[dt]frac(?![a-zA-Z])", r"\\frac"),
        (r"\\[()\[\]]|\$|[\s\x{a0}]+", ""),
        (r"\.$", ""),
        # A comma goes only if everything around it is one grouped number (at most 30 groups in front of it). Looking behind
        # is dear, so it comes last.
        (r",(?=\d{3}(?:,\d{3})*(?:\.\d+)?\z)(?<=\A[+-]?\d{1,3}(?:,\d{3}){0,30},)", ""),
    ]
    for pattern, replacement in steps:
        c = F.regexp_replace(c, pattern, replacement)
    return F.nullif(c, F.lit(""))


def normalize_gold(c: Column | str) -> Column:
    """Gold answers may come inside a box or bare."""
    c = as_col(c)
    return normalize_answer(F.coalesce(boxed_answer(c), c))


def numeric_value(norm: Column | str) -> Column:
    """Value of a plain number, a percentage or a fraction in normalised text; null otherwise."""
    num = r"[+-]?(?:\d+(?:\.\d+)?|\.\d+)"
    fraction = rf"\A([+-]?)\\frac\{{({num})\}}\{{({num})\}}\z"
    number = rf"\A(?:--)?({num})(?:/({num})|\\?%)?\z"
    norm = as_col(norm)
    flat = F.regexp_replace(norm, fraction, "$1$2/$3")
    top, under = (F.regexp_extract(flat, number, i).try_cast("double") for i in (1, 2))
    # Where there is a number on top, these signs tell the divisor.
    divisor = F.when(norm.endswith("%"), F.lit(100.0)).when(norm.contains("/") | norm.contains("frac"), under).otherwise(F.lit(1.0))
    # Any other sign than these makes it no number.
    return F.when(norm.rlike(r"\A[-+.\d/%\\{}]++(?:frac[-+.\d{}]++)?\z"), F.try_divide(top, divisor))


def answers_match(pred_norm: Column, gold_norm: Column, pred_value: Column, gold_value: Column) -> Column:
    """Equal values at the fixed precision if both are numeric, else equal normalised text. Never null."""
    same_value = F.round(pred_value, PRECISION) == F.round(gold_value, PRECISION)
    both = pred_value.isNotNull() & gold_value.isNotNull()
    return F.coalesce(F.when(both, same_value).otherwise(pred_norm == gold_norm), F.lit(False))


def answers_equivalent(
    pred_norm: Column, gold_norm: Column, pred_value: Column, gold_value: Column, pred_key: Column, gold_key: Column
) -> Column:
    """``answers_match``, or else equal keys (see ``answer_key``). Two plain numbers are compared as numbers alone.

    An answer given with decimals also equals an exact one, such as a root, that rounds to it. Never null.
    """
    plain = pred_value.isNotNull() & gold_value.isNotNull()
    decimal = pred_norm.contains(".") | gold_norm.contains(".")
    rounded = decimal & (F.round(pred_key["value"], PRECISION) == F.round(gold_key["value"], PRECISION))
    same = F.coalesce(pred_key["key"] == gold_key["key"], F.lit(False)) | F.coalesce(rounded, F.lit(False))
    return answers_match(pred_norm, gold_norm, pred_value, gold_value) | (~plain & same)


def undecided(pred_norm: Column, gold_norm: Column, pred_value: Column, gold_value: Column) -> Column:
    """Whether only the keys can tell if two answers are equal, so that no other row pays for them."""
    return pred_norm.isNotNull() & gold_norm.isNotNull() & (pred_norm != gold_norm) & (pred_value.isNull() | gold_value.isNull())


def with_grading(df: DataFrame, content: str = "content", gold: str = "solution", equivalence: bool = True) -> DataFrame:
    """Add ``gold_norm``, ``pred_norm`` and ``is_correct`` once; every graded reward reads these columns.

    With ``equivalence`` answers that differ as text and are not both plain numbers are compared as mathematics. Where all
    answers are plain numbers it changes nothing, and leaving it off saves the second that compiling the key takes. Each
    regex chain is bound as a column before something reads it twice.
    """
    parsed = df.withColumns(
        {"gold_norm": normalize_gold(gold), "pred_norm": normalize_answer(boxed_answer(content))}
    ).withColumns({"_gold_value": numeric_value("gold_norm"), "_pred_value": numeric_value("pred_norm")})
    four = [F.col(c) for c in ("pred_norm", "gold_norm", "_pred_value", "_gold_value")]
    if not equivalence:
        return parsed.select(*df.columns, "gold_norm", "pred_norm", answers_match(*four).alias("is_correct"))
    both = parsed.withColumn("_open", undecided(*four))
    keyed = both.withColumns({f"_{side}_key": F.when(F.col("_open"), answer_key(f"{side}_norm")) for side in ("pred", "gold")})
    match = answers_equivalent(*four, F.col("_pred_key"), F.col("_gold_key"))
    return keyed.select(*df.columns, "gold_norm", "pred_norm", match.alias("is_correct"))


def with_multi_gold(df: DataFrame, content: str, golds: str, out: str = "score", equivalence: bool = True) -> DataFrame:
    """Best comparison of a completion with any of its golds, as 0.0 or 1.0.

    The prediction is bound as columns before the array is walked, so its regexes and its key run once per row; keys of
    the golds are asked for only where none matches without them.
    """

    def score(gold: Column) -> Column:
        return answers_match(F.col("_pred"), gold, F.col("_pred_value"), numeric_value(gold)).cast("double")

    graded = (
        df.withColumn("_pred", normalize_answer(boxed_answer(content)))
        .withColumn("_pred_value", numeric_value("_pred"))
        .withColumn("_golds", F.transform(golds, normalize_gold))
        .withColumn(out, F.coalesce(F.array_max(F.transform("_golds", score)), F.lit(0.0)))
    )
    if equivalence:

        def equivalent(x: Column) -> Column:
            gold, value = x["gold"], numeric_value(x["gold"])
            four = F.col("_pred"), gold, F.col("_pred_value"), value
            pred, own = F.get("_keys", F.lit(0)), F.get("_keys", x["i"] + 1)
            return undecided(*four) & answers_equivalent(*four, pred, own)

        asked = F.when((F.col(out) < 1.0) & F.col("_pred").isNotNull(), F.concat(F.array("_pred"), F.col("_golds")))
        numbered = F.transform("_golds", lambda g, i: F.struct(g.alias("gold"), i.alias("i")))
        graded = graded.withColumn("_open", asked).withColumn("_keys", F.transform("_open", answer_key)).withColumn(
            out, F.when(F.coalesce(F.exists(numbered, equivalent), F.lit(False)), F.lit(1.0)).otherwise(F.col(out))
        )
    return graded.drop("_pred", "_pred_value", "_golds", "_open", "_keys")


def gold_letter(index: Column | str) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in LETTERS]), as_col(index).cast("int") + 1)


def index_match(c: Column | str, choices: Column | str, gold_index: Column | str) -> Column:
    """1.0 if the last choice letter that stands alone after ``Answer:`` is the gold one."""
    found = F.regexp_extract_all(as_col(c), F.lit(r"Answer:\s*\$?([A-D])(?![A-Za-z])"), F.lit(1))
    letter = F.try_element_at(found, F.lit(-1))
    gold = F.element_at(as_col(choices), as_col(gold_index).cast("int") + 1)
    return F.coalesce((letter == gold).cast("double"), F.lit(0.0))
