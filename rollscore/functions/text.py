"""Text columns with the whitespace and counting rules of the scored language's built-in strings."""

from __future__ import annotations

import re
from functools import lru_cache
from unicodedata import normalize

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every code point that str.split() and str.strip() treat as whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a regex class.
WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"

# Scripts that mark a text as not English (first and last code point).
FOREIGN_SCRIPTS = {
    "cyrillic": [(0x0400, 0x04FF)],
    "cjk": [(0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF)],
    "arabic": [(0x0600, 0x06FF)],
    "hebrew": [(0x0590, 0x05FF)],
    "thai": [(0x0E00, 0x0E7F)],
    "greek": [(0x0370, 0x03FF)],
}

# LaTeX that is ignored by the language check. Math spans and environments, then single commands.
LATEX_SPANS = r"(?s)\$[^$]*+\$|\\\(.*?\\\)|\\\[.*?\\\]|\\begin\{.*?\}.*?\\end\{.*?\}"
LATEX_COMMANDS = r"\\[a-zA-Z]++(?:\{[^{}]*+\})*+"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_div(c: Column | str, n: int) -> Column:
    """Floor division in integers, exact for every 64-bit id."""
    c = as_col(c)
    return F.call_function("div", c - F.pmod(c, F.lit(n)), F.lit(n))


def count_substring(c: Column | str, needle: str) -> Column:
    """Non-overlapping occurrences of ``needle``, scanning from the left."""
    c = as_col(c)
    removed = F.length(c) - F.length(F.replace(c, F.lit(needle), F.lit("")))
    return int_div(removed, len(needle)).cast("int")


def py_strip(c: Column | str) -> Column:
    return F.trim(as_col(c), F.lit(WHITESPACE))


def py_split(c: Column | str) -> Column:
    """Words between whitespace runs; no empty words."""
    return F.array_remove(F.split(as_col(c), WHITESPACE_RUN), "")


def ngrams(words: Column | str, n: int) -> Column:
    """Sliding ``n``-word windows, each joined by one space (words hold none, so the join is lossless).

    ``words`` should be a bound column. The windows are built by zipping shifted copies of the array: no lambda
    indexes back into it, and the string results can be hashed by ``array_distinct``.
    """
    words = as_col(words)
    count = F.greatest(F.size(words) - F.lit(n - 1), F.lit(0))
    grams = F.slice(words, F.lit(1), count)
    for shift in range(2, n + 1):
        grams = F.zip_with(grams, F.slice(words, F.lit(shift), count), lambda a, b: F.concat(a, F.lit(" "), b))
    return grams


@lru_cache(maxsize=1)
def foreign_class() -> str:
    """Regex class of every character whose compatibility decomposition reaches a foreign script.

    Decomposition works per character, so testing the raw text against this class equals testing the decomposed text
    against the script ranges, and no Python runs in the job.
    """
    scripts = [r for ranges in FOREIGN_SCRIPTS.values() for r in ranges]

    def foreign(code: int) -> bool:
        if 0xD800 <= code <= 0xDFFF:
            return False
        return any(lo <= ord(ch) <= hi for ch in normalize("NFKD", chr(code)) for lo, hi in scripts)

    runs: list[list[int]] = []
    for code in range(0x80, 0x110000):
        if not foreign(code):
            continue
        if runs and runs[-1][1] == code - 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])

    def spans(pairs: list[list[int]]) -> str:
        return "".join(f"\\x{{{lo:x}}}-\\x{{{hi:x}}}" for lo, hi in pairs)

    # The class is an intersection whose first half is small, so that Latin text fails it at once.
    low = [r for r in runs if r[1] < 0x370]
    return f"[{spans([*low, [0x370, 0x10FFFF]])}&&[{spans(runs)}]]"


def without_latex(c: Column | str) -> Column:
    """Drop math spans and environments first, then remaining commands with their brace arguments."""
    c = as_col(c)
    stripped = F.regexp_replace(F.regexp_replace(c, LATEX_SPANS, ""), LATEX_COMMANDS, "")
    return F.when(c.contains("\\") | c.contains("$"), stripped).otherwise(c)


def is_non_english(c: Column | str) -> Column:
    """True if a foreign script shows outside LaTeX. Blank texts are False."""
    return without_latex(c).rlike(foreign_class())


def fill_template(template: str, **slots: Column) -> Column:
    """``template`` with each ``{name}`` replaced by a column, in one left-to-right pass.

    Built as a concatenation, so inserted text is never scanned for further slots and may hold ``{``, ``%`` or ``$``.
    """
    pattern = "|".join(re.escape("{" + name + "}") for name in slots)
    pieces = re.split(f"({pattern})", template)
    names = {"{" + name + "}": col for name, col in slots.items()}
    return F.concat(*[names[p] if p in names else F.lit(p) for p in pieces if p])
