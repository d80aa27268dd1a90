"""Personal data: entities get keyed surrogates of their own type and format, checked for collisions."""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, written

MALE, FEMALE, NEUTRAL = "male", "female", "neutral"
# Forms of address with the gender they name.
TITLES = {
    MALE: ("Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Don", "господин", "Г-н", "г-н"),
    FEMALE: ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Señora", "Sra", "Doña", "госпожа", "Г-жа", "г-жа"),
    NEUTRAL: ("Dr", "Prof", "Professor"),
}
# Given names and syllables of surnames by script.
GIVEN = {
    ("latin", MALE): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leon Martin Noel Oscar Paul Robert Simon Thomas Victor".split(),
    ("latin", FEMALE): "Anna Berta Clara Diana Emma Flora Greta Helena Irene Julia Klara Laura Maria Nora Olivia Paula Rosa Sara Teresa Vera".split(),
    ("latin", NEUTRAL): "Alex Charlie Dominique Jona Kai Kim Luca Noa Robin Sam".split(),
    ("cyrillic", NEUTRAL): "Женя Валя Саша Шура".split(),
    ("cyrillic", MALE): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим".split(),
    ("cyrillic", FEMALE): "Анна Вера Галина Дарья Елена Зоя Ирина Ксения Лидия Мария".split(),
}
SYLLABLES = {
    "latin": "ba be bo da de do fa fe fi ga go ha ka ke ko la le lo ma me mi na ne no pa pe ra re ro sa se ta te to va vi wa we za zo".split(),
    "cyrillic": "ба бе во га да де жа за ка ко ла ле ло ма ме ми на не но па ра ре ро са се та те то ха ша".split(),
}

# How long the account numbers of a country are, its two letters and check digits included.
IBAN_SIZES = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU",
    31: "MT SC", 32: "LC", 33: "RU",
}
IBAN_SIZE = {country: n for n, countries in IBAN_SIZES.items() for country in countries.split()}

TITLE = "|".join(sorted((t for v in TITLES.values() for t in v), key=len, reverse=True))
# A name word goes on over apostrophes and hyphens, but not into a possessive s; letters with a full stop are initials.
WORD = r"[^\W\d_]+(?:(?:['’](?!s(?!\w))|-)[^\W\d_]+)*"
INITIALS = r"(?:[^\W\d_]\.[ ]?)"
# The letters of addresses: those that have a capital of one character in their own script.
MAIL_LETTERS = "A-Za-zà-öø-þÀ-ÖØ-Þа-яёА-ЯЁά-ώΆΈ-Ϋ"
MAIL = f"0-9{MAIL_LETTERS}"
# The kinds in the order in which they are tried at a place. Cards in unusual groups come after phone numbers.
PATTERNS = {
    "email": rf"[{MAIL}](?:[{MAIL}._%+-]*[{MAIL}_%+-])?@[{MAIL}-]+(?:\.[{MAIL}-]+)*\.[{MAIL_LETTERS}]{{2,}}",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)(?!\w)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "card": r"(?<![\w+-])\d(?:[ -]?\d){12,18}(?![\w-])",
    "phone": r"(?<!\w)(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4})(?!\w)",
    "name": r"(?<!\w)(?P<title>" + TITLE + r")\.?[ ]+(?P<who>" + INITIALS + "{0,3}" + WORD + "(?:[ ]" + INITIALS + "{0,3}" + WORD + "){0,2})",
}
ENTITY = re.compile("|".join(f"(?P<{k}>{v})" for k, v in PATTERNS.items()))
KINDS = {k: re.compile(PATTERNS[k]) for k in ("email", "ip", "ssn", "iban", "card", "phone")}
KINDS |= {"other card": KINDS["card"], "name": re.compile(PATTERNS["name"])}
# What every text with an entity holds: without two digits in a row an address has single digits, a card a gap after each.
MAYBE = re.compile(r"@|\d(?:\d|(?:\.\d){3}|(?:[ -]\d){12})|\b(?:" + TITLE + r")\b")


def luhn(digits: str) -> int:
    """The check digit of ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def script_of(word: str) -> str:
    return "cyrillic" if any("Ѐ" <= c <= "ӿ" for c in word) else "latin"


def gender_of(title: str, name: str) -> str:
    """The gender that a form of address names, else that of a listed given name, else neutral."""
    gender = next(g for g, titles in TITLES.items() if title in titles)
    first = name.split(" ")[0]
    return next((g for (_, g), names in GIVEN.items() if first in names), gender) if gender == NEUTRAL else gender


def groups_in(shown: str) -> list[tuple[int, int]]:
    """(start, end) of the runs of digits."""
    return [m.span() for m in re.finditer(r"\d+", shown)]


def card_end(text: str, start: int, end: int, usual: bool) -> int | None:
    """Where the longest right card number ends that starts at ``start`` and takes whole groups of digits up to ``end``.

    ``usual``: only numbers without a gap, or in 4-4-4-4, 4-4-4-4-3, 4-6-5 or 4-6-4. All others must not end before a hyphen.
    """
    if text[start] not in "23456":
        return None
    runs = groups_in(text[start:end])
    for n in range(len(runs), 0, -1):
        digits = "".join(text[start + a : start + b] for a, b in runs[:n])
        if not 13 <= len(digits) <= 19:
            continue
        sizes, at = [b - a for a, b in runs[:n]], start + runs[n - 1][1]
        fits = n == 1 or sizes in ([4, 4, 4, 4], [4, 4, 4, 4, 3], [4, 6, 5], [4, 6, 4])
        if (fits if usual else text[at : at + 1] != "-") and luhn(digits[:-1]) == int(digits[-1]):
            return at
    return None


def account_rest(account: str) -> int:
    """What is left of an account number, its first four symbols put last, by 97; 1 for a right one."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97


def account_end(text: str, start: int, end: int) -> int | None:
    """Where the account number ends that starts at ``start``: as long as its country's are, with right check digits."""
    size = IBAN_SIZE.get(text[start : start + 2])
    at = [i for i in range(start, end) if text[i] != " "]
    if size is None or len(at) < size or (len(at) > size and text[at[size] - 1] != " "):
        return None
    return at[size - 1] + 1 if account_rest("".join(text[i] for i in at[:size])) == 1 else None


def checked(kind: str, m: re.Match) -> tuple[int, int, str] | None:
    """(start, end, canonical form) of what the match holds of its kind from its start on, None if that is nothing.

    Of digits only whole groups are taken: a card or phone number may end before digits that follow it.
    """
    text, (start, end) = m.string, m.span()
    if kind == "card":
        end = card_end(text, start, end, usual=True)
    elif kind == "other card":
        inner = [start + a for a, _ in groups_in(m[0])[1:] if text[start + a - 1] != "-"]
        end = card_end(text, start, end, usual=False)
        if end and any((n := KINDS["card"].match(text, a)) and card_end(text, a, n.end(), usual=True) for a in inner):
            return None
    elif kind == "iban":
        end = account_end(text, start, end)
    elif kind == "phone":
        runs = groups_in(m[0])
        end = next((start + b for n, (_, b) in reversed([*enumerate(runs, 1)]) if 7 <= sum(y - x for x, y in runs[:n]) <= 15), None)
    elif kind == "name":
        words, titles = m["who"].split(" "), {t for v in TITLES.values() for t in v} - {"Don"}
        many = next((i for i, w in enumerate(words) if not any(p[:1].isupper() for p in re.split("['’-]", w)) or w in titles), len(words))
        start = m.start("who")
        end = start + len(" ".join(words[:many])) if many else None
    if end is None:
        return None
    value = text[start:end]
    if kind == "email":
        value = value.lower()
    elif kind in ("card", "other card", "phone", "ssn"):
        value = ("+" if kind == "phone" and value[0] == "+" else "") + re.sub(r"\D", "", value)
    elif kind == "iban":
        value = value.replace(" ", "")
    elif kind == "name":
        value = f"{gender_of(m['title'], value)}:{value}"
    return start, end, value


def entities(text: str) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, type, canonical form) of the entities of a text, from the left. Equal forms are one entity.

    Where a match fails its check the kinds after it are tried at the same place, then the search goes on at the next
    character; after an entity it goes on at its end. So no text is passed over with a match.
    """
    if not MAYBE.search(text):
        return
    at, order = 0, list(KINDS)
    while m := ENTITY.search(text, at):
        at = m.start() + 1
        first = next(k for k in order if m.groupdict().get(k) is not None)
        for kind in order[order.index(first) :]:
            one = m if kind == first else KINDS[kind].match(text, m.start())
            if one and (found := checked(kind, one)):
                at = found[1]
                yield *found[:2], "card" if kind == "other card" else kind, found[2]
                break


def stream(key: bytes, *parts: str) -> bytes:
    return hmac.new(key, "\x1f".join(parts).encode(), hashlib.sha512).digest()


def permuted(key: bytes, tweak: str, values: list[int], radix: list[int]) -> list[int]:
    """A keyed permutation of all lists with these radices: halves are shifted in turn by a hash of the other half."""
    half = (len(values) + 1) // 2
    values = list(values)
    for r in range(8):
        moved, other = (range(half), values[half:]) if r % 2 == 0 else (range(half, len(values)), values[:half])
        for i in moved:
            shift = stream(key, tweak, str(r), str(i), ",".join(map(str, other)))
            values[i] = (values[i] + int.from_bytes(shift[:8], "big")) % radix[i]
    return values


# Symbols that stand for each other: digits, and the letters of a script without those of other scripts.
SMALL = ("abcdefghijklmnopqrstuvwxyz", "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþ", "абвгдежзийклмнопрстуфхцчшщъыьэюяё", "άέήίαβγδεζηθικλμνξοπρστυφχψωόύώ")
CLASSES = ("0123456789", *SMALL, *(k.upper() for k in SMALL))


def reformat(key: bytes, tweak: str, text: str, allowed=lambda s: True) -> str:
    """A keyed permutation of all texts of this format: digits, small and capital letters keep their kind and place.

    Steps on until the result is ``allowed``, as ``text`` is, which keeps it a permutation of the allowed texts. A text may come out as
    it was (one without a letter or digit does); ``assigned`` draws anew then.
    """
    at = [(i, next(k for k in CLASSES if c in k)) for i, c in enumerate(text) if any(c in k for k in CLASSES)]
    now = text
    while True:
        moved = permuted(key, tweak, [k.index(now[i]) for i, k in at], [len(k) for _, k in at])
        letters = list(now)
        for (i, k), v in zip(at, moved, strict=True):
            letters[i] = k[v]
        now = "".join(letters)
        if allowed(now):
            return now


def surrogate(key: bytes, kind: str, value: str, attempt: int) -> str:
    """The canonical form of an entity's surrogate. For each type and attempt but names a permutation of its format.

    Of names each part has its own: ``given`` ones are put together from the list of their gender and script, ``surname``
    ones from syllables, both the longer the more attempts there were.
    """
    tweak = f"{kind}/{attempt}"
    if kind == "email":
        local, domain = value.split("@")
        host, _, top = domain.rpartition(".")
        # There are few short names: from the eighth attempt on a name grows by a letter each time.
        more = "".join(SMALL[0][b % 26] for b in stream(key, tweak, "more", value)[: min(max(attempt - 7, 0), 40)])
        return f"{reformat(key, tweak, local)}{more}@{reformat(key, 'domain', host)}.{top}"
    if kind == "ip":
        parts = [int(x) for x in value.split(".")]
        inside = lambda p: p[0] in (10, 127) or p[:2] == [192, 168] or (p[0] == 172 and 16 <= p[1] < 32)
        moved = permuted(key, tweak, parts, [256] * 4)
        while inside(moved) != inside(parts):
            moved = permuted(key, tweak, moved, [256] * 4)
        return ".".join(map(str, moved))
    if kind == "card":
        body = value[0] + reformat(key, f"{tweak}/{value[0]}", value[1:-1])
        return body + str(luhn(body))
    if kind == "ssn":
        sound = lambda s: s[:3] not in ("000", "666") and s[0] != "9" and s[3:5] != "00" and s[5:] != "0000"
        return reformat(key, tweak, value, (lambda s: sound(s)) if sound(value) else (lambda s: not sound(s)))
    if kind == "phone":
        head = min(len(value) - 7, 3) if value[0] == "+" else 0
        head = 2 if value.startswith(("+1", "+7")) else head
        rest = value[head:]
        return value[:head] + reformat(key, f"{tweak}/{value[:head]}", rest, lambda s: (s[0] in "01") == (rest[0] in "01"))
    if kind == "iban":
        body = reformat(key, tweak, value[4:])
        rest = int("".join(str(int(c, 36)) for c in body + value[:2] + "00")) % 97
        return f"{value[:2]}{98 - rest:02d}{body}"
    gender, _, word = value.rpartition(":")
    script = script_of(word)
    draw = stream(key, tweak, value)
    if kind == "given":
        names = GIVEN[script, gender]
        return f"{gender}:{''.join(names[draw[i] % len(names)] for i in range(min(attempt, 20) + 1)).capitalize()}"
    parts = SYLLABLES[script]
    return "".join(parts[int.from_bytes(draw[8 + 2 * i : 10 + 2 * i], "big") % len(parts)] for i in range(min(3 + attempt, 20))).capitalize()


def name_parts(value: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical form) of the runs of letters of a name after its gender.

    Those of the last word are ``surname``, those of the words before it ``given``, single letters ``initial``.
    """
    gender, _, shown = value.partition(":")
    last = max(shown.rfind(" "), shown.rfind(".", 0, -1)) + 1
    out = []
    for m in re.finditer(r"[^\W\d_]+", shown):
        kind = "initial" if len(m[0]) == 1 else "surname" if m.start() >= last else "given"
        out.append((*m.span(), kind, f"{gender}:{m[0].capitalize()}" if kind == "given" else m[0].capitalize()))
    return out


def units(kind: str, value: str) -> list[tuple[str, str]]:
    """(kind, canonical form) of what gets surrogates of its own in an entity: itself, or the parts of a name."""
    return [p[2:] for p in name_parts(value) if p[2] != "initial"] if kind == "name" else [(kind, value)]


def initial(key: bytes, letter: str) -> str:
    """Another letter of the script. There are too few for all to differ."""
    letters = "АБВГДЕЖЗИКЛМНОПРСТУФХЭЮЯ" if script_of(letter) == "cyrillic" else "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    others = letters.replace(letter.upper(), "")
    return others[int.from_bytes(stream(key, "initial", letter.upper())[:8], "big") % len(others)]


def styled(kind: str, shown: str, new: str) -> str:
    """The surrogate written as the entity was: separators and capital letters stay in place."""
    if kind == "email":
        if len(shown) != len(new):
            return new
        return "".join(n.upper() if s.isupper() else n for s, n in zip(shown, new, strict=True))
    if kind in ("card", "phone", "ssn", "iban"):
        symbols = iter(new.lstrip("+"))
        return "".join(next(symbols) if c.isalnum() else c for c in shown)
    if kind in ("given", "surname", "initial"):
        new = new.rpartition(":")[2]
        return new.lower() if shown[0].islower() else new.upper() if shown.isupper() else new
    return new


def renamed(value: str, key: bytes, later: dict[tuple[str, str], int]) -> str:
    """A name with its parts replaced."""
    shown = value.partition(":")[2]
    out, at = [], 0
    for start, end, kind, part in name_parts(value):
        new = initial(key, part) if kind == "initial" else surrogate(key, kind, part, later.get((kind, part), 0))
        out += [shown[at:start], styled(kind, shown[start:end], new)]
        at = end
    return "".join([*out, shown[at:]])


def replaced(text: str, key: bytes, later: dict[tuple[str, str], int], cache: dict) -> tuple[str, int]:
    out, at, n = [], 0, 0
    for start, end, kind, value in entities(text):
        if (kind, value) not in cache:
            cache[kind, value] = renamed(value, key, later) if kind == "name" else surrogate(key, kind, value, later.get((kind, value), 0))
        out += [text[at:start], cache[kind, value] if kind == "name" else styled(kind, text[start:end], cache[kind, value])]
        at, n = end, n + 1
    return "".join([*out, text[at:]]), n


def entity_table(df: DataFrame, text: str) -> DataFrame:
    """(kind, value) of all different entities of all texts, of names their parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            met = {u for t in part.column("text").to_pylist() if t for _, _, kind, value in entities(t) for u in units(kind, value)}
            if met:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*sorted(met), strict=True)], ["kind", "value"])

    return df.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "kind string, value string").distinct()


def assigned(known: DataFrame, key: bytes, avoid_rounds: int = 40) -> DataFrame:
    """(kind, value, attempt, new): a surrogate for every entity, different ones for different entities of a kind.

    Each round draws surrogates for the entities still open, drops those that another entity holds already or that
    several would share (the first one by value keeps it), those that equal their own entity, and in the first
    ``avoid_rounds`` rounds those that are another entity of the corpus. What is left is drawn anew; all but names are
    permutations of their format, so that clashes are rare and the rounds few. A format of which the corpus holds a
    share p reaches the last of these rounds with chance p^avoid_rounds for an entity; only then may a surrogate be
    another real one.
    """
    tasks = known.sparkSession.sparkContext.defaultParallelism

    def draw(attempt: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                new = [surrogate(key, k, v, attempt) for k, v in zip(b.column("kind").to_pylist(), b.column("value").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([b.column("kind"), b.column("value"), pa.array([attempt] * len(new), pa.int32()), pa.array(new, pa.string())], ["kind", "value", "attempt", "new"])

        return run

    done, left, attempt = None, known, 0
    while True:
        drawn = written(left.repartition(tasks, "kind", "value").mapInArrow(draw(attempt), "kind string, value string, attempt int, new string"), "drawn")
        kept = drawn.where(F.col("new") != F.col("value")).groupBy("kind", "new").agg(F.min("value").alias("value"), F.min("attempt").alias("attempt")).select("kind", "value", "attempt", "new")
        if attempt < avoid_rounds:
            kept = kept.join(known.select("kind", F.col("value").alias("new")), ["kind", "new"], "left_anti")
        if done is not None:
            kept = kept.join(done.select("kind", "new"), ["kind", "new"], "left_anti")
        kept = written(kept.select("kind", "value", "attempt", "new"), "kept")
        done = kept if done is None else done.union(kept)
        left = written(drawn.select("kind", "value").join(kept.select("kind", "value"), ["kind", "value"], "left_anti"), "left")
        attempt += 1
        if left.isEmpty():
            return done


def replace_entities(df: DataFrame, key: str, text: str = "text", count: str | None = "n_entities", few: int = 20_000) -> DataFrame:
    """All columns of ``df`` with the entities of the text replaced, and the number of them as ``count`` (None: left out).

    E-mail and IP addresses, phone, card, social-security and bank account numbers and names after a form of address
    get surrogates of their type: digits, letters and separators stay in place, cards and accounts get right check digits,
    private addresses private, names keep gender, script, number of words, apostrophes, hyphens and capitals. With one
    ``key`` an entity has the same surrogate in all texts, and different entities of a type have different ones. Names
    are replaced word by word, the last word as surname: a surname has one surrogate alone and after given names, for
    either gender, and different surnames (or given names of a gender) have different ones. Initials become other
    initials, which several may share. A name ends after three words, at a lower-case word or before another form of
    address.

    All else in a text stays as it is. Null texts stay null with count 0, empty ones empty; repeated rows get equal
    results. Surrogates are computed in place; only entities that had a collision need a lookup, which is sent to all
    tasks while they number at most ``few`` and is otherwise joined by a hash of the text. A column named like the
    count is replaced.
    """
    secret = key.encode()
    known = written(entity_table(df, text), "entities")
    later = written(assigned(known, secret).where("attempt > 0").select("kind", "value", "attempt"), "later")
    many = later.count() > few
    lookup = {} if many else {(r.kind, r.value): r.attempt for r in later.collect()}
    kept = [f for f in df.schema.fields if f.name != count]
    names = [f.name for f in kept]
    schema = T.StructType([*kept, *([T.StructField(count, T.LongType())] if count else [])])
    source = df.select(*[F.col(f"`{n}`") for n in names])
    if many:
        own = df.select(F.col(f"`{text}`").alias("text"), F.xxhash64(text).alias("__digest")).where("text is not null").dropDuplicates(["__digest"])

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in chunks(batches, "text"):
                rows = [
                    (d, kind, value)
                    for d, t in zip(part.column("__digest").to_pylist(), part.column("text").to_pylist(), strict=True)
                    for kind, value in {u for e in entities(t) for u in units(*e[2:])}
                ]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["__digest", "kind", "value"])

        met = own.mapInArrow(each, "__digest long, kind string, value string").join(later, ["kind", "value"])
        met = met.groupBy("__digest").agg(F.collect_list(F.struct("kind", "value", "attempt")).alias("__later"))
        source = source.withColumn("__digest", F.xxhash64(text)).join(met, "__digest", "left").drop("__digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for part in chunks(batches, text):
            new, n = [], []
            extra = part.column("__later").to_pylist() if many else [None] * part.num_rows
            for t, e in zip(part.column(text).to_pylist(), extra, strict=True):
                if len(cache) > 200_000:
                    cache.clear()
                own = {(x["kind"], x["value"]): x["attempt"] for x in e} if e else lookup
                changed, found = replaced(t, secret, own, {} if many else cache) if t else (t, 0)
                new.append(changed)
                n.append(found)
            columns = [pa.array(new, part.schema.field(text).type) if c == text else part.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, *([pa.array(n, pa.int64())] if count else [])], [*names, *([count] if count else [])])

    return source.mapInArrow(run, schema)
