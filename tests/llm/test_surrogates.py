"""What the surrogate operator finds: neighbours of rejected matches, texts that the filter lets through, names."""

from __future__ import annotations

import random
import re

import pytest

from rollscore.llm.pii import ENTITY, MAYBE, TITLES, entities, luhn, replace_entities, units

CARD = "4111111111111111"
SPACED = "4111 1111 1111 1111"


@pytest.mark.parametrize(
    ("text", "held"),
    [
        (f"pay {CARD} 25 now", [("card", CARD)]),
        (f"pay 25 {CARD} now", [("card", CARD)]),
        (f"pay {CARD}-12/25", [("card", CARD)]),
        (f"on 2024-05-01 {SPACED}.", [("card", SPACED)]),
        ("call 555-123-4567 2024-05-01", [("phone", "555-123-4567")]),
        (f"call 555-123-4567 {SPACED} 7", [("phone", "555-123-4567"), ("card", SPACED)]),
        ("+1 555 123 4567 2024 05 01", [("phone", "+1 555 123 4567 2024")]),
        ("row 1234 078-05-1120", [("ssn", "078-05-1120")]),
        ("Miss my Mr Jones", [("name", "Jones")]),
        ("Mr John and Mrs Smith", [("name", "John"), ("name", "Smith")]),
        ("Mr Jones Mrs. Smith", [("name", "Jones"), ("name", "Smith")]),
        ("nothing 1234567890123456 or 1234567890123456 25 or +1234567890123456789", []),
    ],
)
def test_neighbours_of_a_rejected_match(text, held):
    assert [(k, text[a:b]) for a, b, k, _ in entities(text)] == held


def test_cards_and_phones_between_numbers():
    rng = random.Random(4)
    for _ in range(2000):
        body = rng.choice("3456") + "".join(rng.choices("0123456789", k=14))
        card, phone = body + str(luhn(body)), f"{rng.randrange(200, 999)}-555-{rng.randrange(1000, 9999)}"
        shown = rng.choice([card, " ".join(card[i : i + 4] for i in range(0, 16, 4))])
        text = f"at {shown} {rng.randrange(100)} by {phone} {rng.choice(['2024-05-01', '17', shown])} end"
        found = [(k, v) for _, _, k, v in entities(text)]
        assert ("phone", phone.replace("-", "")) in found, text
        assert found[0] == ("card", card), text


def test_filter_passes_every_text_with_an_entity():
    for text in ("resolver 8.8.8.8 or 1.1.1.1 is used", " ".join(CARD), "-".join(CARD), f"x {' '.join(CARD)} y"):
        assert ENTITY.search(text) and MAYBE.search(text) and list(entities(text)), text
    rng = random.Random(5)
    titles = [t for v in TITLES.values() for t in v]
    pieces = ["1", "4", "8", "0", "8.8", "1-1", "4 1", "12", ".", "-", " ", "+", "(", ")", "@", "a.b", "DE", "Xy", "é", "_", *titles]
    met = 0
    for _ in range(100_000):
        text = "".join(rng.choices(pieces, k=rng.randrange(1, 14)))
        if ENTITY.search(text):
            met += 1
            assert MAYBE.search(text), text
    for _ in range(20_000):
        text = "".join(rng.choice("0123456789") + rng.choice([" ", "-", ".", ". ", ""]) for _ in range(rng.randrange(4, 20)))
        if ENTITY.search(text):
            met += 1
            assert MAYBE.search(text), text
    assert met > 1000


@pytest.mark.parametrize(
    "name", ["O'Brien", "D’Angelo", "d'Angelo", "Smith-Jones", "Anne-Marie Jones", "J. R. Smith", "J Smith", "John F. Smith", "SMITH", "Анна-Мария Иванова"]
)
def test_names_are_found_whole(name):
    for text in (f"to Ms {name}, now", f"to Mr. {name}'s house", f"to Mrs {name} went"):
        assert [(k, text[a:b]) for a, b, k, _ in entities(text)] == [("name", name)]


def test_short_and_full_names_agree(spark):
    texts = [
        "Mr John Smith|Mr Smith|Mrs Smith-Jones|Ms Anne-Marie Jones|Mr J. Smith|Mr SMITH|Ms Jones|Mrs Anne Smith|Mr Smith's",
        "Mr O'Brien|Mr O’Brien|Mr Pat O'Brien|Mr Brien",
        "|".join(f"Mr {a}{b} Name{c}" for a in "BCDFGH" for b in ("en", "al", "or", "im", "um") for c in "abcd"),
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for few in (20_000, -1):
        rows = {r.doc_id: r for r in replace_entities(df, "k", few=few).collect()}
        assert [rows[i].n_entities for i in range(3)] == [9, 4, 120]
        got = [x.split(" ", 1)[1] for x in rows[0].text.split("|")]
        smith, jones = got[1], got[6]
        given, surname = got[0].split(" ")
        assert surname == smith != jones and given not in (smith, "John") and got[2] == f"{smith}-{jones}"
        assert re.fullmatch(rf"[A-Z][a-z]+-[A-Z][a-z]+ {jones}", got[3]) and got[7] == f"{got[3].split('-')[0]} {smith}"
        assert re.fullmatch(rf"[A-IK-Z]\. {smith}", got[4]) and got[5] == smith.upper() and got[8] == f"{smith}'s"
        plain, curly, full, bare = (x.split(" ", 1)[1] for x in rows[1].text.split("|"))
        assert curly == plain.replace("'", "’") and full.endswith(" " + plain) and plain.endswith("'" + bare) and "Brien" not in plain
        assert len(set(rows[2].text.split("|"))) == 120


@pytest.mark.parametrize(
    ("text", "held"),
    [
        ("SKU AB12CDEF3456 and part XX99 ABCD 1234", []),
        ("to DE89 3704 0044 0532 0130 00 please", [("iban", "DE89 3704 0044 0532 0130 00")]),
        ("to GB82WEST12345698765432.", [("iban", "GB82WEST12345698765432")]),
        ("to NO93 8601 1117 947 ABCD", [("iban", "NO93 8601 1117 947")]),
        ("wrong DE88 3704 0044 0532 0130 00", []),
        ("short DE89 3704 0044", []),
        ("mail jörg@müller.de or иван@почта.рф now", [("email", "jörg@müller.de"), ("email", "иван@почта.рф")]),
        ("Dr. Jane Roe met Prof. Dr. Li and Г-н Иванов", [("name", "Jane Roe"), ("name", "Li"), ("name", "Иванов")]),
        ("Herr Dr. Huber", [("name", "Huber")]),
    ],
)
def test_accounts_addresses_and_titles(text, held):
    assert [(k, text[a:b]) for a, b, k, _ in entities(text)] == held


def test_gender_after_a_title_without_one():
    gender = lambda t: next(entities(t))[3].partition(":")[0]
    assert [gender(t) for t in ("Dr. Anna Roe", "Prof. Paul Roe", "Dr. Roe", "Mrs Paul", "Г-жа Ли")] == ["female", "male", "neutral", "female", "female"]


def test_no_surrogate_is_real(spark):
    texts = [f"mail {c}@x.de or {c}{c}@x.de" for c in "abcdefghijklmnopqrstuvwxyz0123456789"]
    texts += [f"pay DE{98 - int(f'{n:018d}131400') % 97:02d}{n:018d} now" for n in range(20)]
    texts += [f"Mr {g} Roe, Dr. {g} Li" for g in "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas".split()]
    texts += ["write jörg@müller.de", "write JÖRG@müller.de", "write иван@почта.рф"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    new = {r.doc_id: r.text for r in replace_entities(df, "key").collect()}
    forms = lambda t: [(k, u.rpartition(":")[2]) for _, _, kind, v in entities(t) for k, u in units(kind, v)]
    real = {f for t in texts for f in forms(t)}
    drawn = {}
    for i, t in enumerate(texts):
        before, after = forms(t), forms(new[i])
        assert [k for k, _ in before] == [k for k, _ in after], (t, new[i])
        for (kind, a), (_, b) in zip(before, after, strict=True):
            if kind not in ("given", "surname"):
                assert (kind, b) not in real, (t, new[i])
                assert drawn.setdefault((kind, a), b) == b
    assert len(set(drawn.values())) == len(drawn)
    assert new[len(texts) - 2].lower() == new[len(texts) - 3].lower()
