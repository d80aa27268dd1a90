"""The operators against brute force, the public library or planted cases, with nulls, copies and clashing columns."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from rollscore.llm import language, quality, toxicity
from rollscore.llm.contamination import find_leaks
from rollscore.llm.jaccard import near_copies
from rollscore.llm.pieces import Vocabulary, cut, decode, encode
from rollscore.llm.pii import entities, luhn, replace_entities
from rollscore.llm.queries import ORACLES, QUERIES
from rollscore.llm.secrets import scan_secrets
from rollscore.llm.urls import match_rules
from rollscore.llm.vectors import near_vectors

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
ODD = [None, "", " ", "\n\t", "x", "Ünï cödé ▁ \x00 end", "a" * 70, "word " * 5000]


@pytest.fixture(scope="module")
def texts(sf_dir):
    import pandas as pd

    rng = random.Random(1)
    real = pd.read_parquet(f"{sf_dir}/documents.parquet").text.tolist()
    edited = []
    for t in real[:60]:
        words = t.split(" ")
        for _ in range(3):
            w = list(words)
            for _ in range(rng.choice([1, len(w) // 60 + 1, len(w) // 20 + 1])):
                w[rng.randrange(len(w))] = "changed"
            edited.append(" ".join(w))
    return real + edited + real[:5] + ODD + ODD


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "x", 1, "y") for i, t in enumerate(texts)] + [(None, texts[0], "x", 1, "y")]
    return spark.createDataFrame(rows, "doc_id long, text string, host string, n int, `class` string").repartition(5)


def shingled(text, width, words):
    w = words(text or "")
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def groups(n, links):
    root = list(range(n))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((top(a), top(b)))
        root[y] = x
    return [top(x) for x in range(n)]


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80)])
def test_jaccard(docs, texts, width, percent):
    lower = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    sets = [shingled(t, width, lower) for t in texts]
    links = [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    own = groups(len(sets), links)
    got = near_copies(docs, width=width, percent=percent).collect()
    assert len(got) == len(texts) + 1
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == {
        (i, len(s), own[i]) for i, s in enumerate(sets)
    }
    assert [r.component_id for r in got if r.doc_id is None] == [None]


def test_leaks(spark, docs, texts):
    bare = lambda t: [x for x in (re.sub(r"\A[\W_]+|[\W_]+\Z", "", w).lower() for w in re.split(r"[\x20\x09-\x0D]+", t)) if x]
    items = [" ".join(texts[i].split()[a : a + n]) for i, a, n in ((2, 3, 40), (9, 0, 12), (20, 5, 5), (33, 2, 90), (40, 7, 30))]
    items += [None, "", "only four words here"]
    table = spark.createDataFrame(list(enumerate(items)) + [(None, "a b c d e f")], "item_id long, text string")
    wanted = {}
    for i, t in enumerate(texts):
        own = shingled(t, 5, bare)
        sets = [(k, shingled(x, 5, bare)) for k, x in enumerate(items)]
        wanted[i] = [k for k, s in sets if s and len(s & own) >= 0.8 * len(s)]
    got = {r.doc_id: r.leaked_items for r in find_leaks(docs, table).where("doc_id is not null").collect()}
    assert got == wanted and any(wanted.values())
    assert find_leaks(docs, table.limit(0)).where(F.size("leaked_items") > 0).isEmpty()


def test_vectors(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(40, 16))
    x = np.concatenate([base, base + rng.normal(size=base.shape) * 0.15, base[:5], base[:1] * 3]).astype(np.float32)
    label = [i % 2 for i in range(len(x))]
    rows = [(i, v.tolist(), k) for i, (v, k) in enumerate(zip(x, label, strict=True))]
    odd = [(900, None, 0), (901, [0.0] * 16, 0), (902, [float("nan")] * 16, 1), (903, [None] * 16, 1), (904, [1.0], 0), (905, x[0].tolist(), None), (None, x[0].tolist(), 0)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int")
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.93) & (np.array(label)[:, None] == np.array(label)) & ~np.eye(len(x), dtype=bool)
    own = groups(len(x), list(zip(*np.nonzero(near), strict=True)))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(df).collect()}
    assert {k: got[k] for k in range(len(x))} == {i: (int(near[i].sum()), own[i], own[i] == i) for i in range(len(x))}
    assert all(got[k] == (0, k, True) for k in range(900, 906)) and got[None] == (0, None, False)
    assert near_vectors(df.limit(0)).isEmpty()


def test_pieces(spark, docs, texts):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    vocabulary = Vocabulary.load(MODEL)
    coded = encode(docs, vocabulary, frequent=50)
    got = {r.doc_id: r for r in coded.where("doc_id is not null").collect()}
    for i, t in enumerate(texts):
        assert got[i].ids == (None if t is None else model.encode(t)), i
        assert got[i].round_trip == (None if t is None else "▁" not in t)
    back = {r.doc_id: r.decoded for r in decode(coded, vocabulary).where("doc_id is not null").collect()}
    assert all(back[i] == (t if t is None else t.replace("▁", " ")) for i, t in enumerate(texts))
    assert encode(docs.limit(0), vocabulary).isEmpty()


def test_best_path(spark):
    pieces = {"a": -2.0, "b": -2.5, "ab": -3.0, "abc": -9.0, "c": -1.0, "bc": -2.2, "▁": -1.0, "▁a": -1.5}
    vocabulary = Vocabulary([(p, i, s) for i, (p, s) in enumerate(pieces.items())], None, 99, "unigram")
    words = ["▁abc", "abcab", "▁", "axb", "▁abab" * 20]

    def best(w):
        state = [(0.0, [])]
        for e in range(1, len(w) + 1):
            options = [(state[s][0] + pieces[w[s:e]], state[s][1] + [e]) for s in range(e) if w[s:e] in pieces]
            state.append(max(options or [(state[e - 1][0] - 19, state[e - 1][1] + [e])], key=lambda o: o[0]))
        return state[-1][1]

    df = spark.createDataFrame([(w, 1) for w in words], "word string, blocks long").repartition("word")
    for r in cut(df, vocabulary).collect():
        at = [i for i in range(1, len(r.word) + 1) if r.cuts[i // 62] >> i % 62 & 1]
        assert at == best(r.word), r.word


def test_surrogates(spark):
    card = "453201511283036"
    card += str(luhn(card))
    text = f"Mail Ann.Lee7@corp.example.com or +1 (583) 555-6359, card {card}, at 10.1.2.3; Mrs Anna Berg met Mr Otto Weiss."
    other = f"again ann.lee7@corp.example.com and 5835556359 4532 1234 {card[:4]} {card[4:8]} {card[8:12]} {card[12:]}!"
    rows = [(1, text, 5), (2, other, 5), (3, None, 5), (4, "", 5), (5, "nothing here: 1234567890123456", 5), (1, text, 5)]
    df = spark.createDataFrame(rows, "doc_id int, text string, n_entities int")
    for few in (20_000, -1):
        got = [r.text for r in replace_entities(df, "k", few=few).orderBy("doc_id").collect()]
        first, second = got[0], got[2]
        assert got[0] == got[1] and got[3:] == [None, "", rows[4][1]]
        found = {k: v for _, _, k, v in entities(first)}
        assert set(found) == {"email", "phone", "card", "ip", "name"} and found["email"] in second.lower()
        assert all(x not in first for x in ("Ann.Lee", "555-6359", card, "10.1.2.3", "Berg", "Weiss"))
        assert found["card"] in re.sub(r"\D", "", second) and luhn(found["card"][:-1]) == int(found["card"][-1])
        assert found["ip"].split(".")[0] in ("10", "127", "172", "192")
        assert re.fullmatch(r"Mail [A-Z][a-z]{2}\.[A-Z][a-z]{2}\d@[a-z]{4}\.[a-z]{7}\.com or \+1 \(\d{3}\) \d{3}-\d{4}, .*", first)


def test_surrogates_stay_distinct(spark):
    rows = [(i, f"Mr Max Name{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyzabcd'[i // 100]} wrote u{i}@a.org") for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    got = [r.text for r in replace_entities(df, "k").collect()]
    assert len({g.split(" wrote ")[1] for g in got}) == 1000 and len({g.split(" wrote ")[0] for g in got}) == 1000


def test_secrets(spark, docs, texts):
    rng = random.Random(3)
    strong = "Zk3Qx9LmT7vRb2WcY8nHs5PfJ4dGa6KeU1oXi0Bt"
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    strings = ["".join(rng.choices(alphabet, k=40)) for _ in range(300)]
    even = ["Aa1" * 13 + "b" for _ in range(300)]
    more = [f"{x} {y}" for x, y in zip(strings, even, strict=True)] + [f'é Password = "{strong}" x', "token: short", "password: api_key: longvalue123", "AKIAABCDEFGHIJKL1 AKIA123", "0" * 31 + " " + "af" * 20, f"key {strong} {'a1' * 20}"]
    rows = list(enumerate(texts + more))
    got = scan_secrets(docs.sparkSession.createDataFrame(rows, "doc_id int, text string").withColumn("findings", F.lit(1)))
    pattern = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")

    def base(t):
        out = [(m.start(), 0, m.end()) for m in pattern.finditer(t) if len(m[2]) >= 8]
        out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
        return [(("assign", "access", "hex")[k], a, b) for a, k, b in sorted(out)]

    found = {r.doc_id: [tuple(x) for x in r.findings] for r in got.collect()}
    assert {i: [x for x in f if x[0] != "random"] for i, f in found.items()} == {i: base(t or "") for i, t in rows}
    drawn = [found[len(texts) + i] for i in range(300)]
    assert sum(("random", 0, 40) in f for f in drawn) > 240 and not any(("random", 41, 81) in f for f in drawn)


def test_urls(spark):
    rules = [("org", "/", "allow"), ("b.org", "/es/", "block"), ("b.org", "/es/1", "allow"), ("com", "/de/", "block"), ("com", "/de/", "allow"), (None, "/", "block"), ("", "/any", "block")]
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    urls = [None, "", "no scheme", "http://A.B.org/es/1?x#y", "http://b.org/es/2", "http://xb.org/es/2", "http://b.org", "https://q.com/de/", "x://com/de/?", "ftp://net/anything", "a://b://c/d"] * 2
    df = spark.createDataFrame([(i, u, "old") for i, u in enumerate(urls)], "page_id int, url string, rule string")
    usable = [(h, p, "block" if (h, p) == ("com", "/de/") else v) for h, p, v in rules if h is not None]
    for r in match_rules(df, table).collect():
        rest = r.url.split("://", 1)[1] if r.url and "://" in r.url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.lower()
        fits = [(len(h + p), h + p, v) for h, p, v in usable if (not h or host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, *(max(fits)[1:] if fits else (None, "allow")))
    assert match_rules(df, table.limit(0)).where("verdict = 'allow' and rule is null").count() == len(urls)
    assert match_rules(df.limit(0), table).isEmpty()


def test_classifiers(spark, sf_dir, docs):
    folder = sf_dir.replace("sf0.001", "sf0.01")
    known = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id", "left")
    lang = QUERIES["op1_language"](spark, folder).join(known, "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert lang > 0.95
    for name, label, least in (("op8_toxicity", "toxic", 0.9), ("op10_quality", "quality", 0.9)):
        rows = QUERIES[name](spark, folder).join(known, "doc_id").where(F.col("held_out") & F.col(label).isNotNull())
        assert rows.agg(F.avg((F.col(label) == F.col("predicted")).cast("int"))).first()[0] > least
    nothing = docs.sparkSession.createDataFrame([], "doc_id long, text string, lang string, toxic int, quality int")
    for module in (toxicity, quality):
        scored = module.score(docs, module.train(nothing, nothing))
        assert scored.where("score <> 0 or predicted <> 0").isEmpty() and scored.count() == docs.count()
    und = language.predict(docs, language.train(nothing))
    assert und.where("lang_pred <> 'und'").isEmpty() and und.count() == docs.count()
    net = language.train(spark.read.parquet(f"{folder}/documents.parquet"), per_class=50)
    got = {r.doc_id: r.lang_pred for r in language.predict(docs, net).where("text is null or text rlike '^\\\\s*$'").collect()}
    assert set(got.values()) == {"und"}


def test_url_sql(spark, duck, sf_dir):
    got = QUERIES["op6_url_rules"](spark, sf_dir).collect()
    want = duck.execute(ORACLES["op6_url_rules"]).fetchall()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_base_digest(spark, sf_dir):
    r = QUERIES["op4_secrets"](spark, sf_dir).where("n_assign + n_access + n_hex = 0").first()
    assert r.base_sha256 == hashlib.sha256(b"").hexdigest()
