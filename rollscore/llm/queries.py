"""The registered queries, one for each operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language, quality, toxicity
from .common import held_out, table
from .contamination import find_leaks
from .jaccard import near_copies
from .middle import fill_in_middle, restored
from .mixing import mix_sources
from .pieces import Vocabulary, encode
from .pii import replace_entities
from .registry import ORACLES, QUERIES, query
from .secrets import scan_secrets
from .spelling import group_variants
from .urls import match_rules
from .vectors import near_vectors

__all__ = ["ORACLES", "QUERIES"]

URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"

#: Of the registered query; a job brings its own.
PII_KEY = "surrogate-key"


@query("op1_language")
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held = held_out("doc_id", 3, 1)
    net = language.train(docs.where(language.learnable(held)))
    return language.predict(docs.select("doc_id", "text", held.alias("held_out")), net).drop("text")


@query("op2_surrogates")
def op2_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return replace_entities(docs, PII_KEY).select("doc_id", "n_entities", "text")


@query("op3_vectors")
def op3_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


@query("op4_secrets")
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents", "doc_id", "text"))

    def count(kind: str):
        return F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long")

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])))

    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined(F.filter("findings", lambda x: x["kind"] != "random")).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("findings")).alias("spans"),
        count("random").alias("n_random"),
    )


@query(
    "op6_url_rules",
    """
    WITH rules(rule_host, rule_path, rule_verdict) AS (
      VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
             ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
    rest AS (
      SELECT page_id, row_number() OVER () AS nr,
             CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
      FROM pages),
    cut AS (
      SELECT page_id, nr, regexp_extract(rest, '^[^/?#]*') AS raw_host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
      FROM rest),
    named AS (
      SELECT page_id, nr, path,
             translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
      FROM cut),
    fits AS (
      SELECT nr, rule_host || rule_path AS rule, rule_verdict,
             row_number() OVER (PARTITION BY nr ORDER BY length(rule_host || rule_path) DESC) AS place
      FROM named JOIN rules
      ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
    SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict
    FROM named LEFT JOIN fits ON named.nr = fits.nr AND place = 1
    """,
)
def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    return match_rules(table(spark, sf_dir, "pages", "page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


@query("op7_jaccard")
def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents", "doc_id", "text"))


def labelled(spark: SparkSession, sf_dir: str, label: str, divisor: int, remainder: int, *metadata: str) -> tuple[DataFrame, DataFrame]:
    """Documents, and the labels that may be learned from."""
    labels = table(spark, sf_dir, "labels", "doc_id", label)
    return table(spark, sf_dir, "documents", "doc_id", "text", *metadata), labels.where(
        language.learnable(held_out("doc_id", divisor, remainder))
    )


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = labelled(spark, sf_dir, "toxic", 4, 2)
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    return scored.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", "predicted")


@query("op10_quality")
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = ("n_chars",)
    docs, labels = labelled(spark, sf_dir, "quality", 3, 1, *known)
    scored = quality.score(docs, quality.train(docs, labels, metadata=known), metadata=known)
    return scored.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", "predicted")


@query("op9_leaks")
def op9_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = find_leaks(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select("doc_id", (F.size("leaked_items") > 0).alias("contaminated"), F.col("leaked_items").alias("items"))


@query("op5_pieces")
def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents", "doc_id", "text"), Vocabulary.load(PIECE_MODEL))


@query(
    "op13_middle",
    """
    WITH own AS (
      SELECT row_number() OVER () AS nr, doc_id, coalesce(text, '') AS text,
             regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
             sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
      FROM documents),
    drawn AS (
      SELECT nr, doc_id, text, units, len(units) AS n,
             CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(units) + 1) AS r1,
             CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(units) + 1) AS r2,
             CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS r3,
             CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS r4
      FROM own),
    cut AS (
      SELECT nr, doc_id, text, n,
             CASE WHEN text = '' OR text LIKE '%<P>%' OR text LIKE '%<S>%' OR text LIKE '%<M>%' OR r3 >= 90 THEN 'plain'
                  WHEN r4 < 20 THEN 'spm' ELSE 'psm' END AS form,
             array_to_string(units[1:least(r1, r2)], '') AS prefix,
             array_to_string(units[least(r1, r2) + 1:greatest(r1, r2)], '') AS middle,
             array_to_string(units[greatest(r1, r2) + 1:], '') AS suffix
      FROM drawn)
    SELECT doc_id, n, form,
           CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                  ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM cut
    """,
)
def op13_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_in_middle(table(spark, sf_dir, "documents", "doc_id", "text"))

    def digest(text):
        return F.sha2(text.cast("binary"), 256)

    return cut.select(
        "doc_id",
        F.col("n_units").alias("n"),
        "form",
        "prefix_chars",
        "middle_chars",
        digest(F.col("fim_text")).alias("output_sha256"),
        digest(restored("fim_text", "form")).alias("restored_sha256"),
    )


@query(
    "op12_mix",
    r"""
    WITH items AS (
      SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, count(*) AS copies
      FROM documents GROUP BY ALL),
    src AS (
      SELECT source, sum(size * copies)::HUGEINT AS source_size, sum(copies) AS rows,
             row_number() OVER (ORDER BY source NULLS LAST) AS number
      FROM items GROUP BY source),
    weighed AS (
      SELECT *, source_size * 200 AS cap, ([5, 2, 1])[(number - 1) % 3 + 1] AS weight FROM src),
    filled AS (
      SELECT *, sum(source_size) OVER () * 150 AS wish, sum(cap) OVER () AS caps, row_number() OVER o AS nth,
             coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
             sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
      FROM weighed WINDOW o AS (ORDER BY source_size * 10 // weight, number)),
    level AS (
      SELECT min(nth) AS nth, arg_min(wish - before, nth) AS words, arg_min(weights, nth) AS weights
      FROM filled WHERE (wish - before) * weight < cap * weights),
    aimed AS (
      SELECT f.*, CASE WHEN l.nth IS NULL OR f.nth < l.nth THEN cap::DOUBLE / 100
                       ELSE (l.words * weight)::DOUBLE / (l.weights * 100)::DOUBLE END AS target
      FROM filled f CROSS JOIN level l),
    blocked AS (
      SELECT *, greatest(1, least(1024, floor(coalesce(min(CASE WHEN target > 0 THEN target END) OVER () / 256, 1))))::BIGINT AS block
      FROM aimed),
    seated AS (SELECT *, ((2 * least(wish, caps) + 100 * block) // (200 * block))::BIGINT AS seats FROM blocked),
    source_places AS (
      SELECT number, row_number() OVER (ORDER BY target / (2 * k - 1) DESC, number, k) <= seats AS won
      FROM (SELECT *, unnest(range(1, (2 * source_size // block + 3)::BIGINT)) AS k FROM seated WHERE target > 0)),
    quota AS (SELECT number, count(*) FILTER (won) AS blocks FROM source_places GROUP BY number),
    parts AS (
      SELECT *, least(4096, copies - part * 4096) AS n,
             ('0x' || substr(md5('1:' || coalesce(doc_id::VARCHAR, '') || ':' || part), 1, 15))::BIGINT AS place
      FROM (SELECT *, unnest(range(0, (copies - 1) // 4096 + 1)) AS part FROM items)),
    lined AS (
      SELECT p.*, s.number, s.source_size, s.target, s.block, p.place % ceil(s.rows / 100000)::BIGINT AS shard
      FROM parts p JOIN seated s ON p.source IS NOT DISTINCT FROM s.source),
    shards AS (
      SELECT number, shard, sum(size * n)::BIGINT AS words,
             CASE WHEN sum(size * n) = 0 THEN 0 ELSE greatest(1, (2 * sum(size * n) + block) // (2 * block)) END::BIGINT AS m
      FROM lined GROUP BY number, shard, block),
    shard_places AS (
      SELECT number, shard, row_number() OVER (PARTITION BY number ORDER BY m / (2 * k - 1) DESC, shard, k) <= least(blocks, capacity) AS won
      FROM (SELECT s.*, q.blocks, sum(m) OVER (PARTITION BY s.number) * 2 AS capacity, unnest(range(1, 2 * m + 2)) AS k
            FROM shards s JOIN quota q ON s.number = q.number)),
    shard_quota AS (SELECT number, shard, count(*) FILTER (won) AS quota FROM shard_places GROUP BY number, shard),
    runs AS (
      SELECT s.number, s.shard, words, m, coalesce(quota, 0) AS quota,
             ('0x' || substr(md5('1:run:' || s.number || ':' || s.shard), 1, 15))::BIGINT % greatest(m, 1) AS first
      FROM shards s LEFT JOIN shard_quota q ON s.number = q.number AND s.shard = q.shard),
    bounds AS (
      SELECT number, shard, words, CASE WHEN m = 0 THEN 0 ELSE quota // m END AS passes,
             CASE WHEN m = 0 THEN 0 ELSE first * words // m END AS a,
             CASE WHEN m = 0 THEN 0 WHEN first + quota % m <= m THEN (first + quota % m) * words // m
                  ELSE words + (first + quota % m - m) * words // m END AS b
      FROM runs),
    laid AS (
      SELECT *, sum(size * n) OVER (PARTITION BY number, shard ORDER BY place, doc_id NULLS FIRST, part, size
                                    ROWS UNBOUNDED PRECEDING) - size * n AS base FROM lined),
    each AS (SELECT *, base + copy * size AS pos FROM (SELECT *, unnest(range(0, n)) AS copy FROM laid))
    SELECT doc_id, size, source_size::BIGINT AS source_size, target,
           (passes * size + greatest(0, least(b, pos + size) - greatest(a, pos))
            + greatest(0, least(b, pos + words + size) - greatest(a, pos + words)))::BIGINT AS taken
    FROM each JOIN bounds ON each.number = bounds.number AND each.shard = bounds.shard
    """,
)
def op12_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents", "doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op11_spelling")
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(table(spark, sf_dir, "documents", "doc_id", "text"), damage=199)
