"""Registered queries: prompts, chats, tokens, requests, evaluation documents and scalar helpers."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.answers import gold_letter
from ..functions.keys import build_task_key, checkpoint_dir, param_count, parse_task_key, step_revision
from ..functions.text import count_substring, ngrams, py_split, py_strip
from ..operators import shaping as S
from ..operators.evaldocs import GPQA_PROMPT, TASK_COLUMNS, eval_docs_union, gpqa_docs
from ..operators.filters import doc_counts, limit_docs, save_step_filter, unique_docs
from ..operators.mapping import external_step, map_rows, resumable_step
from ..operators.packing import pack_whole
from ..operators.permutation import epoch_ordinal, epoch_position
from ..operators.registry import add_rewards, register
from ..operators.skew import running_total
from ..operators.sweeps import seeded_shuffle
from ..session import fresh_path
from ..sources.tables import read_table
from . import inputs as I
from .jobs import generate, prepare_prompts
from .registry import query, r, rounded

WS_SQL = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13), chr(28), chr(29), chr(30), chr(31), chr(133), chr(160))"
TOKENS_SQL = (
    r"list_filter(regexp_split_to_array(text, "
    r"'[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+'), "
    r"lambda x: x <> '')"
)


def text_sql(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns as problem rows with the columns of a training set."""
    turns = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return turns.where(F.col("role") == "user").select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("row_id"),
        F.col("text").alias("problem"),
        F.concat(F.lit("so "), F.col("conv_id").cast("string")).alias("solution"),
        F.col("conv_id").cast("string").alias("answer"),
        F.concat(F.lit("Level "), (F.col("turn") % 5).cast("string")).alias("level"),
        F.array(S.message("user", "text")).alias("messages"),
    )


PROBLEMS_SQL = (
    "select conv_id * 100 + turn as row_id, text as problem, concat('so ', conv_id) as solution, "
    "cast(conv_id as varchar) as answer, concat('Level ', turn % 5) as level from conversations where role = 'user'"
)


@query(
    "make_conversation",
    f"""select row_id, 2::bigint as n_with, 1::bigint as n_without, 'system' as first_role, {text_sql(S.SYSTEM_PROMPT)} as system_text,
      problem as user_text, problem as plain_text, '' as empty_system from ({PROBLEMS_SQL})""",
)
def make_conversation_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.make_conversation(problems(spark, sf_dir), S.SYSTEM_PROMPT).withColumnRenamed("prompt", "with_system")
    rows = S.make_conversation(rows, "").withColumnRenamed("prompt", "with_empty")
    rows = S.make_conversation(rows)
    return rows.select(
        "row_id",
        F.size("with_system").cast("bigint").alias("n_with"),
        F.size("prompt").cast("bigint").alias("n_without"),
        F.col("with_system")[0]["role"].alias("first_role"),
        F.col("with_system")[0]["content"].alias("system_text"),
        F.col("with_system")[1]["content"].alias("user_text"),
        F.col("prompt")[0]["content"].alias("plain_text"),
        F.col("with_empty")[0]["content"].alias("empty_system"),
    )


@query("drop_messages", PROBLEMS_SQL)
def drop_messages_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.drop_messages(S.drop_messages(problems(spark, sf_dir)))


@query("prune_for_tokens", f"select row_id, length(problem) as n_chars from ({PROBLEMS_SQL})")
def prune_for_tokens_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.drop_messages(problems(spark, sf_dir)).withColumn("n_chars", F.length("problem").cast("bigint"))
    return S.prune_for_tokens(rows)


@query(
    "chat_render",
    """select conv_id, concat(coalesce(string_agg(concat('<|', role, '|>', chr(10), text, '</s>', chr(10)), '' order by turn)
      filter (where role in ('user', 'system', 'assistant')), ''), '<|assistant|>') as rendered from conversations group by conv_id""",
)
def chat_render_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return S.render_conversations(turns, generation_prompt=True)


@query("math_prompt", f"select row_id, replace({text_sql(S.MATH_PROMPT)}, '{{Question}}', problem) as query from ({PROBLEMS_SQL})")
def math_prompt_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return problems(spark, sf_dir).select("row_id", S.math_prompt("problem").alias("query"))


EVAL_DOCS_SQL = " union all ".join(
    f"select row_id, '{task}' as task_name, replace({text_sql(S.MATH_PROMPT)}, '{{Question}}', problem) as query, "
    f"{gold} as choice, 1::bigint as n_choices, 0 as gold_index, cast(null as varchar) as instruction from ({PROBLEMS_SQL})"
    for task, (_, gold) in TASK_COLUMNS.items()
)


@query("eval_docs", EVAL_DOCS_SQL)
def eval_docs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = problems(spark, sf_dir)
    inputs = {t: rows.withColumnRenamed("problem", q) if q != "problem" else rows for t, (q, _) in TASK_COLUMNS.items()}
    docs = eval_docs_union(inputs, keep=["row_id"])
    return docs.select(
        "row_id",
        "task_name",
        "query",
        F.col("choices")[0].alias("choice"),
        F.size("choices").cast("bigint").alias("n_choices"),
        "gold_index",
        "instruction",
    )


SLOT_SQL = "(instr('0123456789abcdef', substr(md5(concat('42:', p_partkey)), 1, 1)) - 1) % 4"
GPQA_SQL = text_sql(GPQA_PROMPT)
for _letter, _i in zip("ABCD", range(1, 5), strict=True):
    GPQA_SQL = f"replace({GPQA_SQL}, '{{{_letter}}}', options[{_i}])"


@query(
    "gpqa_docs",
    f"""with a as (
      select p_partkey, concat('Which brand makes ', p_name, '?') as question, p_brand,
        [p_type, concat('size ', p_size), concat('key ', p_partkey)] as wrong, cast({SLOT_SQL} as integer) as gold_index from part
    ), b as (select *, list_concat(list_concat(wrong[1:gold_index], [p_brand]), wrong[gold_index + 1:]) as options from a),
    c as (select *, replace({GPQA_SQL}, '{{Question}}', question) as query from b)
    select p_partkey, 'gpqa:diamond' as task_name, query, query as instruction, gold_index,
      substr('ABCD', gold_index + 1, 1) as gold, 4::bigint as n_choices from c""",
)
def gpqa_docs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    rows = part.select(
        "p_partkey",
        F.concat(F.lit("Which brand makes "), "p_name", F.lit("?")).alias("question"),
        "p_brand",
        F.col("p_type").alias("w1"),
        F.concat(F.lit("size "), F.col("p_size").cast("string")).alias("w2"),
        F.concat(F.lit("key "), F.col("p_partkey").cast("string")).alias("w3"),
    )
    docs = gpqa_docs(rows, "p_partkey", "question", "p_brand", ["w1", "w2", "w3"])
    return docs.select(
        "p_partkey",
        "task_name",
        "query",
        "instruction",
        "gold_index",
        gold_letter("gold_index").alias("gold"),
        F.size("choices").cast("bigint").alias("n_choices"),
    )


@query(
    "generation_requests",
    f"""select row_id, concat('Solve: ', problem, ' (100% $sure$)') as instruction,
      '{{"max_new_tokens":8192,"temperature":0.6}}' as params, '{{"max_new_tokens":8192}}' as default_params from ({PROBLEMS_SQL})""",
)
def generation_requests_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.generation_requests(problems(spark, sf_dir), "problem").withColumnRenamed("params", "default_params")
    rows = S.generation_requests(rows, "problem", "Solve: {{ instruction }} (100% $sure$)", temperature=0.6)
    return rows.select(
        "row_id", "instruction", F.to_json("params").alias("params"), F.to_json("default_params").alias("default_params")
    )


@query(
    "replicate_generations",
    "select o_orderkey, cast(g as integer) as gen_idx from orders, (select unnest(range(6)) as g)",
)
def replicate_generations_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.replicate_generations(read_table(spark, sf_dir, "orders", "o_orderkey"), 6)


@query(
    "request_batches",
    """with g as (select o_orderkey * 1000003 as request_id, cast(g as integer) as gen_idx from orders, (select unnest(range(2)) as g)),
    n as (select *, row_number() over (order by request_id, gen_idx) - 1 as pos from g)
    select request_id, gen_idx, pos // 64000 as load_unit, (pos % 64000) // 64 as batch from n""",
)
def request_batches_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders", "o_orderkey").select((F.col("o_orderkey") * 1000003).alias("request_id"))
    return S.request_batches(S.replicate_generations(orders, 2), "request_id", ("gen_idx",))


@query(
    "group_generations",
    f"""select prompt_id, count(*) as n, string_agg(content, '|' order by turn) as joined
    from ({I.COMPLETIONS_SQL}) group by prompt_id""",
)
def group_generations_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = S.group_generations(I.completions(spark, sf_dir), "prompt_id", "turn", "content")
    return grouped.select(
        "prompt_id",
        F.size("generations").cast("bigint").alias("n"),
        F.array_join("generations", "|").alias("joined"),
    )


@query(
    "truncate_prompt",
    f"""with t as (select doc_id, {TOKENS_SQL} as tokens from documents)
    select doc_id, least(len(tokens), 512) as n_ids, least(len(tokens), 512) as n_mask,
      md5(array_to_string(tokens[1:512], ' ')) as ids_md5 from t""",
)
def truncate_prompt_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", spread=True)
    rows = S.truncate_prompt(docs.select("doc_id", S.whitespace_tokens("text").alias("tokens")))
    return rows.select(
        "doc_id",
        F.size("input_ids").cast("bigint").alias("n_ids"),
        F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).cast("bigint").alias("n_mask"),
        F.md5(F.array_join("input_ids", " ")).alias("ids_md5"),
    )


@query(
    "left_pad_batch",
    f"""with t as (select doc_id, doc_id // 6 as batch_id, ({TOKENS_SQL})[1:512] as ids from documents),
    m as (select *, max(len(ids)) over (partition by batch_id) as longest from t)
    select doc_id, longest as n_padded, len(ids) as n_real,
      md5(array_to_string(list_concat(list_transform(range(longest - len(ids)), lambda i: '0'),
        list_transform(ids, lambda x: cast(length(x) as varchar))), ' ')) as padded_md5 from m""",
)
def left_pad_batch_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", spread=True)
    tokens = docs.select(
        "doc_id", F.floor(F.col("doc_id") / 6).alias("batch_id"), S.whitespace_tokens("text").alias("tokens")
    )
    ids = S.truncate_prompt(tokens).select(
        "doc_id", "batch_id", F.transform("input_ids", lambda w: F.length(w)).alias("ids")
    )
    padded = S.left_pad_batch(ids, "ids", ["batch_id"], F.lit(0))
    return padded.select(
        "doc_id",
        F.size("padded").cast("bigint").alias("n_padded"),
        F.aggregate("pad_mask", F.lit(0), lambda a, x: a + x).cast("bigint").alias("n_real"),
        F.md5(F.array_join("padded", " ")).alias("padded_md5"),
    )


@query(
    "pack_sequences",
    f"""with t as (select doc_id, unnest({TOKENS_SQL}) as tok, generate_subscripts({TOKENS_SQL}, 1) as i from documents),
    n as (select *, row_number() over (order by doc_id, i) - 1 as pos from t)
    select pos // 4096 as packed_row, count(*) as n_tokens, md5(string_agg(tok, ' ' order by pos)) as tokens_md5
    from n group by pos // 4096""",
)
def pack_sequences_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", spread=True)
    rows = docs.select((F.col("doc_id") * 1000003).alias("row_id"), S.whitespace_tokens("text").alias("tokens"))
    packed = S.pack_sequences(rows, "row_id")
    return packed.select(
        "packed_row",
        F.size("tokens").cast("bigint").alias("n_tokens"),
        F.md5(F.array_join("tokens", " ")).alias("tokens_md5"),
    )


@query(
    "pack_whole",
    f"""select doc_id, n as n_tokens, (n + 255) // 256 as n_pieces, n <= 256 as whole
    from (select doc_id, len({TOKENS_SQL}) as n from documents) where n > 0""",
)
def pack_whole_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In how many packed rows each document lies: one, unless it is longer than a row."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", spread=True)
    packed = pack_whole(docs.select("doc_id", S.whitespace_tokens("text").alias("tokens")), "doc_id", length=256)
    places = packed.select("packed_row", F.explode("documents").alias("d"))
    n = F.sum("d.size")
    return places.groupBy(F.col("d.id").alias("doc_id")).agg(
        n.alias("n_tokens"),
        F.count_distinct("packed_row").alias("n_pieces"),
        ((n <= 256) & (F.count(F.lit(1)) == 1)).alias("whole"),
    )


@query(
    "epoch_order",
    """select e as epoch, count(*) as n, 0::bigint as smallest, count(*) - 1 as largest, count(*) as n_places, count(*) as n_back,
      true as moved from documents, (select unnest(range(3)) as e) group by e""",
)
def epoch_order_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order of three epochs from one numbering of the documents: every place is taken once, and can be looked up."""
    docs = read_table(spark, sf_dir, "documents", "doc_id")
    numbered = running_total(docs, "doc_id", (), F.lit(1), "ordinal")
    n = docs.count()
    epochs = [
        numbered.select(F.lit(e).cast("bigint").alias("epoch"), "ordinal", epoch_position("ordinal", n, epoch=e).alias("place"))
        .withColumn("back", epoch_ordinal("place", n, epoch=e)) for e in range(3)
    ]
    return reduce(DataFrame.unionAll, epochs).groupBy("epoch").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("place").alias("smallest"),
        F.max("place").alias("largest"),
        F.count_distinct("place").alias("n_places"),
        F.count_if(F.col("back") == F.col("ordinal")).alias("n_back"),
        (F.count_if(F.col("place") != F.col("ordinal")) > 0).alias("moved"),
    )


@query("completion_text", f"select completion_id, content as first_text, problem as last_text from ({I.COMPLETIONS_SQL})")
def completion_text_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = I.completions(spark, sf_dir).withColumn(
        "completion", F.array(S.message("assistant", "content"), S.message("user", "problem"))
    )
    return rows.select(
        "completion_id",
        S.completion_text("completion").alias("first_text"),
        S.completion_text("completion", last=True).alias("last_text"),
    )


@query(
    "save_step_filter",
    "select event_id as step, user_id as run from events where event_id % 50 = 0",
)
def save_step_filter_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    saves = read_table(spark, sf_dir, "events", "event_id", "user_id")
    return save_step_filter(saves.select(F.col("event_id").alias("step"), F.col("user_id").alias("run")))


@query(
    "doc_limit_dedup",
    """with u as (select source, text, min(doc_id) as doc_id from documents group by source, text),
    k as (select source, doc_id, row_number() over (partition by source order by doc_id) as rn from u)
    select source, doc_id from k where rn <= 20""",
)
def doc_limit_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "source", "text", spread=True)
    unique = unique_docs(docs, "text", "doc_id", ["source"]).select("source", "doc_id")
    return limit_docs(unique, ["source"], "doc_id", 20)


@query(
    "doc_counts",
    """select source, count(*) as original_num_docs, count(distinct text) as effective_num_docs from documents group by source""",
)
def doc_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "source", "text", spread=True)
    return doc_counts(docs, ["source"], "text")


@query(
    "seeded_shuffle",
    "select o_orderkey, row_number() over (order by md5(concat('42:', o_orderkey)), o_orderkey) - 1 as position from orders",
)
def seeded_shuffle_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seeded_shuffle(read_table(spark, sf_dir, "orders", "o_orderkey"), "o_orderkey")


@query(
    "count_substring",
    "select doc_id, (length(text) - length(replace(text, 'en', ''))) // 2 as n_en from documents",
)
def count_substring_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return docs.select("doc_id", count_substring("text", "en").cast("bigint").alias("n_en"))


@query(
    "ngrams",
    f"""with w as (select doc_id, {TOKENS_SQL.replace("text", "lower(text)")} as words from documents),
    g as (select doc_id, case when len(words) >= 2 then list_transform(range(1, len(words)), lambda i: concat(words[i], ' ', words[i + 1])) else [] end as grams from w)
    select doc_id, len(grams) as n, len(list_distinct(grams)) as n_distinct, md5(array_to_string(grams, '|')) as grams_md5 from g""",
)
def ngrams_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", spread=True)
    words = docs.select("doc_id", py_split(F.lower("text")).alias("words"))
    grams = words.select("doc_id", ngrams("words", 2).alias("grams"))
    return grams.select(
        "doc_id",
        F.size("grams").cast("bigint").alias("n"),
        F.size(F.array_distinct("grams")).cast("bigint").alias("n_distinct"),
        F.md5(F.array_join("grams", "|")).alias("grams_md5"),
    )


PADDED_SQL = "select doc_id, concat(chr(28), ' ', chr(9), text, chr(160), chr(10)) as text from documents"


def padded_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", spread=True)
    return docs.select("doc_id", F.concat(F.lit("\x1c \t"), "text", F.lit("\xa0\n")).alias("text"))


@query("py_strip", f"select doc_id, md5(trim(text, {WS_SQL})) as stripped_md5 from ({PADDED_SQL})")
def py_strip_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return padded_docs(spark, sf_dir).select("doc_id", F.md5(py_strip("text")).alias("stripped_md5"))


@query(
    "py_split",
    f"""with w as (select doc_id, {TOKENS_SQL} as words from ({PADDED_SQL}))
    select doc_id, len(words) as n_words, md5(array_to_string(words, ' ')) as words_md5 from w""",
)
def py_split_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = padded_docs(spark, sf_dir).select("doc_id", py_split("text").alias("words"))
    return words.select(
        "doc_id", F.size("words").cast("bigint").alias("n_words"), F.md5(F.array_join("words", " ")).alias("words_md5")
    )


@query(
    "parse_task_key",
    f"""select distinct task, 'custom' as suite, cast(0 as integer) as fewshot, cast(0 as integer) as truncate,
      concat('custom|', task, '|0|0') as key, true as short_form from ({I.SAMPLES_SQL})""",
)
def parse_task_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = I.eval_samples(spark, sf_dir).select("task").distinct()
    full = keys.select(build_task_key(F.lit("custom"), "task").alias("key"), "task")
    parsed = full.withColumn("p", parse_task_key("key")).withColumn(
        "s", parse_task_key(F.concat(F.lit("custom|"), "task", F.lit("|0")))
    )
    return parsed.select(
        "key", "p.suite", "p.task", "p.fewshot", "p.truncate", F.col("s.truncate").isNull().alias("short_form")
    )


@query(
    "param_count",
    """with m as (select p_partkey, concat('org/', p_brand, '-', p_size, case when p_partkey % 4 = 0 then 'x7b' when p_partkey % 4 = 1 then '.5m'
      when p_partkey % 4 = 2 then 'B-v2' else 'k' end) as model_id from part)
    select p_partkey, model_id, case when p_partkey % 4 = 0 then cast(regexp_extract(model_id, '-([0-9]+)x', 1) as bigint) * 7000000000
      when p_partkey % 4 = 1 then cast(round(cast(regexp_extract(model_id, '-([0-9.]+)m', 1) as double) * 1000000) as bigint)
      when p_partkey % 4 = 2 then cast(regexp_extract(model_id, '-([0-9]+)B', 1) as bigint) * 1000000000 else -1 end as params from m""",
)
def param_count_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_size")
    form = F.col("p_partkey") % 4
    tail = F.when(form == 0, "x7b").when(form == 1, ".5m").when(form == 2, "B-v2").otherwise("k")
    ids = part.select(
        "p_partkey",
        F.concat(F.lit("org/"), "p_brand", F.lit("-"), F.col("p_size").cast("string"), tail).alias("model_id"),
    )
    return ids.withColumn("params", param_count("model_id"))


@query(
    "gold_letter",
    "select event_id, substr('ABCD', cast(user_id % 4 as integer) + 1, 1) as letter from events",
)
def gold_letter_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events", "event_id", "user_id")
    return events.select("event_id", gold_letter(F.col("user_id") % 4).alias("letter"))


@query(
    "step_revision",
    """select event_id, concat('main-step-', lpad(cast(event_id as varchar), 9, '0')) as revision,
      concat('data/run', user_id, '/checkpoint-', event_id) as folder from events""",
)
def step_revision_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events", "event_id", "user_id")
    folder = F.concat(F.lit("data/run"), F.col("user_id").cast("string"))
    return events.select(
        "event_id",
        step_revision(F.lit("main"), "event_id").alias("revision"),
        checkpoint_dir(folder, "event_id").alias("folder"),
    )


@query(
    "json_roundtrip",
    """select event_id, cast(json_extract(props, '$.k') as integer) as k,
      concat('{"language":"python","test_cases":[{"input":"', user_id, '","output":"', json_extract(props, '$.k'), '"}]}') as info
    from events""",
)
def json_roundtrip_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events", "event_id", "user_id", "props")
    k = F.from_json("props", "k int")["k"]
    case = F.struct(F.col("user_id").cast("string").alias("input"), k.cast("string").alias("output"))
    info = F.struct(F.lit("python").alias("language"), F.array(case).alias("test_cases"))
    return events.select("event_id", k.alias("k"), F.to_json(info).alias("info"))


@query(
    "prepare_prompts",
    f"""with t as (select row_id, concat('<|system|>', chr(10), {text_sql(S.SYSTEM_PROMPT)}, '</s>', chr(10), '<|user|>', chr(10),
      problem, '</s>', chr(10), '<|assistant|>') as text from ({PROBLEMS_SQL})), k as (select row_id, {TOKENS_SQL} as tokens from t)
    select row_id, least(len(tokens), 512) as n_ids, md5(array_to_string(tokens[1:512], ' ')) as ids_md5 from k""",
)
def prepare_prompts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepare_prompts(problems(spark, sf_dir))
    return rows.select(
        "row_id", F.size("input_ids").cast("bigint").alias("n_ids"), F.md5(F.array_join("input_ids", " ")).alias("ids_md5")
    )


@query(
    "reward_function_protocol",
    f"select completion_id, cast(length(content) % 7 as double) / 7.0::double as reward_length_mod from ({I.COMPLETIONS_SQL})",
)
def reward_function_protocol_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user reward given as a vectorised function instead of a Column expression."""

    @F.pandas_udf("double")
    def length_mod(content: pd.Series) -> pd.Series:
        return (content.str.len() % 7) / 7.0

    register("length_mod", lambda: length_mod("content"))
    return add_rewards(I.completions(spark, sf_dir), ["length_mod"]).select("completion_id", "reward_length_mod")


@query("row_map_function", "select event_id, upper(event_type) as label, round(value * 2, 6) as twice from events")
def row_map_function_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    def convert(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "event_id": batch["event_id"],
                "label": batch["event_type"].str.upper(),
                "twice": (batch["value"] * 2).round(6),
            }
        )

    events = read_table(spark, sf_dir, "events", "event_id", "event_type", "value")
    return map_rows(events, convert, "event_id bigint, label string, twice double")


def echo_server():
    """Stand-in for a model server: its clients answer with the length of the prompt."""

    def make_client():
        return lambda prompts: [f"{len(p)} characters" for p in prompts]

    return make_client


@query(
    "external_step",
    f"""select row_id, problem as instruction, concat(length(problem), ' characters') as text, cast(null as varchar) as error
    from ({PROBLEMS_SQL})""",
)
def external_step_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = S.generation_requests(problems(spark, sf_dir).select("row_id", "problem"), "problem")
    answered = external_step(requests.select("row_id", "instruction"), echo_server(), replicas=4)
    return answered


@query(
    "external_step_resumed",
    f"""select row_id, concat(length(problem), ' characters') as text, cast(null as varchar) as error,
      case when row_id % 3 = 0 then '1' else '2' end as run
    from ({PROBLEMS_SQL})""",
)
def external_step_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the requests are answered by a first run; the second run sends all and asks for the others."""
    requests = S.generation_requests(problems(spark, sf_dir).select("row_id", "problem"), "problem").select("row_id", "instruction")
    ledger = fresh_path(spark, "ledger")
    resumable_step(requests.where("row_id % 3 = 0"), echo_server(), ledger, replicas=4, run="1")
    return resumable_step(requests, echo_server(), ledger, replicas=4, run="2").drop("instruction")


@query(
    "generate",
    f"""select row_id, 3::bigint as n, 0::bigint as n_errors, concat_ws('|', concat(length(problem), ' characters'),
      concat(length(problem), ' characters'), concat(length(problem), ' characters')) as joined from ({PROBLEMS_SQL})""",
)
def generate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompts = problems(spark, sf_dir).select("row_id", "problem")
    out = generate(prompts, "row_id", "problem", echo_server(), generations=3, replicas=4, temperature=0.6)
    return out.select(
        "row_id",
        F.size("generations").cast("bigint").alias("n"),
        F.size(F.filter("errors", lambda e: e.isNotNull())).cast("bigint").alias("n_errors"),
        F.array_join("generations", "|").alias("joined"),
    )
