"""Prompt, chat, token and generation-request shaping."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import as_col, fill_template, int_div, py_split
from .skew import running_total

MESSAGE = "struct<role:string,content:string>"

# The system prompt of the training recipes, the chat roles that are rendered, the math prompt, the
# column names dropped before training, and the default request settings.
SYSTEM_PROMPT = (
    "A conversation between User and Assistant. The user asks a question, and the Assistant solves it. The assistant "
    "first thinks about the reasoning process in the mind and then provides the user with the answer, and put your "
    "final answer within \\boxed{{}} . The reasoning process and answer are enclosed within <think> </think> and "
    "<answer> </answer> tags, respectively, i.e., <think> reasoning process here </think> <answer> answer here "
    "</answer>. Note that respond by English, NOT use other languages."
)
CHAT_ROLES = ["user", "system", "assistant"]
MATH_PROMPT = (
    "Solve the following math problem efficiently and clearly.  The last line of your response should be of the "
    "following format: 'Therefore, the final answer is: $\\boxed{ANSWER}$. I hope it is correct' (without quotes) "
    "where ANSWER is just the final number or expression that solves the problem. Think step by step before "
    "answering.\n\n{Question}"
)
TOKEN_INPUT_COLUMNS = ["problem", "solution", "answer", "level", "prompt"]
MAX_PROMPT_LENGTH = 512
BATCH_ROWS = 64
LOAD_BATCHES = 1000
MAX_NEW_TOKENS = 8192
PACKED_LENGTH = 4096


def message(role: str, content: Column | str) -> Column:
    return F.struct(F.lit(role).alias("role"), as_col(content).alias("content"))


def make_conversation(df: DataFrame, system_prompt: str | None = None, problem: str = "problem") -> DataFrame:
    """Add ``prompt``: an optional system message (also for an empty text) and the problem as user message."""
    messages = [message("user", problem)]
    if system_prompt is not None:
        messages.insert(0, message("system", F.lit(system_prompt)))
    return df.withColumn("prompt", F.array(*messages))


def drop_messages(df: DataFrame) -> DataFrame:
    return df.drop("messages")


def prune_for_tokens(df: DataFrame) -> DataFrame:
    """Drop the raw text columns, but only from a table that has ``problem``."""
    return df.drop(*TOKEN_INPUT_COLUMNS) if "problem" in df.columns else df


def render_message(role: Column, content: Column, eos: str) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), content, F.lit(eos + "\n"))


def chat_render(messages: Column | str, eos: str = "</s>", generation_prompt: bool = False) -> Column:
    """Text of an array of messages; unknown roles are left out, the generation marker ends without a newline.

    The marker follows the last message, so an empty conversation has an empty text.
    """
    known = F.filter(as_col(messages), lambda m: m["role"].isin(CHAT_ROLES))
    text = F.array_join(F.transform(known, lambda m: render_message(m["role"], m["content"], eos)), "")
    marker = F.when(F.size(as_col(messages)) > 0, F.lit("<|assistant|>")).otherwise(F.lit(""))
    return F.concat(text, marker) if generation_prompt else text


def _parts(index: str, rows_per_part: int | None) -> list[Column]:
    return [] if rows_per_part is None else [int_div(index, rows_per_part).cast("int").alias("part")]


def collect_messages(
    turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", content: str = "text",
    rows_per_part: int | None = None,
) -> DataFrame:
    """Turn rows to one ordered message array per conversation.

    With ``rows_per_part``, a conversation continues in a further row (``part``) after so many turn numbers, so that
    the shuffle key (conversation, part) bounds every group.
    """
    packed = F.struct(F.col(turn).alias("t"), F.col(role).alias("role"), F.col(content).alias("content"))
    grouped = turns.groupBy(key, *_parts(turn, rows_per_part)).agg(F.sort_array(F.collect_list(packed)).alias("_m"))
    messages = F.transform("_m", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    return grouped.withColumn("messages", messages).drop("_m")


def render_turns(turns: DataFrame, role: str = "role", content: str = "text", eos: str = "</s>") -> DataFrame:
    """Add ``rendered``, the chat text of each turn: the long form, for conversations too large for one row."""
    text = render_message(F.col(role), F.col(content), eos)
    return turns.withColumn("rendered", F.when(F.col(role).isin(CHAT_ROLES), text).otherwise(F.lit("")))


def render_conversations(
    turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", content: str = "text",
    eos: str = "</s>", generation_prompt: bool = False, rows_per_part: int | None = None,
) -> DataFrame:
    """Chat text of every conversation, in one scan. With ``rows_per_part`` the parts concatenate to the text.

    The generation marker belongs to the last part only, found from the largest turn number of each conversation.
    """
    parts = collect_messages(turns, key, turn, role, content, rows_per_part)
    if rows_per_part is None:
        return parts.select(key, chat_render("messages", eos, generation_prompt).alias("rendered"))
    text = chat_render("messages", eos)
    if not generation_prompt:
        return parts.select(key, "part", text.alias("rendered"))
    last = turns.groupBy(key).agg(F.max(turn).alias("_turn"))
    last = last.select(key, int_div("_turn", rows_per_part).cast("int").alias("part"), F.lit(True).alias("_last"))
    marker = F.when(F.col("_last"), F.lit("<|assistant|>")).otherwise(F.lit(""))
    return parts.join(last, [key, "part"], "left").select(key, "part", F.concat(text, marker).alias("rendered"))


def math_prompt(question: Column | str) -> Column:
    return fill_template(MATH_PROMPT, Question=as_col(question))


def generation_requests(
    df: DataFrame,
    prompt_column: str,
    template: str = "{{ instruction }}",
    temperature: float | None = None,
    top_p: float | None = None,
    max_new_tokens: int = MAX_NEW_TOKENS,
) -> DataFrame:
    """Add ``instruction`` (template filled from a column) and ``params``; settings that are not given are absent."""
    params: dict[str, Column] = {"max_new_tokens": F.lit(max_new_tokens)}
    if temperature is not None:
        params["temperature"] = F.lit(float(temperature))
    if top_p is not None:
        params["top_p"] = F.lit(float(top_p))
    pieces = re.split(r"\{\{\s*instruction\s*\}\}", template)
    slots = [x for p in pieces for x in (F.lit(p), F.col(prompt_column))][:-1]
    filled = F.concat(*slots)
    return df.withColumn("instruction", filled).withColumn(
        "params", F.struct(*[c.alias(name) for name, c in params.items()])
    )


def replicate_generations(df: DataFrame, n: int) -> DataFrame:
    return df.withColumn("gen_idx", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def request_batches(
    df: DataFrame, row_id: str, order: Sequence[str] = (), batch_rows: int = BATCH_ROWS, load_batches: int = LOAD_BATCHES
) -> DataFrame:
    """Number requests in the order of an integer id into load units of ``load_batches`` batches of ``batch_rows`` rows.

    Rows are counted, not ids, so every batch but the last is full whatever the gaps between ids.
    """
    unit_rows = batch_rows * load_batches
    numbered = running_total(df, row_id, order, F.lit(1), "_row")
    return (
        numbered.withColumn("load_unit", int_div("_row", unit_rows))
        .withColumn("batch", int_div(F.col("_row") % unit_rows, batch_rows))
        .drop("_row")
    )


def group_generations(
    df: DataFrame, key: str = "prompt_id", index: str = "gen_idx", text: str = "text", error: str | None = None,
    rows_per_part: int | None = None,
) -> DataFrame:
    """Generations of a prompt as one ordered array, and ``errors`` beside it if ``error`` names their column.

    With ``rows_per_part``, a prompt continues in a further row (``part``) after so many indices.
    """
    packed = F.struct(F.col(index).alias("i"), F.col(text).alias("text"), (F.col(error) if error else F.lit(None)).alias("error"))
    grouped = df.groupBy(key, *_parts(index, rows_per_part)).agg(F.sort_array(F.collect_list(packed)).alias("_g"))
    grouped = grouped.withColumn("generations", F.transform("_g", lambda g: g["text"]))
    if error:
        grouped = grouped.withColumn("errors", F.transform("_g", lambda g: g["error"]))
    return grouped.drop("_g")


def whitespace_tokens(text: Column | str) -> Column:
    return py_split(text)


def truncate_prompt(df: DataFrame, tokens: str = "tokens", k: int = MAX_PROMPT_LENGTH) -> DataFrame:
    """Keep the first ``k`` tokens and add a mask of ones. No padding here."""
    return df.withColumn("input_ids", F.slice(tokens, 1, k)).withColumn(
        "attention_mask", F.array_repeat(F.lit(1), F.size("input_ids"))
    )


def left_pad_batch(
    df: DataFrame, ids: str, batch: Sequence[str], pad: Column
) -> DataFrame:
    """Pad token arrays on the left to the longest of their batch; adds ``padded`` and ``pad_mask``.

    A padding batch is small by definition (it becomes one tensor), so one window on it is enough.
    """
    sized = df.withColumn("_n", F.size(ids))
    joined = sized.withColumn("_max", F.max("_n").over(Window.partitionBy(*batch)))
    gap = F.col("_max") - F.col("_n")
    return (
        joined.withColumn("padded", F.concat(F.array_repeat(pad, gap), F.col(ids)))
        .withColumn("pad_mask", F.concat(F.array_repeat(F.lit(0), gap), F.array_repeat(F.lit(1), F.col("_n"))))
        .drop("_n", "_max")
    )


def pack_sequences(
    df: DataFrame, row_id: str, tokens: str = "tokens", length: int = PACKED_LENGTH
) -> DataFrame:
    """Concatenate token arrays in the order of an integer id, as one stream, and cut it into rows of ``length`` tokens.

    Each row is cut into the slices it adds to its packed rows, and the slices are grouped by packed row: a group never
    holds more than ``length`` tokens. Only the last row may be shorter; nothing is dropped. Gaps between ids and null
    or empty arrays change nothing.
    """
    counted = df.select(row_id, F.col(tokens).alias("_t")).where(F.col("_t").isNotNull()).withColumn("_n", F.size("_t"))
    sized = running_total(counted, row_id, (), F.col("_n"), "_start")
    first, last = int_div("_start", length), int_div(F.col("_start") + F.col("_n") - 1, length)

    def piece(row: Column) -> Column:
        begin = F.greatest(row * length - F.col("_start"), F.lit(0))
        end = F.least((row + 1) * length - F.col("_start"), F.col("_n"))
        part = F.slice("_t", (begin + 1).cast("int"), (end - begin).cast("int"))
        return F.struct(row.alias("row"), F.col("_start").alias("at"), part.alias("tokens"))

    # Empty rows add no piece. A filter on the size would be pushed down and compute the tokens a second time.
    rows = F.when(F.col("_n") > 0, F.sequence(first, F.greatest(first, last)))
    pieces = sized.select(F.explode(F.transform(rows, piece)).alias("p"))
    return (
        pieces.groupBy(F.col("p.row").alias("packed_row"))
        .agg(F.sort_array(F.collect_list(F.struct("p.at", "p.tokens"))).alias("_pieces"))
        .select("packed_row", F.flatten(F.col("_pieces.tokens")).alias("tokens"))
    )


def completion_text(completion: Column | str, last: bool = False) -> Column:
    """Content of the first message, or of the last one for the code reward."""
    messages = as_col(completion)
    return F.try_element_at(messages, F.lit(-1 if last else 1))["content"]
