"""Registered queries: row-scope and group-scope rewards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.answers import boxed_answer, extract_answer, extract_code, index_match, with_grading, with_multi_gold
from ..operators import rewards as R
from ..operators.groups import reward_summary, with_group_advantage, with_len_reward
from ..operators.joins import join_gold, join_verification
from ..operators.registry import (
    RewardConfig,
    add_rewards,
    normalized_weights,
    register,
    score_rollouts,
    weighted_sum,
)
from ..sources.tables import read_table
from . import inputs as I
from .jobs import GROUP_RECIPE, POLICY_RECIPE, score_with_recipe
from .registry import query, r, rounded

C = I.COMPLETIONS_SQL
CLOSE = "concat(chr(10), '</think>', chr(10))"
OPEN = "concat('<think>', chr(10))"


def count_sql(needle: str, text: str = "content") -> str:
    return f"((length({text}) - length(replace({text}, {needle}, ''))) // length({needle}))"


FORMAT = f"case when {count_sql(CLOSE)} = 1 then 1.0::double else 0.0::double end"
TAGS = (
    f"(case when {count_sql(OPEN)} = 1 then 0.5::double else 0.0::double end"
    f" + case when {count_sql(CLOSE)} = 1 then 0.5::double else 0.0::double end)"
)
STEPS = (
    r"least(1.0::double, len(regexp_extract_all(content, "
    r"'(Step \d+:|^\d+\.|\n-|\n\*|First,|Second,|Next,|Finally,)')) / 3.0::double)"
)
ACCURACY = "case when is_correct then 1.0::double else 0.0::double end"


def cosine_sql(min_wrong: float, max_wrong: float, min_right: float, max_right: float, max_len: int) -> str:
    wave = f"(1 + cos(length(content)::double / {max_len} * pi()))"
    return (
        f"case when is_correct then {min_right}::double + 0.5::double * ({max_right} - {min_right})::double * {wave} "
        f"else {max_wrong}::double + 0.5::double * ({min_wrong} - {max_wrong})::double * {wave} end"
    )


SCRIPT_COSINE = cosine_sql(0.0, -0.5, 0.5, 1.0, 1000)


def repetition_sql(table: str, key: str, text: str) -> str:
    ws = r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
    return f"""
with w as (
  select {key}, list_filter(regexp_split_to_array(lower({text}), '{ws}'), lambda x: x <> '') as words from {table}
), g as (
  select {key}, len(words) as n, case when len(words) >= 3 then list_transform(range(1, len(words) - 1),
    lambda i: concat(words[i], ' ', words[i + 1], ' ', words[i + 2])) end as grams from w
)
select {key}, {r("case when n < 3 then 0.0::double else "
    "(1.0::double - len(list_distinct(grams)) / len(grams)::double) * -1.0::double end")} as repetition_penalty
from g
"""


@query("format_reward", f"select completion_id, {FORMAT} as format_reward from ({C})")
def format_reward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.completions(spark, sf_dir).select("completion_id", R.format_reward("content").alias("format_reward"))


@query("tag_count_reward", f"select completion_id, {TAGS} as tag_count_reward from ({C})")
def tag_count_reward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.completions(spark, sf_dir).select("completion_id", R.tag_count_reward("content").alias("tag_count_reward"))


@query("reasoning_steps_reward", f"select completion_id, {r(STEPS)} as reasoning_steps_reward from ({C})")
def reasoning_steps_reward(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = rounded(R.reasoning_steps_reward("content"))
    return I.completions(spark, sf_dir).select("completion_id", steps.alias("reasoning_steps_reward"))


@query("repetition_penalty", repetition_sql("documents", "doc_id", "text"))
def repetition_penalty(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", spread=True)
    return R.with_repetition_penalty(docs, "text").select(
        "doc_id",
        rounded("repetition_penalty").alias("repetition_penalty"),
    )


@query("repetition_penalty_completions", repetition_sql(f"({C})", "completion_id", "content"))
def repetition_penalty_completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.with_repetition_penalty(I.completions(spark, sf_dir)).select(
        "completion_id",
        rounded("repetition_penalty").alias("repetition_penalty"),
    )


@query(
    "cosine_scaled_reward",
    f"with {I.GRADED_SQL} select completion_id, is_correct, {r(cosine_sql(-1.0, -0.5, 0.5, 1.0, 1000))} as cosine_factory, "
    f"{r(SCRIPT_COSINE)} as cosine_script from scored",
)
def cosine_scaled_reward(spark: SparkSession, sf_dir: str) -> DataFrame:
    graded = with_grading(I.completions(spark, sf_dir))
    script = R.cosine_scaled_reward(min_value_wrong=0.0, max_value_wrong=-0.5)
    return graded.select(
        "completion_id",
        "is_correct",
        rounded(R.cosine_scaled_reward()).alias("cosine_factory"),
        rounded(script).alias("cosine_script"),
    )


@query(
    "accuracy_reward",
    f"with {I.GRADED_SQL} select completion_id, pred as pred_norm, solution as gold_norm, {ACCURACY} as accuracy_reward "
    "from scored",
)
def accuracy_reward(spark: SparkSession, sf_dir: str) -> DataFrame:
    graded = with_grading(I.completions(spark, sf_dir))
    return graded.select("completion_id", "pred_norm", "gold_norm", R.accuracy_reward().alias("accuracy_reward"))


@query(
    "accuracy_equivalent",
    f"select row_id, (row_id % 10)::int as form, case when d = 0 then 1.0::double else 0.0::double end as accuracy_reward from ({I.ALGEBRA_SQL})",
)
def accuracy_equivalent(spark: SparkSession, sf_dir: str) -> DataFrame:
    graded = with_grading(I.answer_pairs(spark, sf_dir, I.ALGEBRA_FORMS))
    return graded.select("row_id", "form", R.accuracy_reward().alias("accuracy_reward"))


@query(
    "answers_structured",
    f"""select row_id, form, case form
        when 0 then list_sort(list_distinct([a, b, c])) = list_sort(list_distinct([c, a, b + d]))
        when 2 then d = 0 or a = b
        when 5 then list_sort(list_distinct([a, b])) = list_sort(list_distinct([b + d, a]))
        else d = 0 end as is_correct
      from (select *, (row_id % 8)::int as form from ({I.ALGEBRA_SQL}))""",
)
def answers_structured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_grading(I.answer_pairs(spark, sf_dir, I.STRUCTURED_FORMS)).select("row_id", "form", "is_correct")


@query(
    "skip_unparseable_gold",
    f"""with {I.GRADED_SQL}, blanked as (
      select *, prompt_id % 5 = 0 as blank, (prompt_id % 5 <> 0 and is_correct) as ok from scored)
    select completion_id, blank as gold_unusable, case when blank then 1.0::double end as accuracy_default,
      case when blank then 1.0::double end as cosine_default, (blank or ok) as length_counts_as_correct from blanked""",
)
def skip_unparseable_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    blanked = F.when(F.col("prompt_id") % 5 == 0, F.lit(" $ $ ")).otherwise(F.col("solution"))
    graded = with_grading(I.completions(spark, sf_dir).withColumn("solution", blanked))
    return R.gold_policies(graded).select(
        "completion_id", "gold_unusable", "accuracy_default", "cosine_default", "length_counts_as_correct"
    )


@query(
    "code_format_reward",
    rf"""select completion_id, case when regexp_matches(content,
      '(?ms)\A<think>\n.*?\n</think>\n<answer>\n.*?```python.*?```.*?\n</answer>$')
      then 1.0::double else 0.0::double end as code_format_reward from ({I.CODE_SQL})""",
)
def code_format_reward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.code_completions(spark, sf_dir).select(
        "completion_id", R.code_format_reward("content").alias("code_format_reward")
    )


@query(
    "extract_code",
    rf"""select completion_id, coalesce(regexp_extract_all(content, '(?s)```python\n(.*?)```', 1)[-1], '') as code
    from ({I.CODE_SQL})""",
)
def extract_code_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.code_completions(spark, sf_dir).select("completion_id", extract_code("content").alias("code"))


@query(
    "extract_answer",
    f"""select completion_id, case
      when instr(content, '<answer>') > 0 and instr(content, '</answer>') > 0 then
        trim(substr(content, instr(content, '<answer>') + 8,
          greatest(instr(content, '</answer>') - instr(content, '<answer>') - 8, 0)), concat(' ', chr(10)))
      when instr(content, concat(chr(92), 'boxed{{')) > 0 then
        regexp_extract(content, concat(chr(92), chr(92), 'boxed', chr(92), '{{([^}}]*)', chr(92), '}}'), 1)
      else string_split(trim(content, concat(' ', chr(10))), chr(10))[-1] end as answer
    from ({C})""",
)
def extract_answer_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.completions(spark, sf_dir).select("completion_id", extract_answer("content").alias("answer"))


@query("boxed_answer", f"with {I.GRADED_SQL} select completion_id, pred as boxed from scored")
def boxed_answer_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.completions(spark, sf_dir).select("completion_id", boxed_answer("content").alias("boxed"))


@query(
    "index_match",
    """with a as (
      select event_id, concat(props, chr(10), 'Answer: ', case when user_id % 2 = 0 then '$' else '' end,
        substr('ABCDE', cast(event_id % 5 as integer) + 1, 1)) as content, user_id % 4 as gold_index from events)
    select event_id, case when regexp_extract_all(content, 'Answer:\\s*\\$?([A-D])(?:[^A-Za-z]|$)', 1)[-1] = substr('ABCD', cast(gold_index as integer) + 1, 1)
      then 1.0::double else 0.0::double end as score from a""".replace("\\\\", "\\"),
)
def index_match_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events", "event_id", "user_id", "props")
    letter = F.substring(F.lit("ABCDE"), (F.col("event_id") % 5 + 1).cast("int"), F.lit(1))
    dollar = F.when(F.col("user_id") % 2 == 0, F.lit("$")).otherwise(F.lit(""))
    rows = events.select(
        "event_id",
        F.concat("props", F.lit("\nAnswer: "), dollar, letter).alias("content"),
        (F.col("user_id") % 4).alias("gold_index"),
        F.array(*[F.lit(x) for x in "ABCD"]).alias("choices"),
    )
    return rows.select("event_id", index_match("content", "choices", "gold_index").alias("score"))


@query(
    "multi_gold_max",
    f"""with {I.GRADED_SQL} select completion_id,
      case when pred in (solution, cast(cast(solution as integer) + 1 as varchar)) then 1.0::double else 0.0::double end as score
    from scored""",
)
def multi_gold_max_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = I.completions(spark, sf_dir).withColumn(
        "golds", F.array("solution", (F.col("solution").cast("int") + 1).cast("string"))
    )
    return with_multi_gold(rows, "content", "golds").select("completion_id", F.coalesce("score", F.lit(0.0)).alias("score"))


@query(
    "code_pass_rate",
    f"""with cases as (
      select *, string_split(trim(stdout, concat(' ', chr(10))), chr(10)) as got, string_split(expected, chr(10)) as want
      from ({I.CODE_RUNS_SQL})
    ), judged as (
      select completion_id, timed_out, returncode = 0 and len(list_filter(range(1, least(len(got), len(want)) + 1),
        lambda i: trim(got[i]) <> trim(want[i]))) = 0 as passed from cases
    ), rates as (
      select completion_id, avg(passed::int) as rate, bool_or(timed_out) as timed_out from judged group by completion_id)
    select o.o_orderkey as completion_id, {r("case when coalesce(timed_out, false) then 0.0::double else coalesce(rate, 0.0::double) end")} as code_reward
    from orders o left join rates on rates.completion_id = o.o_orderkey""",
)
def code_pass_rate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders", "o_orderkey").select(F.col("o_orderkey").alias("completion_id"))
    rated = R.code_pass_rate(orders, I.code_runs(spark, sf_dir))
    return rated.select("completion_id", rounded("code_reward").alias("code_reward"))


@query(
    "quality_checks",
    f"""select completion_id, contains(content, '<think>') and contains(content, '</think>') as has_think,
      contains(content, '<answer>') and contains(content, '</answer>') as has_answer, length(content) as n_chars
    from ({C})""",
)
def quality_checks_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.quality_checks(I.completions(spark, sf_dir).select("completion_id", "content")).drop("content")


MARKS = {"fr": " \u0434\u0430", "de": " $\u0434\u0430$", "es": " 5 \u00b5m"}
MARK_SQL = "case lang " + " ".join(f"when '{k}' then '{v}'" for k, v in MARKS.items()) + " else ' \\alpha{x}' end"


@query(
    "non_english_filter",
    f"""with t as (select doc_id, concat(text, {MARK_SQL}) as text from documents), s as (
      select doc_id, regexp_replace(regexp_replace(text,
        '\\$[^$]*\\$|\\\\\\(.*?\\\\\\)|\\\\\\[.*?\\\\\\]|\\\\begin\\{{.*?\\}}.*?\\\\end\\{{.*?\\}}', '', 'gs'),
        '\\\\[a-zA-Z]+(\\{{[^{{}}]*\\}})*', '', 'g') as text from t)
    select doc_id, regexp_matches(text, '[\\x{{0370}}-\\x{{06FF}}\\x{{0E00}}-\\x{{0E7F}}\\x{{3040}}-\\x{{30FF}}\\x{{3400}}-\\x{{4DBF}}\\x{{4E00}}-\\x{{9FFF}}\\x{{F900}}-\\x{{FAFF}}\\x{{B5}}]') as non_english
    from s""",
)
def non_english_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "lang", "text", spread=True)
    mark = F.lit(" \\alpha{x}")
    for lang, value in MARKS.items():
        mark = F.when(F.col("lang") == lang, F.lit(value)).otherwise(mark)
    marked = F.concat("text", mark)
    return docs.select("doc_id", (R.english_reward(marked) == 0.0).alias("non_english"))


@query("join_gold", f"select completion_id, prompt_id, solution, length(content) as n_chars from ({C})")
def join_gold_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = I.completions(spark, sf_dir)
    gold = read_table(spark, sf_dir, "conversations", "conv_id").distinct().select(
        F.col("conv_id").alias("prompt_id"), ((F.col("conv_id") * 13) % 50).cast("string").alias("solution")
    )
    return join_gold(rows.drop("solution"), gold).select(
        "completion_id", "prompt_id", "solution", F.length("content").cast("bigint").alias("n_chars")
    )


@query(
    "join_verification",
    f"""select completion_id, prompt_id, 'python' as language, k as case_id, concat('in ', k, ' of ', prompt_id) as input,
      cast(prompt_id * (k + 1) as varchar) as expected
    from ({C}) cross join (select unnest([0, 1, 2]) as k) where k < 1 + prompt_id % 3""",
)
def join_verification_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = I.completions(spark, sf_dir).select("completion_id", "prompt_id")
    info = read_table(spark, sf_dir, "conversations", "conv_id").distinct().select(
        F.col("conv_id").alias("prompt_id"),
        F.expr(
            """struct('python' as language, transform(sequence(0, cast(conv_id % 3 as int)), k -> struct(
            concat('in ', k, ' of ', conv_id) as input, cast(conv_id * (k + 1) as string) as output)) as test_cases)"""
        ).alias("verification_info"),
    )
    return join_verification(rows, info)


LEN_SQL = f"""with {I.GRADED_SQL}, sized as (
  select *, length(content) as n, min(length(content)) over (partition by prompt_id) as lo,
    max(length(content)) over (partition by prompt_id) as hi from scored),
rewarded as (
  select *, case when hi = lo then 0.0::double when is_correct then 0.5::double - (n - lo) / (hi - lo)::double
    else least(0.0::double, 0.5::double - (n - lo) / (hi - lo)::double) end as len_reward from sized)
"""


@query("len_reward", f"{LEN_SQL} select completion_id, prompt_id, {r('len_reward')} as len_reward from rewarded")
def len_reward_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The answers are whole numbers: there is nothing for equivalence to decide.
    graded = with_grading(I.completions(spark, sf_dir), equivalence=False)
    return with_len_reward(graded).select("completion_id", "prompt_id", rounded("len_reward").alias("len_reward"))


ADVANTAGE = (
    "(reward - avg(reward) over (partition by prompt_id)) / "
    "(coalesce(stddev_samp(reward) over (partition by prompt_id), 0.0::double) + 0.0001::double)"
)


@query(
    "group_advantage",
    f"""with s as (select completion_id, prompt_id, {TAGS} as reward from ({C}))
    select completion_id, prompt_id, {r(ADVANTAGE, 6)} as advantage from s""",
)
def group_advantage_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = I.completions(spark, sf_dir).withColumn("reward", R.tag_count_reward("content"))
    return with_group_advantage(rows).select("completion_id", "prompt_id", rounded("advantage", 6).alias("advantage"))


@query(
    "weighted_reward",
    f"""with {I.GRADED_SQL} select completion_id, {r(f"2.0 * {ACCURACY} + {FORMAT} + {SCRIPT_COSINE} + 0.5 * {STEPS}")} as group_reward,
      {r(f"0.5 * {FORMAT} + 0.5 * {TAGS}")} as policy_reward from scored""",
)
def weighted_reward_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [*GROUP_RECIPE.rewards, "tag_count"]
    rows = add_rewards(I.completions(spark, sf_dir), names)
    policy = normalized_weights(POLICY_RECIPE.rewards, POLICY_RECIPE.weights)
    return rows.select(
        "completion_id",
        rounded(weighted_sum(GROUP_RECIPE.rewards, GROUP_RECIPE.weights)).alias("group_reward"),
        rounded(weighted_sum(POLICY_RECIPE.rewards, policy)).alias("policy_reward"),
    )


@query(
    "reward_registry",
    f"""{LEN_SQL} select completion_id, {ACCURACY} as reward_accuracy, {FORMAT} as reward_format,
      {r(STEPS)} as reward_reasoning_steps, {r(SCRIPT_COSINE)} as reward_cosine, {r("len_reward")} as reward_length,
      {TAGS} as reward_tag_count, 0.0::double as reward_code_format from rewarded""",
)
def reward_registry_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["accuracy", "format", "reasoning_steps", "cosine", "length", "tag_count", "code_format"]
    rows = add_rewards(I.completions(spark, sf_dir), names)
    return rows.select("completion_id", *[rounded(f"reward_{n}").alias(f"reward_{n}") for n in names])


@query(
    "failed_component_zero",
    f"""select completion_id, {r(f"0.5 * {TAGS} + case when prompt_id % 4 = 0 then 0.0 else 0.5 * length(problem) / (prompt_id % 4) end")} as reward
    from ({C})""",
)
def failed_component_zero_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    register("length_share", lambda: F.try_divide(F.length("problem"), F.col("prompt_id") % 4))
    names = ["tag_count", "length_share"]
    rows = score_rollouts(I.completions(spark, sf_dir), names, [0.5, 0.5], advantage=False)
    return rows.select("completion_id", rounded("reward").alias("reward"))


@query(
    "reward_summary",
    f"""with s as (select prompt_id // 10 as step, {FORMAT} as f, {TAGS} as t from ({C})),
    long as (select step, 'format' as reward, f as value from s union all select step, 'tag_count', t from s)
    select step, reward, count(*) as n, {r("avg(value)")} as mean, {r("stddev_samp(value)")} as std, min(value) as min,
      max(value) as max from long group by step, reward""",
)
def reward_summary_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = I.completions(spark, sf_dir).select(
        F.floor(F.col("prompt_id") / 10).alias("step"),
        R.format_reward("content").alias("format"),
        R.tag_count_reward("content").alias("tag_count"),
    )
    out = reward_summary(rows, ["format", "tag_count"])
    return out.select("step", "reward", "n", rounded("mean").alias("mean"), rounded("std").alias("std"), "min", "max")


GROUP_SQL = f"""with {I.GRADED_SQL}, w as (
  select completion_id, prompt_id, {ACCURACY} as a, {FORMAT} as f, {SCRIPT_COSINE} as c, {STEPS} as s from scored),
t as (select *, 2.0 * a + f + c + 0.5 * s as reward from w)
select completion_id, prompt_id, a as reward_accuracy, f as reward_format, {r("c")} as reward_cosine,
  {r("s")} as reward_reasoning_steps, {r("reward")} as reward, {r(ADVANTAGE, 6)} as advantage from t
"""


@query("score_rollouts_group", GROUP_SQL)
def score_rollouts_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: the group recipe end to end."""
    scored = score_with_recipe(I.completions(spark, sf_dir), GROUP_RECIPE, RewardConfig(equivalence=False))
    return scored.select(
        "completion_id",
        "prompt_id",
        "reward_accuracy",
        "reward_format",
        rounded("reward_cosine").alias("reward_cosine"),
        rounded("reward_reasoning_steps").alias("reward_reasoning_steps"),
        rounded("reward").alias("reward"),
        rounded("advantage", 6).alias("advantage"),
    )


@query(
    "score_rollouts_policy",
    f"select completion_id, {FORMAT} as reward_format, {TAGS} as reward_tag_count, "
    f"{r(f'0.5 * {FORMAT} + 0.5 * {TAGS}')} as reward from ({C})",
)
def score_rollouts_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = score_rollouts(
        I.completions(spark, sf_dir), POLICY_RECIPE.rewards, POLICY_RECIPE.weights, normalize=True, advantage=False
    )
    return rows.select("completion_id", "reward_format", "reward_tag_count", rounded("reward").alias("reward"))
