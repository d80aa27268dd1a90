"""Inputs of the registered queries, derived from the given tables, each with its SQL twin.

The raw text has no tags, boxes, code fences or steps, so rewards run on completions that wrap the real conversation
turns in those forms. Evaluation samples come from the event table, recorded code runs from the line items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.evaluation import content_digest
from ..sources.tables import read_table

COMPLETIONS_SQL = r"""
select a.conv_id*100 + a.turn as completion_id, a.conv_id as prompt_id, a.turn, u.text as problem,
  cast((a.conv_id*13)%50 as varchar) as solution,
  case (a.conv_id*7 + a.turn) % 6
    when 0 then concat('<think>',chr(10),a.text,chr(10),'</think>',chr(10),'<answer>',chr(10),x.box,chr(10),'</answer>')
    when 1 then concat('1. ',a.text,chr(10),'</think>',chr(10),x.box)
    when 2 then concat('<think>',chr(10),'Step 1: ',a.text,chr(10),'Step 2: ',a.text,chr(10),'Step 3: done',chr(10),
      '</think>',chr(10),x.box)
    when 3 then a.text
    when 4 then concat('First, ',a.text,chr(10),'</think>',chr(10),'</think>',chr(10),'</think>',chr(10),x.box)
    else concat('<think>',chr(10),'<think>',chr(10),a.text,' ',a.text,chr(10),'</think>',chr(10),x.box)
  end as content
from conversations a
join conversations u on a.conv_id = u.conv_id and u.turn = a.turn-1 and u.role = 'user'
join (select conv_id, turn,
        concat(chr(92),'boxed{',cast((conv_id*13)%50 + case when (conv_id+turn)%3=0 then 0 else 1 end as varchar),'}')
          as box
      from conversations) x on x.conv_id = a.conv_id and x.turn = a.turn
where a.role = 'assistant'
"""


COMPLETION_FORMS = r"""
case (conv_id * 7 + turn) % 6
  when 0 then concat('<think>\n', text, '\n</think>\n<answer>\n', box, '\n</answer>')
  when 1 then concat('1. ', text, '\n</think>\n', box)
  when 2 then concat('<think>\nStep 1: ', text, '\nStep 2: ', text, '\nStep 3: done\n</think>\n', box)
  when 3 then text
  when 4 then concat('First, ', text, '\n</think>\n</think>\n</think>\n', box)
  else concat('<think>\n<think>\n', text, ' ', text, '\n</think>\n', box)
end
"""


def completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assistant turns as scored completions of the user turn before them.

    The self-join runs on (conversation, turn), so a very long conversation is spread by its turns.
    """
    turns = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    users = turns.where("role = 'user'").selectExpr("conv_id", "turn + 1 as turn", "text as problem")
    replies = turns.where("role = 'assistant'").selectExpr(
        "conv_id",
        "turn",
        "text",
        "(conv_id * 13) % 50 as answer",
        r"concat('\\boxed{', (conv_id * 13) % 50 + if((conv_id + turn) % 3 = 0, 0, 1), '}') as box",
    )
    return replies.join(users, ["conv_id", "turn"]).selectExpr(
        "conv_id * 100 + turn as completion_id",
        "conv_id as prompt_id",
        "turn",
        "problem",
        "cast(answer as string) as solution",
        f"{COMPLETION_FORMS} as content",
    )


GRADED_SQL = rf"""
graded as (
  select *, regexp_extract_all(content, '\\boxed\{{([^{{}}]*)\}}', 1)[-1] as pred from ({COMPLETIONS_SQL})
), scored as (select *, coalesce(pred = solution, false) as is_correct from graded)
"""

CODE_SQL = r"""
select completion_id, prompt_id, turn, body,
  case completion_id % 7
    when 0 then concat('<think>', chr(10), body, chr(10), '</think>', chr(10), '<answer>', chr(10), py, chr(10), '</answer>')
    when 1 then concat('<think>', chr(10), body, chr(10), '</think>', chr(10), '<answer>', chr(10), py, chr(10), '</answer>',
      chr(10), 'more')
    when 2 then concat('Well. <think>', chr(10), body, chr(10), '</think>', chr(10), '<answer>', chr(10), py, chr(10), '</answer>')
    when 3 then concat('<think>', chr(10), body, chr(10), '</think>', chr(10), '<answer>', chr(10), py, chr(10),
      '```python', chr(10), 'print("', body, '")', chr(10), '```', chr(10), '</answer>')
    when 4 then concat('<think>', chr(10), body, chr(10), '</think>', chr(10), '<answer>', chr(10), body, chr(10), '</answer>')
    when 5 then concat('<think>', chr(10), body, chr(10), '</think>', chr(10), py)
    else concat('<think>', chr(10), body, chr(10), '</think>', chr(10), '<answer>', chr(10), py, ' </answer> trailing')
  end as content
from (select conv_id*100 + turn as completion_id, conv_id as prompt_id, turn, text as body,
        concat('```python', chr(10), 'print(', cast(turn as varchar), ')', chr(10), '```') as py
      from conversations where role = 'assistant')
"""


CODE_FORMS = r"""
case completion_id % 7
  when 0 then concat(think, '<answer>\n', py, '\n</answer>')
  when 1 then concat(think, '<answer>\n', py, '\n</answer>\nmore')
  when 2 then concat('Well. ', think, '<answer>\n', py, '\n</answer>')
  when 3 then concat(think, '<answer>\n', py, '\n```python\nprint("', body, '")\n```\n</answer>')
  when 4 then concat(think, '<answer>\n', body, '\n</answer>')
  when 5 then concat(think, py)
  else concat(think, '<answer>\n', py, ' </answer> trailing')
end
"""


def code_completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assistant turns as code completions: right and wrong tag orders, two blocks, no block, text in front."""
    turns = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    parts = turns.where("role = 'assistant'").selectExpr(
        "conv_id * 100 + turn as completion_id",
        "conv_id as prompt_id",
        "turn",
        "text as body",
        r"concat('```python\nprint(', turn, ')\n```') as py",
        r"concat('<think>\n', text, '\n</think>\n') as think",
    )
    return parts.selectExpr("completion_id", "prompt_id", "turn", "body", f"{CODE_FORMS} as content")


# Which benchmark each event type stands for in the derived evaluation samples.
TASK_OF_EVENT = {
    "click": "aime24",
    "view": "math_500",
    "signup": "amc23",
    "error": "minerva",
    "purchase": "olympiadbench",
}
TASK_NAMES = list(TASK_OF_EVENT.values())

SAMPLES_SQL = (
    "select case when (user_id // 30) % 5 = 4 then 'overall' else 'evals' end as suite, "
    "cast(user_id % 3 + 1 as integer) as exp, cast(50 * ((user_id // 3) % 10 + 1) as integer) as step, "
    "user_id as run_id, timestamp '2025-03-14 00:00:00' + to_seconds(user_id) as run_ts, case event_type "
    + " ".join(f"when '{e}' then '{t}'" for e, t in TASK_OF_EVENT.items())
    + " end as task, event_id as sample_id, case when value >= 40.0 then 1.0::double else 0.0::double end as score, "
    "value, props from events"
)


def eval_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as evaluated samples: a user is one run of a checkpoint, an event type is a task."""
    events = read_table(spark, sf_dir, "events", "event_id", "user_id", "event_type", "value", "props")
    user = F.col("user_id")
    group = F.floor(user / 30)
    task = F.element_at(F.create_map(*[F.lit(x) for kv in TASK_OF_EVENT.items() for x in kv]), F.col("event_type"))
    return events.select(
        F.when(group % 5 == 4, "overall").otherwise("evals").alias("suite"),
        (user % 3 + 1).cast("int").alias("exp"),
        (50 * (F.floor(user / 3) % 10 + 1)).cast("int").alias("step"),
        user.alias("run_id"),
        F.expr("timestamp_ntz'2025-03-14 00:00:00' + make_dt_interval(0, 0, 0, user_id)").alias("run_ts"),
        task.alias("task"),
        F.col("event_id").alias("sample_id"),
        F.when(F.col("value") >= 40.0, 1.0).otherwise(0.0).alias("score"),
        "value",
        "props",
    )


def digest_sql(expr: str) -> str:
    return f"bit_xor(('0x' || substr(md5({expr}), 1, 15))::bigint)"


RUNS_SQL = f"""
select suite, exp, step, run_id, run_ts, task, concat('custom|', task, '|0') as task_key, avg(score) as score,
  stddev_samp(score) / sqrt(count(*)) as stderr, count(*) as n_docs, count(*) as original_docs,
  sum(value) as seconds, concat('model-', exp, 'b') as model_name,
  {digest_sql("props")} % 3 as prompt_hash, {digest_sql("concat(sample_id, '|', score)")} as cont_hash,
  count(*) filter (value > 200.0) as truncated, count(*) filter (value <= 200.0) as non_truncated,
  count(*) filter (value < 5.0) as padded, count(*) filter (value >= 5.0) as non_padded
from ({SAMPLES_SQL}) group by suite, exp, step, run_id, run_ts, task
"""


def eval_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples aggregated to one row per (run, task), in the columns of the result-log scan."""
    digest = F.bit_xor(content_digest("props")) % 3
    outputs = F.bit_xor(content_digest(F.concat_ws("|", F.col("sample_id"), F.col("score").cast("string"))))
    keys = ["suite", "exp", "step", "run_id", "run_ts", "task"]
    return (
        eval_samples(spark, sf_dir)
        .groupBy(*keys)
        .agg(
            F.avg("score").alias("score"),
            (F.stddev_samp("score") / F.sqrt(F.count(F.lit(1)))).alias("stderr"),
            F.count(F.lit(1)).alias("n_docs"),
            F.count(F.lit(1)).alias("original_docs"),
            F.sum("value").alias("seconds"),
            digest.cast("string").alias("hash_full_prompts"),
            outputs.cast("string").alias("hash_cont_tokens"),
            F.count_if(F.col("value") > 200.0).alias("truncated"),
            F.count_if(F.col("value") <= 200.0).alias("non_truncated"),
            F.count_if(F.col("value") < 5.0).alias("padded"),
            F.count_if(F.col("value") >= 5.0).alias("non_padded"),
        )
        .withColumn("task_key", F.concat(F.lit("custom|"), F.col("task"), F.lit("|0")))
        .withColumn("model_name", F.concat(F.lit("model-"), F.col("exp"), F.lit("b")))
    )


LABELED_SQL = """
select d.doc_id, d.source as task, d.lang as suite, cast(l.quality as double) as score, l.toxic
from documents d join labels l on d.doc_id = l.doc_id
"""


def labeled_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labeled documents as scored samples: source is the task, quality the score. The join key is unique."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "source", "lang")
    labels = read_table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    return docs.join(labels, "doc_id").select(
        "doc_id",
        F.col("source").alias("task"),
        F.col("lang").alias("suite"),
        F.col("quality").cast("double").alias("score"),
        "toxic",
    )


CODE_RUNS_SQL = """
select l_orderkey as completion_id, l_linenumber as case_id,
  case when l_returnflag = 'R' and l_partkey % 5 = 0 then 1 else 0 end as returncode,
  l_suppkey % 97 = 0 as timed_out,
  concat(cast(cast(l_quantity as integer) as varchar), chr(10), cast(l_linenumber as varchar)) as expected,
  case l_partkey % 6
    when 0 then cast(cast(l_quantity as integer) as varchar)
    when 1 then concat('  ', cast(cast(l_quantity as integer) as varchar), ' ', chr(10), cast(l_linenumber as varchar),
      chr(10), 'extra', chr(10))
    when 2 then ''
    when 3 then concat(cast(cast(l_quantity as integer) as varchar), chr(10), 'x')
    else concat(cast(cast(l_quantity as integer) as varchar), chr(10), cast(l_linenumber as varchar), chr(10))
  end as stdout
from lineitem
"""


def code_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as recorded test runs: an order is a completion, a line is a test case."""
    items = read_table(
        spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_partkey", "l_suppkey", "l_quantity",
        spread=True,
    )
    value, line = F.col("l_quantity").cast("int").cast("string"), F.col("l_linenumber").cast("string")
    form = F.col("l_partkey") % 6
    stdout = (
        F.when(form == 0, value)
        .when(form == 1, F.concat(F.lit("  "), value, F.lit(" \n"), line, F.lit("\nextra\n")))
        .when(form == 2, F.lit(""))
        .when(form == 3, F.concat(value, F.lit("\nx")))
        .otherwise(F.concat(value, F.lit("\n"), line, F.lit("\n")))
    )
    return items.select(
        F.col("l_orderkey").alias("completion_id"),
        F.col("l_linenumber").alias("case_id"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_partkey") % 5 == 0), 1).otherwise(0).alias("returncode"),
        (F.col("l_suppkey") % 97 == 0).alias("timed_out"),
        F.concat(value, F.lit("\n"), line).alias("expected"),
        stdout.alias("stdout"),
    )


ALGEBRA_SQL = """
select l_orderkey * 8 + l_linenumber as row_id, l_partkey % 59 + 2 as a, l_suppkey % 47 + 3 as b,
  l_quantity::bigint % 45 + 2 as c, (l_linenumber % 3 = 0)::int as d from lineitem
"""

#: Gold answer and answer by form, from whole numbers a, b and c; they are equal where d is 0.
ALGEBRA_FORMS = [
    (r"concat('\\frac{', a, '}{', b, '}+x')", r"concat('(', a + d, '+', b, 'x)/', b)"),
    ("concat('(x+', a, ')(x-', b, ')')", "concat('x^2+(', a - b + d, ')x-', a * b)"),
    (r"concat('\\sqrt{', a * a * c, '}')", r"concat(a + d, '\\sqrt{', c, '}')"),
    (r"concat('\\dfrac{', a, '}{', b, '}')", "concat('(', a * c + d, ')(', b * c, ')^{-1}')"),
    ("concat('2^{x+', a, '}')", r"concat('2^{', a + d, '}\\cdot 2^x')"),
    (r"concat('\\frac{', a, '}{100}x')", r"concat(a + d, '\\%x')"),
    ("concat(a, '-(', b, '-x)')", "concat('x-', b, '+', a + d)"),
    (r"concat('\\sqrt[3]{', a * a * a * c, '}')", r"concat(a + d, '\\sqrt[3]{', c, '}')"),
    (r"'$(x+y)^3$'", "concat('x^3+3x^2y+', 3 + d, 'xy^2+y^{3}')"),
    (r"concat('\\frac{', a, r'}{\pi}')", r"concat(a, '\\pi^{', d - 1, '}')"),
]
STRUCTURED_FORMS = [
    (r"concat('\\{', a, ',', b, ',', c, '\\}')", r"concat('\\{', c, ',', a, ',', b + d, '\\}')"),
    ("concat('[', a, ',', a + b, ']')", "concat(if(d = 1, '(', '['), a, ', ', 2 * a + 2 * b, '/2]')"),
    ("concat('(', a, ',', b, ')')", r"if(d = 1, concat('(', b, ',', a, ')'), concat('\\left(\\frac{', 2 * a, '}{2},', b, '\\right)'))"),
    (
        r"concat(r'\begin{pmatrix}', a, '&', b, r'\\', c, r'&1\end{pmatrix}')",
        r"concat(r'\begin{bmatrix}', a, ' & ', b + d, r' \\ ', c, r' & 1\end{bmatrix}')",
    ),
    (r"concat(r'(-\infty,', a, r')\cup[', a + b, r',\infty)')", r"concat('[', a + b + d, r',+\infty)\cup(-\infty,', a, ')')"),
    ("concat(a, ',', b)", r"concat('\\{', b + d, ', ', a, '\\}')"),
    ("cast(a as string)", "concat('x=', a + d)"),
    (r"concat(r'\{(', a, ',', b, '),(', c, r',1)\}')", r"concat(r'\{(', c, ',1),(', a, ',', b + d, r')\}')"),
]


def answer_pairs(spark: SparkSession, sf_dir: str, forms: list[tuple[str, str]]) -> DataFrame:
    """Line items as gold answers and completions whose boxed answer says the same in another form, or nearly the same."""
    rows = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", spread=True).selectExpr(
        "l_orderkey * 8 + l_linenumber as row_id",
        "l_partkey % 59 + 2 as a",
        "l_suppkey % 47 + 3 as b",
        "cast(l_quantity as bigint) % 45 + 2 as c",
        "if(l_linenumber % 3 = 0, 1, 0) as d",
    ).withColumn("form", (F.col("row_id") % len(forms)).cast("int"))

    def of_form(side: int) -> Column:
        # Only the text of the row's own form is made; forms below 0 count from the end.
        texts, n = [F.expr(f[side]) for f in forms], len(forms) + 1
        return F.coalesce(*[F.when(F.col("form").isin(i, i - n), text) for i, text in enumerate(texts)])

    solution, answer = of_form(0), of_form(1)
    return rows.select("row_id", "form", solution.alias("solution"), F.concat(F.lit("So it is \\boxed{"), answer, F.lit("}")).alias("content"))
