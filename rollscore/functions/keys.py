"""Small scalar helpers over task keys, model ids and checkpoint names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_col


def build_task_key(suite: Column | str, task: Column | str, fewshot: int = 0, truncate: int = 0) -> Column:
    return F.concat_ws("|", as_col(suite), as_col(task), F.lit(str(fewshot)), F.lit(str(truncate)))


def parse_task_key(key: Column | str) -> Column:
    """``suite|task[|fewshot[|truncate]]`` as a struct; parts that are not there are null."""
    parts = F.split(as_col(key), "\\|")
    return F.struct(
        F.try_element_at(parts, F.lit(1)).alias("suite"),
        F.try_element_at(parts, F.lit(2)).alias("task"),
        F.try_element_at(parts, F.lit(3)).try_cast("int").alias("fewshot"),
        F.try_element_at(parts, F.lit(4)).try_cast("int").alias("truncate"),
    )


def param_count(model_id: Column | str) -> Column:
    """Parameter count written in a model id (``42m``, ``1.5b``, ``8x7b``): the largest one, or -1."""
    size = r"\d+(?:\.\d+)?(?:x\d+(?:\.\d+)?)?[bm]"
    found = F.regexp_extract_all(F.lower(as_col(model_id)), F.lit(f"({size})"), F.lit(1))

    def value(text: Column) -> Column:
        unit = F.when(F.endswith(text, F.lit("b")), F.lit(1.0e9)).otherwise(F.lit(1.0e6))
        factors = F.split(F.regexp_replace(text, "[bm]$", ""), "x")
        product = F.aggregate(factors, F.lit(1.0), lambda acc, x: acc * x.cast("double"))
        return product * unit

    return F.coalesce(F.array_max(F.transform(found, value)).cast("bigint"), F.lit(-1).cast("bigint"))


def step_revision(revision: Column | str, step: Column | str) -> Column:
    return F.format_string("%s-step-%09d", as_col(revision), as_col(step).cast("bigint"))


def checkpoint_dir(output_dir: Column | str, step: Column | str) -> Column:
    return F.format_string("%s/checkpoint-%d", as_col(output_dir), as_col(step).cast("bigint"))
