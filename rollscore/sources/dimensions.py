"""Small fixed tables. Each has at most a few dozen rows by construction, so broadcasting it is safe."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Revision of every published checkpoint (experiment, step, commit).
REVISIONS = [
    (1, 100, "0439c48c3686728b5cc5a20820d601d2908c6ee1"),
    (1, 200, "26f1b83b6c41b2c1b6407648b0de08c09f92687c"),
    (1, 300, "52bf539b00ab80ff4f9b09092b242d56560e7259"),
    (1, 400, "998f5ed67e0457c504c49580d85d82de1bcb6f35"),
    (2, 50, "21e477217641fec6cd81f9caa220f5cccfb6a874"),
    (2, 100, "f653a8b948a6047011ee97b181ae0ad1d78d6e6a"),
    (2, 150, "e25175ada88bb8ef4187480b35631bf397196538"),
    (2, 200, "2cb5c97863c5936d88b571b4b7eaf7cbbaf5af2f"),
    (2, 250, "9d6ebc12f8d98824b3a072a930260a62f9189285"),
    (2, 300, "5e24d1cabac521742d1e6ebd244af9fc2fa91a89"),
    (2, 350, "195beba1db4d7a3539c0dc0223df9ce2486744d8"),
    (2, 400, "f3f07cd9f9b2abd8f8760dc4bef5b7165a940ffe"),
    (3, 50, "1793695d9e827f1024422af3698f9a070b935698"),
    (3, 100, "b224d0ff3f66ced97e621b2ad1eeafd53235240c"),
    (3, 150, "8c574c77d411bd3d39107a03d4f79db3838c5577"),
    (3, 200, "d91ed4d06af444d7213f8fc225a01c9d43e1ce18"),
    (3, 250, "7f3c01cb25ca20730f85a079787d859fd5c2be8f"),
    (3, 300, "6f19980625be4c3316c6919ef12bd168a97c7cf4"),
    (3, 350, "86ba8acb918d462e6a26f6866f573ded4afdde4a"),
    (3, 400, "e88c97c2c4035abf0e00091ce214d055aad2c270"),
]
# Task name, dataset (without owner), subset, split, prompt columns used, metric.
GENERATION_SIZE = 32768
TASKS = [
    ("aime24", "aime_2024", "default", "train", "aime", "expr_gold"),
    ("aime25", "aime_2025", "default", "train", "aime", "expr_gold"),
    ("math_500", "MATH-500", "default", "test", "math", "latex_gold"),
    ("gpqa:diamond", "gpqa", "gpqa_diamond", "train", "gpqa", "letters"),
    ("minerva", "Minerva-Math", "default", "train", "minerva", "latex_gold"),
    ("amc23", "AMC-23", "default", "train", "amc", "expr_gold"),
    ("olympiadbench", "OlympiadBench", "default", "train", "olympiadbench", "latex_gold"),
]
# Benchmarks that can be requested, with suite and task name.
BENCHMARKS = [
    ("math_500", "custom", "math_500"),
    ("aime24", "custom", "aime24"),
    ("aime25", "custom", "aime25"),
    ("gpqa", "custom", "gpqa:diamond"),
    ("lcb", "extended", "lcb:codegeneration"),
    ("lcb_v4", "extended", "lcb:codegeneration_v4"),
]
# Published averages in percent (model, experiment, step).
PUBLISHED = [(1, 1, 100, 53.0), (2, 2, 50, 55.7), (3, 3, 50, 56.3)]
# Published training set-up and costs in dollars.
BASE_COST, BASE_SAMPLES, BASE_GENERATIONS = 42.0, 7000, 6
BASELINE_COSTS = [
    ("Qwen2.5-7B-SimpleRL", "7B", 1633.0),
    ("Eurus-2-7B-PRIME", "7B", 1088.0),
    ("DeepScaleR-1.5B-Preview", "1.5B", 3629.0),
    ("Still-3-1.5B-Preview", "1.5B", 2268.0),
]


def dim_revisions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REVISIONS, "exp int, step int, revision string")


def dim_tasks(spark: SparkSession) -> DataFrame:
    rows = [("custom", *t, GENERATION_SIZE, 1) for t in TASKS]
    return spark.createDataFrame(
        rows,
        "suite string, task string, dataset string, subset string, split string, prompt string, metric string, "
        "generation_size int, version int",
    )


def dim_benchmarks(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BENCHMARKS, "benchmark string, suite string, task string")


def dim_published(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PUBLISHED, "model int, exp int, step int, published double")
