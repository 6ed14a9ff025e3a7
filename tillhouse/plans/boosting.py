"""Boosted trees trained in stages whose state is kept, so that a run that was stopped goes on where it was.

Each round fits one regression tree to the gradients of the log loss. After every few rounds the trees and the rows
with their sums so far are written to a new folder, which is renamed when it is complete; then the folder before it goes.
A run that was never stopped reads its own folders in the same way, so it can't differ from one that was. Gradients
are rounded to binary fractions, whose sums do not depend on the order of the tasks.

A stage reads its rows once per level of a tree; the trees of earlier stages aren't evaluated again.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.plans.training import CHECKPOINT_EVERY, ROUNDS, preparation, scaler_stats
from tillhouse.sources.paths import remove, replace_folder, subfolders

DEPTH = 5
STEP = 0.1  # share of every tree but the first
FRACTION = 2.0**16  # gradients are multiples of its inverse


def _share(tree: int) -> float:
    return STEP if tree else 1.0


def _folder(path: str, rounds: int) -> str:
    return f"{path.rstrip('/')}/round-{rounds:05d}"


def rounds_kept(spark: SparkSession, path: str) -> list[int]:
    """After how many rounds the complete folders were written, in order."""
    names = [n.removeprefix("round-") for n in subfolders(spark, path) if n.startswith("round-")]
    return sorted(int(n) for n in names if n.isdecimal())


def _keep(spark: SparkSession, path: str, rounds: int, settings: dict, rows: DataFrame, stages: list) -> None:
    def write(new: str) -> None:
        rows.write.parquet(f"{new}/rows")
        spark.range(1).select(F.lit(json.dumps(settings)).alias("value")).coalesce(1).write.text(f"{new}/settings")
        PipelineModel(stages=stages).save(f"{new}/model")

    before = rounds_kept(spark, path)
    replace_folder(spark, _folder(path, rounds), write)
    for old in before:
        if old != rounds:
            remove(spark, _folder(path, old))


def _same(kept, given) -> bool:
    if isinstance(kept, dict):
        return kept.keys() == given.keys() and all(_same(kept[k], given[k]) for k in kept)
    if isinstance(kept, float) and isinstance(given, float):
        return math.isclose(kept, given, rel_tol=1e-9, abs_tol=1e-12)
    return kept == given


def fit_in_stages(
    train: DataFrame, path: str, target: str = "target", scale: Sequence[str] = (), seed: int = 7,
    rounds: int = ROUNDS, every: int = CHECKPOINT_EVERY, stop_after: int | None = None,
) -> PipelineModel | None:
    """A model for raw rows, trained from the latest folder below ``path``, or from the start where there is none.

    ``stop_after`` ends the run after so many of its rounds, at the next folder, and returns nothing unless all are done.
    Settings or training rows other than those of the kept folder are refused.
    """
    spark = train.sparkSession
    features = [c for c in train.columns if c != target]
    labelled = train.where(F.col(target).isNotNull())
    stats = scaler_stats(labelled, features).crossJoin(labelled.agg(F.count(F.lit(1)).alias("_rows"))).first().asDict()
    settings = {"target": target, "features": features, "scale": list(scale), "seed": seed, "every": every, "stats": stats}
    if not rounds_kept(spark, path):
        prepare, assemble = preparation(stats, features, scale)
        ready = assemble.transform(prepare.transform(labelled)).select(
            (F.col(target).cast("double") * 2 - 1).alias("_sign"), "features", F.lit(0.0).alias("_sum"))
        _keep(spark, path, 0, settings, ready, [prepare, assemble])
    done = first = rounds_kept(spark, path)[-1]
    if not _same(json.loads(spark.read.text(f"{_folder(path, done)}/settings").first().value), settings):
        raise ValueError(f"{path} holds the rounds of a run with other settings or rows")
    while done < rounds and (stop_after is None or done - first < stop_after):
        done = _stage(spark, path, settings, done, min(rounds, done + every), seed)
    stages = PipelineModel.load(f"{_folder(path, done)}/model").stages
    return None if done < rounds else PipelineModel(stages=[*stages, _summed(done)])


def _stage(spark: SparkSession, path: str, settings: dict, done: int, until: int, seed: int) -> int:
    folder = _folder(path, done)
    rows, stages = spark.read.parquet(f"{folder}/rows"), list(PipelineModel.load(f"{folder}/model").stages)
    for number in range(done, until):
        sign, so_far = F.col("_sign"), F.col("_sum")
        gradient = 4 * sign / (1 + F.exp(2 * sign * so_far)) if number else sign
        aims = rows.select("features", (F.round(gradient * FRACTION) / FRACTION).alias("_aim"))
        tree = DecisionTreeRegressor(
            labelCol="_aim", featuresCol="features", predictionCol=f"_tree_{number}", maxDepth=DEPTH, seed=seed + number).fit(aims)
        rows = tree.transform(rows).select(
            "_sign", "features", (so_far + _share(number) * F.col(f"_tree_{number}")).alias("_sum"))
        stages.append(tree)
    _keep(spark, path, until, settings, rows, stages)
    return until


def _summed(trees: int) -> SQLTransformer:
    total = " + ".join(f"double('{_share(n)!r}') * `_tree_{n}`" for n in range(trees)) or "double('0')"
    return SQLTransformer(statement=f"SELECT *, 1 / (1 + exp(-2 * ({total}))) AS `_score` FROM __THIS__")


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Raw rows without label plus ``score``, the probability of class 1."""
    return model.transform(rows).select(*rows.columns, F.col("_score").alias("score"))
