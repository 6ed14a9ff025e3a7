"""Training and scoring: clean, split, scale, boosted trees, threshold, metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.session import shared_root

# Fixed values of a training run.
ROUNDS = 20
CHECKPOINT_EVERY = 10
THRESHOLD = 0.5
SMALLEST_PROBABILITY = 1e-16


def numeric_columns(df: DataFrame, target: str = "target", keep: Sequence[str] = ()) -> DataFrame:
    """All columns as numbers, what is none becomes NULL; the target becomes an int."""
    return df.select(*[
        F.col(c) if c in keep
        else F.col(c).try_cast("double").try_cast("int").alias(c) if c == target
        else F.col(c).try_cast("double").alias(c)
        for c in df.columns
    ])


def scaler_stats(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with mean and population deviation of each column."""
    return train.agg(*[
        f(c).alias(f"{c}_{name}")
        for c in columns for f, name in ((F.avg, "mean"), (F.stddev_pop, "std"))
    ])


def scaled(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Standardise the columns of ``stats``; a deviation of zero divides by one."""
    row = stats.first().asDict()
    columns = [c[: -len("_mean")] for c in stats.columns if c.endswith("_mean")]
    return df.withColumns({c: _standard(F.col(c), row, c) for c in columns})


def _standard(column: Column, row: dict, name: str) -> Column:
    return (column - F.lit(row[f"{name}_mean"])) / F.lit(row[f"{name}_std"] or 1.0)


def preparation(row: dict, features: Sequence[str], scale: Sequence[str] = ()) -> tuple[SQLTransformer, VectorAssembler]:
    """Missing-value fill and scaling by the statistics of ``scaler_stats``, and the vector of the results."""
    prepared = []
    for c in features:
        mean = float(row[f"{c}_mean"] if row[f"{c}_mean"] is not None else 0.0)
        filled = f"coalesce(cast(`{c}` as double), double('{mean!r}'))"
        if c in scale:
            deviation = float(row[f"{c}_std"] or 1.0)
            filled = f"({filled} - double('{mean!r}')) / double('{deviation!r}')"
        prepared.append(f"{filled} AS `_in_{c}`")
    prepare = SQLTransformer(statement=f"SELECT *, {', '.join(prepared)} FROM __THIS__")
    return prepare, VectorAssembler(inputCols=[f"_in_{c}" for c in features], outputCol="features")


def fit_model(
    train: DataFrame,
    target: str = "target",
    scale: Sequence[str] = (),
    seed: int = 7,
    rounds: int = ROUNDS,
) -> PipelineModel:
    """Scaler, missing-value fill and boosted trees as one model for raw rows.

    Statistics come from the training rows only and are one row, whatever the
    size of the data. Missing features take the training mean.
    """
    spark = train.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))
    features = [c for c in train.columns if c != target]
    prepare, assemble = preparation(scaler_stats(train, features).first().asDict(), features, scale)
    ready = assemble.transform(prepare.transform(train.where(F.col(target).isNotNull())))
    booster = GBTClassifier(
        labelCol=target, featuresCol="features", maxIter=rounds, seed=seed,
        checkpointInterval=CHECKPOINT_EVERY,
    )
    model = booster.fit(ready.select(target, "features"))
    return PipelineModel(stages=[prepare, assemble, model])


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Raw rows without label plus ``score``, the probability of class 1."""
    scored = model.transform(rows)
    return scored.select(*rows.columns, vector_to_array("probability")[1].alias("score"))


def predicted_label(score_column: Column, threshold: float = THRESHOLD) -> Column:
    return (score_column > threshold).cast("int")


def metrics(scored: DataFrame, target: str = "target", score_column: str = "score") -> DataFrame:
    """Log loss and error rate in one row."""
    y = F.col(target).cast("double")
    p = F.col(score_column)
    hit = F.log(F.greatest(p, F.lit(SMALLEST_PROBABILITY)))
    miss = F.log(F.greatest(F.lit(1.0) - p, F.lit(SMALLEST_PROBABILITY)))
    wrong = (predicted_label(p) != F.col(target)).cast("int")
    return scored.agg(
        F.avg(-(y * hit + (F.lit(1.0) - y) * miss)).alias("logloss"), F.avg(wrong).alias("error")
    )


def save_model(model: PipelineModel, path: str) -> None:
    """Keep one copy: a new run replaces the old one."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
