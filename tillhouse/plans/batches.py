"""Functions on Arrow batches, with state that is set up once per task, and a predictor made of a stored model.

What a function gets is one batch, whatever the size of its partition. Needs pyarrow and numpy in the workers; the code
of this module travels with the functions, so executors need not have the package.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from typing import Any

from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def map_batches(
    df: DataFrame, function: Callable[..., Any], schema: T.StructType | str, setup: Callable[[], Any] | None = None,
    batch_rows: int | None = None,
) -> DataFrame:
    """``function(batch)``, or ``function(batch, state)`` with ``setup``, applied to Arrow batches.

    It returns a record batch of ``schema`` with any number of rows. ``setup`` runs once in every task that has rows,
    before its first batch. Batches have ``batch_rows`` rows at most; without it Spark's setting holds.
    """

    def run(batches: Iterator) -> Iterator:
        state, ready = None, setup is None
        for batch in batches:
            for at in range(0, batch.num_rows, batch_rows or max(1, batch.num_rows)):
                if not ready:
                    state, ready = setup(), True
                piece = batch.slice(at, batch_rows) if batch_rows else batch
                yield function(piece) if setup is None else function(piece, state)

    return df.mapInArrow(run, schema)


def stored_trees(spark: SparkSession, path: str) -> tuple[PipelineModel, list[tuple]]:
    """A kept model of boosted trees and its nodes: tree, share, node, prediction, feature, limit, left and right child.

    As many rows as the model has nodes: rounds times 2 to the power of the depth, twice, at most.
    """
    model = PipelineModel.load(path)
    booster = model.stages[-1]
    digits = len(str(len(model.stages)))
    folder = f"{path.rstrip('/')}/stages/{len(model.stages) - 1:0{digits}d}_{booster.uid}/data"
    shares = booster.treeWeights
    node = F.col("nodeData")
    rows = spark.read.parquet(folder).select(
        "treeID", node["id"], node["prediction"], node["split"]["featureIndex"],
        F.try_element_at(node["split"]["leftCategoriesOrThreshold"], F.lit(1)), node["leftChild"], node["rightChild"]).collect()
    return model, [(r[0], float(shares[r[0]]), *r[1:]) for r in rows]


class TreePredictor:
    """Sums of boosted trees for whole batches: all rows go down a tree level by level."""

    def __init__(self, nodes: list[tuple]):
        import numpy as np

        nodes = sorted(nodes, key=lambda n: (n[0], n[2]))
        start: dict[int, int] = {}
        for at, n in enumerate(nodes):
            start.setdefault(n[0], at)
        self.roots = [(at, nodes[at][1]) for at in start.values()]
        self.prediction = np.array([n[3] for n in nodes], float)
        self.feature = np.array([n[4] for n in nodes], int)
        self.limit = np.array([0.0 if n[5] is None else n[5] for n in nodes], float)
        # A leaf is its own child.
        self.left, self.right = (
            np.array([start[n[0]] + n[side] if n[side] >= 0 else at for at, n in enumerate(nodes)], int) for side in (6, 7))

    def probabilities(self, features):
        """``features`` has a row for each row of the batch."""
        import numpy as np

        rows = np.arange(len(features))
        total = np.zeros(len(features))
        for root, share in self.roots:
            at, before = np.full(len(features), root), None
            while before is None or (at != before).any():
                before = at
                goes_left = features[rows, np.maximum(self.feature[at], 0)] <= self.limit[at]
                at = np.where(goes_left, self.left[at], self.right[at])
            total += share * self.prediction[at]
        return 1 / (1 + np.exp(-2 * total))


def score_batches(spark: SparkSession, path: str, rows: DataFrame, set_up: Callable[[], None] | None = None) -> DataFrame:
    """``rows`` plus ``score`` by the model kept at ``path``, as ``training.score`` gives it.

    Missing values and scales are Spark expressions; the trees are set up once per task and score whole batches.
    ``set_up`` is called where this happens.
    """
    model, nodes = stored_trees(spark, path)
    prepare, assemble = model.stages[0], model.stages[1]
    inputs, names = assemble.getInputCols(), rows.columns
    ready = prepare.transform(rows).select(*names, *inputs)

    def predictor() -> TreePredictor:
        if set_up:
            set_up()
        return TreePredictor(nodes)

    def predict(batch, trees: TreePredictor):
        import numpy as np
        import pyarrow as pa

        features = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in inputs]) if inputs else np.zeros((batch.num_rows, 0))
        kept = [batch.column(i) for i in range(batch.num_columns - len(inputs))]
        return pa.RecordBatch.from_arrays([*kept, pa.array(trees.probabilities(features))], names=[*names, "score"])

    return map_batches(ready, predict, T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType())]), predictor)
