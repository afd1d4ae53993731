"""Boosted trees for a quantile: the pinball loss, with leaf values that are exact order statistics of the residuals."""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from . import boosting

SEED = 42
#: rounds between two stored states of the training rows; each round adds one tree to the plan
STORE_EVERY = 8


def pinball_loss(label: str, predicted: str, share: float) -> Column:
    """Mean loss that the ``share`` quantile makes least."""
    error = F.col(label) - F.col(predicted)
    return F.avg(F.greatest(F.lit(share) * error, F.lit(share - 1) * error))


def order_statistics(df: DataFrame, group: str, value: str, share: float, bins: int = 256) -> dict:
    """Per group the least value with at least ``share`` of the group's values at or below it; exact.

    For few groups, such as the leaves of a tree, of any size: every pass cuts each group's range into ``bins`` and goes on inside
    the one that holds the wanted value, from its least to its greatest value, until they are equal. A pass brings at most
    ``bins`` rows per group to the driver and shuffles no values; NULL and NaN are left out.
    """
    values = df.select(F.col(group).alias("g"), F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    first = values.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
    found: dict = {}
    # 1e-9 keeps a product such as 0.1 * 30 from landing one place too far
    wanted = {r["g"]: (max(1, int(np.ceil(share * r["n"] - 1e-9))), r["lo"], r["hi"]) for r in first}
    while True:
        found |= {g: lo for g, (_, lo, hi) in wanted.items() if lo == hi}
        wanted = {g: w for g, w in wanted.items() if w[1] < w[2]}
        if not wanted:
            return found
        lo, hi = (F.create_map(*[F.lit(x) for g, w in wanted.items() for x in (g, float(w[side]))])[F.col("g")] for side in (1, 2))
        # halves, so that the width of the widest range is finite; the ends are always told apart
        part = F.nanvl((F.col("v") / 2 - F.col("lo") / 2) / F.nullif(F.col("hi") / 2 - F.col("lo") / 2, F.lit(0.0)), F.lit(0.5))
        place = (F.when(F.col("v") == F.col("lo"), 0).when(F.col("v") == F.col("hi"), bins - 1)
                 .otherwise(F.coalesce(F.floor(part * bins), F.lit(bins // 2))))
        inside = (values.select("g", "v", lo.alias("lo"), hi.alias("hi")).where((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
                  .groupBy("g", F.least(place, F.lit(bins - 1)).alias("place"))
                  .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect())
        narrowed = {}
        for row in sorted(inside, key=lambda r: r["place"]):
            g = row["g"]
            if g not in narrowed:
                ahead = wanted[g][0]
                if ahead <= row["n"]:
                    narrowed[g] = ahead, row["lo"], row["hi"]
                else:
                    wanted[g] = ahead - row["n"], *wanted[g][1:]
        wanted = narrowed


@dataclass(frozen=True)
class Tree:
    """Nodes in preorder; a leaf has children 0 and its value, an inner node goes left where ``feature <= threshold``."""

    feature: list[int]
    threshold: list[float]
    left: list[int]
    right: list[int]
    value: list[float]

    @staticmethod
    def of(model, leaf_values: dict[int, float], step: float) -> Tree:
        """Structure of a fitted tree; leaves are numbered from left to right, as Spark numbers them."""
        tree, leaves = Tree([], [], [], [], []), iter(range(1 << 30))

        def visit(node) -> int:
            me = len(tree.feature)
            inner = node.subtreeDepth() > 0
            tree.feature.append(node.split().featureIndex() if inner else 0)
            tree.threshold.append(node.split().threshold() if inner else 0.0)
            tree.value.append(0.0 if inner else step * leaf_values.get(next(leaves), 0.0))
            tree.left.append(0)
            tree.right.append(0)
            if inner:
                tree.left[me], tree.right[me] = visit(node.leftChild()), visit(node.rightChild())
            return me

        visit(model._call_java("rootNode"))
        return tree


@dataclass(frozen=True)
class QuantileModel:
    """``base`` plus the leaf values of all trees."""

    share: float
    base: float
    depth: int
    trees: list[Tree]

    def arrays(self) -> list[list[np.ndarray]]:
        return [[np.array(column) for column in (t.feature, t.threshold, t.left, t.right, t.value)] for t in self.trees]


def predicted(rows: DataFrame, models: dict[str, QuantileModel]) -> DataFrame:
    """``rows`` with a column per model in the place of ``features``; all trees in one Arrow pass."""
    kept = rows.drop("features")
    schema = T.StructType([*kept.schema.fields, *(T.StructField(name, T.DoubleType()) for name in models)])
    fitted = [(m.base, m.depth, m.arrays()) for m in models.values()]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            x, at_row, found = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(n, -1), np.arange(n), []
            for base, depth, trees in fitted:
                total = np.full(n, base)
                for feature, threshold, left, right, value in trees:
                    at = np.zeros(n, np.int64)
                    for _ in range(depth):
                        down = np.where(x[at_row, feature[at]] <= threshold[at], left[at], right[at])
                        at = np.where(left[at] > 0, down, at)
                    total += value[at]
                found.append(pa.array(total))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *found], names=[f.name for f in schema.fields])

    return rows.select(*kept.columns, vector_to_array("features").alias("__features")).mapInArrow(score, schema)


def train_quantile_model(train: DataFrame, share: float, label: str = "label", rounds: int = 200, depth: int = 4, step: float = 0.05,
                         seed: int = SEED) -> QuantileModel:
    """Boosting with the pinball loss over ``features``.

    Each round fits Spark's regression tree to the loss's gradient, which is ``share`` above the prediction so far and ``share - 1``
    below, and then gives every leaf the exact ``share`` quantile of its residuals times ``step``, as the gradient has only two values and
    says nothing about their size. Where one task holds the rows it grows all trees; otherwise rows are stored every few rounds, so the plan
    stays short and a lost executor costs few trees.
    """
    shape = boosting.in_one_task(train, label) if rounds else None
    if shape:
        grown = boosting.quantile_trees(train, shape, label, share, rounds, depth, step).collect()
        return QuantileModel(share, grown[0]["base"], depth, [Tree(r["feature"], r["threshold"], r["left"], r["right"], r["value"]) for r in grown])
    # without attributes every split is a threshold
    plain = train.select(F.col("features").alias("features", metadata={}), F.col(label).cast("double").alias("y"))
    base = order_statistics(plain.withColumn("g", F.lit(0)), "g", "y", share).get(0, 0.0)
    rows = materialize(plain.withColumn("predicted", F.lit(base)), "quantile-rows")
    trees: list[Tree] = []
    for number in range(0 if rows.isEmpty() else rounds):
        pulled = rows.withColumn("gradient", F.when(F.col("y") > F.col("predicted"), share).otherwise(share - 1))
        tree = DecisionTreeRegressor(featuresCol="features", labelCol="gradient", predictionCol="mean", leafCol="leaf", maxDepth=depth,
                                     seed=seed + number).fit(pulled)
        placed = tree.transform(rows).withColumn("leaf", F.col("leaf").cast("int")).withColumn("residual", F.col("y") - F.col("predicted"))
        values = order_statistics(placed, "leaf", "residual", share)
        trees.append(Tree.of(tree, values, step))
        moved = F.create_map(*[F.lit(x) for leaf, value in values.items() for x in (leaf, step * value)])[F.col("leaf")]
        rows = placed.select("features", "y", (F.col("predicted") + moved).alias("predicted"))
        if number % STORE_EVERY == STORE_EVERY - 1:
            rows = materialize(rows, "quantile-rows")
    return QuantileModel(share, base, depth, trees)


@dataclass(frozen=True)
class QuantileBand:
    """Two quantile models as an interval around a point prediction."""

    lower: QuantileModel
    upper: QuantileModel

    def apply(self, scored: DataFrame) -> DataFrame:
        """``scored`` with ``q_lower`` and ``q_upper`` as predicted, none below zero, and ``ci_lower`` and ``ci_upper``, which also hold
        ``prediction``; ``features`` goes."""
        none, both = F.lit(0.0), predicted(scored, {"q_lower": self.lower, "q_upper": self.upper})
        return bounded(both.withColumns({"q_lower": F.greatest("q_lower", none), "q_upper": F.greatest("q_upper", none)}))


def bounded(scored: DataFrame) -> DataFrame:
    """Models fitted apart may cross: the interval always holds the point."""
    return scored.withColumns({"ci_lower": F.least("q_lower", "prediction"), "ci_upper": F.greatest("q_upper", "prediction")})


def train_quantile_band(train: DataFrame, label: str = "label", lower: float = 0.1, upper: float = 0.9, **settings) -> QuantileBand:
    """Both models are fitted at the same time, as their small jobs leave room."""
    with ThreadPoolExecutor(2) as pool:
        models = list(pool.map(lambda share: train_quantile_model(train, share, label, **settings), (lower, upper)))
    return QuantileBand(*models)


def band_metrics(scored: DataFrame, label: str = "label", lower: float = 0.1, upper: float = 0.9) -> DataFrame:
    """Coverage of the predicted quantiles, their pinball losses, mean width of the interval and how many rows crossed."""
    inside = (F.col(label) >= F.col("q_lower")) & (F.col(label) <= F.col("q_upper"))
    crossed = (F.col("q_lower") > F.col("prediction")) | (F.col("q_upper") < F.col("prediction"))
    return scored.agg(F.avg(inside.cast("int")).alias("coverage"), pinball_loss(label, "q_lower", lower).alias("loss_lower"),
                      pinball_loss(label, "q_upper", upper).alias("loss_upper"), F.avg(F.col("ci_upper") - F.col("ci_lower")).alias("mean_width"),
                      F.count_if(crossed).alias("crossed"))

