"""Order statistics and quantile models."""

import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from patronage.operators import modelling, quantiles


@pytest.mark.parametrize("share", [0.0, 0.1, 0.5, 0.9, 1.0])
def test_order_statistics_are_those_of_sorted_values(spark, share):
    draw = random.Random(3)
    rows = [(g, draw.choice([0.0, 1.5, -2.25, 1e300, -1e300, 5e-324, draw.random(), draw.gauss(0, 1e6)])) for g in range(4) for _ in range(300)]
    rows += [(5, 7.0)] * 20 + [(6, 0.0), (6, 5e-324), (7, None), (0, None), (1, float("nan"))] + [(8, 1 + i * 2.0 ** -52) for i in range(9)]
    df = spark.createDataFrame(rows, "g int, v double")
    wanted = {}
    for g in {g for g, _ in rows}:
        values = sorted(v for h, v in rows if h == g and v is not None and v == v)
        if values:
            wanted[g] = values[max(1, int(np.ceil(share * len(values) - 1e-9))) - 1]
    for bins in (2, 256):
        assert quantiles.order_statistics(df, "g", "v", share, bins) == wanted


def uneven(spark, n, seed):
    """The spread of the label depends on x1, its middle on x0."""
    noise = F.rand(seed + 3) - 0.5
    df = spark.range(0, n, 1, 8).select("id", F.rand(seed).alias("x0"), F.rand(seed + 1).alias("x1"), F.rand(seed + 2).alias("x2"), noise.alias("e"))
    df = df.withColumn("label", 20 + 10 * F.col("x0") + F.when(F.col("x1") > 0.5, 18.0).otherwise(2.0) * F.col("e"))
    return VectorAssembler(inputCols=["x0", "x1", "x2"], outputCol="features").transform(df).select("id", "label", "features")


def test_band_covers_its_share_and_beats_residual_quantiles(spark):
    train, holdout = uneven(spark, 6000, 1), uneven(spark, 4000, 50)
    point = modelling.train_value_model(train, maxIter=10, stepSize=0.3)
    band = quantiles.train_quantile_band(train, rounds=12, depth=3, step=0.4)
    found = quantiles.band_metrics(band.apply(point.transform(holdout))).first()
    assert abs(found["coverage"] - 0.8) < 0.05 and found["crossed"] >= 0
    conformal = modelling.fit_band(point.transform(train)).apply(point.transform(holdout))
    other = conformal.agg(quantiles.pinball_loss("label", "ci_lower", 0.1).alias("low"), quantiles.pinball_loss("label", "ci_upper", 0.9).alias("high")).first()
    assert found["loss_lower"] < 0.9 * other["low"] and found["loss_upper"] < 0.9 * other["high"]


def test_bounds_hold_the_point_and_trees_are_those_of_spark(spark):
    train = uneven(spark, 1000, 7)
    band = quantiles.train_quantile_band(train, rounds=2, depth=2, step=0.5)
    rows = band.apply(train.withColumn("prediction", F.col("label") - 15))
    assert rows.where("ci_lower > prediction or ci_upper < prediction or q_lower < 0").count() == 0 and "features" not in rows.columns
    # the structure read from a fitted tree gives the leaves that Spark gives
    from pyspark.ml.regression import DecisionTreeRegressor

    model = DecisionTreeRegressor(labelCol="label", maxDepth=3, leafCol="leaf").fit(train)
    placed = model.transform(train)
    leaves = int(placed.agg(F.max("leaf")).first()[0]) + 1
    tree = quantiles.Tree.of(model, {i: float(i) for i in range(leaves)}, 1.0)
    read = quantiles.predicted(placed.select("id", "leaf", "features"), {"own": quantiles.QuantileModel(0.5, 0.0, 3, [tree])})
    assert read.where("own <> leaf").count() == 0 and leaves > 4


def test_no_rows_and_one_value(spark):
    train = uneven(spark, 50, 9)
    empty = quantiles.train_quantile_model(train.limit(0), 0.9, rounds=3)
    assert (empty.base, empty.trees) == (0.0, [])
    same = quantiles.train_quantile_model(train.withColumn("label", F.lit(4.0)), 0.1, rounds=2)
    assert {r["q"] for r in quantiles.predicted(train, {"q": same}).collect()} == {4.0}
