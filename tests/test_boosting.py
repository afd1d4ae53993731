"""Trees grown in one task are those of pyspark.ml, and take few jobs."""

import numpy as np
import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from patronage.operators import boosting, modelling, quantiles

NUMBERS = ("a", "b", "c", "same")


@pytest.fixture(scope="module")
def rows(spark):
    """Numbers with ties and zeros, one of a single value, and categories; one partition."""
    df = spark.range(0, 700, 1, 1).select(
        "id", F.round(F.rand(1) * 100, 1).alias("a"), (F.col("id") % 7).alias("b"),
        F.when(F.rand(3) > 0.4, F.round(F.randn(4), 2)).otherwise(0.0).alias("c"), F.lit(3.5).alias("same"),
        (F.rand(5) * 6).cast("int").cast("string").alias("state"), F.lit("card").alias("kind"), F.randn(8).alias("e"))
    df = df.withColumn("label", F.round(F.col("a") * F.col("b") + 20 * F.col("c") + F.when(F.col("state") == "3", 50.0).otherwise(0.0) + 30 * F.col("e"), 2))
    df = df.withColumn("lost", (F.col("label") > 150).cast("double")).toPandas()
    df = spark.createDataFrame(df).coalesce(1)
    return modelling.fit_design(df, NUMBERS, ("state", "kind")).transform(df).select("id", "label", "lost", "features").cache()


def nodes(model, path):
    model.write().save(str(path))
    stored = model_rows(path).select("treeID", "nodeData.*").orderBy("treeID", "id").collect()
    return [r.asDict(recursive=True) for r in stored]


def model_rows(path):
    from pyspark.sql import SparkSession

    return SparkSession.active().read.parquet(f"{path}/data")


def left_to_spark(monkeypatch):
    monkeypatch.setattr(boosting, "in_one_task", lambda *_: None)


def test_value_trees_are_those_of_spark(rows, tmp_path):
    settings = {"maxIter": 12, "maxDepth": 4, "stepSize": 0.3}
    found = modelling.train_value_model(rows, **settings)
    wanted = GBTRegressor(labelCol="label", seed=42, **settings).fit(rows)
    assert nodes(found, tmp_path / "found") == nodes(wanted, tmp_path / "wanted")
    assert found.featureImportances == wanted.featureImportances and found.treeWeights == wanted.treeWeights
    assert found.transform(rows).exceptAll(wanted.transform(rows)).count() == 0


def test_churn_probabilities_are_those_of_spark(rows, monkeypatch):
    found = modelling.train_churn_model(rows, "lost", maxIter=8)
    left_to_spark(monkeypatch)
    wanted = modelling.train_churn_model(rows, "lost", maxIter=8)
    assert found.featureImportances.toArray() == pytest.approx(wanted.featureImportances.toArray(), rel=1e-9)
    both = [[r[0][1] for r in m.transform(rows).orderBy("id").select("probability").collect()] for m in (found, wanted)]
    assert both[0] == pytest.approx(both[1], rel=1e-9) and len(set(both[0])) > 20


def test_quantile_trees_are_those_of_the_rounds_in_spark(rows, monkeypatch):
    settings = {"rounds": 3, "depth": 3, "step": 0.5}
    found = [quantiles.train_quantile_model(rows, share, **settings) for share in (0.1, 0.9)]
    left_to_spark(monkeypatch)
    assert found == [quantiles.train_quantile_model(rows, share, **settings) for share in (0.1, 0.9)]


def test_a_fit_takes_few_jobs(spark, rows):
    # by jobs of a level each, these are hundreds
    spark.sparkContext.setJobGroup("few-jobs", "boosting")
    try:
        modelling.train_value_model(rows, maxIter=40)
        quantiles.train_quantile_model(rows, 0.5, rounds=40)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < len(spark.sparkContext.statusTracker().getJobIdsForGroup("few-jobs")) < 40


def test_sums_of_several_features_at_once_are_those_of_each(monkeypatch):
    draw = np.random.default_rng(5)
    numbers, marks = np.round(draw.normal(size=(500, 3)), 1), (draw.random((500, 11)) < 0.2).astype(np.uint8)
    marked, weights = tuple(range(2, 13)), draw.random(500)
    one = boosting.Table.of(numbers, marks, marked, weights, True)
    monkeypatch.setattr(boosting, "EXACT_ROWS", 0)
    many = boosting.Table.of(numbers, marks, marked, weights, True)
    assert one.exact and not many.exact and one.feature == many.feature == list(range(14))
    place, amounts = draw.integers(0, 3, 500), [draw.normal(size=500), weights]
    for rows in (None, np.flatnonzero(draw.random(500) < 0.5)):
        part = [place, *amounts] if rows is None else [x[rows] for x in (place, *amounts)]
        for a, b in zip(one.sums(part[0], rows, 3, part[1:]), many.sums(part[0], rows, 3, part[1:]), strict=True):
            assert np.allclose(a, b)


def test_what_a_task_does_not_take_is_left_to_spark(spark, rows, monkeypatch):
    assert boosting.in_one_task(rows, "label").rows == 700
    assert boosting.in_one_task(rows.withColumn("label", F.when(F.col("id") > 0, F.col("label"))), "label") is None
    assert boosting.in_one_task(rows.limit(1), "label") is None and boosting.in_one_task(rows.limit(0), "label") is None
    monkeypatch.setattr(boosting, "TASK_BYTES", 1000)
    assert boosting.in_one_task(rows, "label") is None
