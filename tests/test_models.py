import pytest
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import functions as F

from patronage.operators import modelling


@pytest.fixture(scope="module")
def frame(spark):
    return spark.range(400).select(
        F.col("id").cast("string").alias("customer_unique_id"), (F.col("id") % 20).alias("x"),
        F.when(F.col("id") % 4 != 0, F.col("id") % 7).alias("gaps"), F.lit(None).cast("double").alias("empty"),
        F.when(F.col("id") % 5 == 0, "A").otherwise("B").alias("state"), F.lit("card").alias("kind"),
        F.when(F.col("id") % 20 >= 10, 1.0).otherwise(0.0).alias("label"))


@pytest.fixture(scope="module")
def design(frame):
    return modelling.fit_design(frame, ("x", "gaps", "empty"), ("state", "kind"), zero_fill=("gaps",))


def test_fills_and_unknown_categories(spark, design):
    assert design.fills == {"x": 9.5, "gaps": 0.0, "empty": 0.0}
    unseen = spark.createDataFrame([(None, None, None, "Z", None)], "x double, gaps double, empty double, state string, kind string")
    assert design.transform(unseen).first()["features"].toArray().tolist() == [9.5, 0.0, 0.0, 0.0, 0.0, 0.0]


def test_holdouts_are_fixed_and_sized(frame):
    first, second = (modelling.with_holdout(frame).where("is_holdout = 1").count() for _ in range(2))
    assert first == second and 40 < first < 120
    sizes = modelling.with_stratified_holdout(frame, "label").groupBy("label").agg(F.sum("is_holdout")).collect()
    assert [r[1] for r in sizes] == [40, 40]


def test_churn_features_hold_no_leak():
    assert not set(modelling.EXCLUDED_FROM_CHURN) & set(modelling.CHURN_NUMERIC)


def test_churn_model_threshold_and_reload(frame, design, tmp_path):
    rows = design.transform(frame)
    model = modelling.train_churn_model(rows, maxIter=3)
    metrics = modelling.threshold_metrics(modelling.threshold_curve(modelling.with_probability(model.transform(rows)))).first()
    assert metrics["roc_auc"] == pytest.approx(1.0) and metrics["f1"] == pytest.approx(1.0)
    assert (metrics["tp"], metrics["tn"], metrics["fp"], metrics["fn"]) == (200, 200, 0, 0)
    modelling.save_scorer(str(tmp_path), model, design, threshold=metrics["threshold"])
    again, stored, details = modelling.load_scorer(str(tmp_path), GBTClassificationModel)
    assert details["threshold"] == metrics["threshold"] and stored.fills == design.fills
    assert again.transform(stored.transform(frame)).select("prediction").exceptAll(model.transform(rows).select("prediction")).count() == 0
    assert modelling.importances(model, design, frame, 1).first()["feature"] == "x"


def test_given_threshold(spark):
    scored = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.4, 1), (0.1, 0)], "probability double, label int")
    row = modelling.threshold_metrics(modelling.threshold_curve(scored), 0.5).first()
    assert (row["threshold"], row["tp"], row["fp"], row["fn"], row["tn"]) == (0.5, 1, 1, 1, 1)
    assert row["roc_auc"] == pytest.approx(0.75)


def test_value_model_beats_the_mean_and_its_band_orders(frame, design):
    rows = design.transform(frame.withColumn("label", F.col("x").cast("double") * 3))
    model = modelling.train_value_model(rows, maxIter=5, stepSize=0.5)
    scored = modelling.clipped(model.transform(rows))
    assert modelling.regression_metrics(scored).first()["r2"] > 0.9
    banded = modelling.fit_band(scored).apply(scored)
    assert banded.where("ci_lower > prediction or ci_upper < prediction or ci_lower < 0").count() == 0
    assert modelling.band_coverage(banded).first()[0] >= 0.7


def test_grid_search_picks_from_the_grid(frame, design):
    rows = design.transform(frame)
    model = modelling.train_value_model(rows, tune=True, folds=2, grid={"maxIter": (1, 2), "maxDepth": (2,)})
    assert model.getNumTrees in (1, 2)


def test_clusters_of_weighted_cells(spark):
    rfm = spark.range(300).select(F.col("id").cast("string").alias("customer_unique_id"),
                                  F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, 3).otherwise(5).alias("recency_score"),
                                  F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 3 == 1, 3).otherwise(1).alias("frequency_score"),
                                  F.lit(2).alias("monetary_score"))
    found = modelling.segment_clusters(rfm, forced_k=3)
    assert found.groupBy("recency_score").agg(F.count_distinct("km_cluster").alias("n")).where("n <> 1").count() == 0
    assert found.select("km_cluster").distinct().count() == 3


@pytest.mark.parametrize("rows", [4000, 60])
def test_starts_of_one_job_are_no_worse_than_fits_in_turn(spark, rows):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    table = spark.range(rows).select(*[(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(97 + i)) % 5 + 1).alias(c) for i, c in enumerate(modelling.SCORES)])
    cells = modelling.score_cells(table.where("recency_score < 4 or monetary_score > 2")).cache()
    found = {r["k"]: r for r in modelling.cluster_search(cells).collect()}
    places = VectorAssembler(inputCols=[f"z_{c}" for c in modelling.SCORES], outputCol="features").transform(cells)
    assert set(found) == {3, 4, 5, 6, 7}
    for k, row in found.items():
        fits = [KMeans(k=k, seed=42 + i, weightCol="weight", maxIter=50).fit(places).summary.trainingCost for i in range(5)]
        assert row["inertia"] <= min(fits) * 1.01 and -1 <= row["silhouette"] <= 1
    fitted = modelling.cluster_fits(cells, (3, 5), 4)
    assert fitted.count() == 2 * cells.count() and fitted.groupBy("k").agg(F.count_distinct("km_cluster").alias("n")).where("n <> k").count() == 0
    assert fitted.exceptAll(modelling.cluster_fits(cells.repartition(3), (3, 5), 4)).count() == 0


def test_fewer_cells_than_clusters(spark):
    rfm = spark.createDataFrame([("a", 1, 1, 1), ("b", 5, 5, 5), ("c", 5, 5, 5)], "customer_unique_id string, recency_score int, frequency_score int, monetary_score int")
    found = {r[0]: r[-1] for r in modelling.segment_clusters(rfm).select("customer_unique_id", "km_cluster").collect()}
    assert found["b"] == found["c"] != found["a"]
    assert modelling.segment_clusters(rfm.limit(0)).count() == 0


def test_threshold_curve_tells_close_scores_apart(spark):
    rows = [(0.5 + i * 1e-9, int(i * 7919 % 10 < 4)) for i in range(3000)]
    curve = modelling.threshold_curve(spark.createDataFrame(rows, "probability double, label int"))
    found = {r["threshold"]: (r["tp"], r["flagged"]) for r in curve.collect()}
    tp, wanted = 0, {}
    for flagged, (score, label) in enumerate(sorted(rows, reverse=True), 1):
        tp += label
        wanted[score] = (tp, flagged)
    assert found == wanted
    metrics = modelling.threshold_metrics(curve).first()
    lost, kept = [s for s, y in rows if y], [s for s, y in rows if not y]
    assert abs(metrics["roc_auc"] - sum(a > b for a in lost for b in kept) / (len(lost) * len(kept))) < 1e-12
    best = max(wanted, key=lambda s: (2 * wanted[s][0] / (wanted[s][1] + tp), -s))
    assert (metrics["threshold"], metrics["tp"]) == (best, wanted[best][0])
