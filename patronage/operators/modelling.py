"""Fit and score with pyspark.ml: design matrix, splits, clustering, value and churn models."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, ship
from . import boosting
from .ranking import exact_percentiles, group_positions, running_sums

PERSON = "customer_unique_id"
SEED = 42

# fixed feature lists; the churn model must not see the idle days its label is made from, nor the health score
CLV_NUMERIC = ("total_orders_pre_cutoff", "avg_order_value_pre_cutoff", "order_frequency_per_month_pre_cutoff",
               "tenure_months_pre_cutoff", "days_since_last_order_pre_cutoff", "total_categories_purchased",
               "avg_delivery_delta", "pct_late", "is_single_order")
CLV_ZERO_FILL = ("order_frequency_per_month_pre_cutoff",)
CHURN_NUMERIC = ("total_orders", "total_gmv", "total_freight_paid", "avg_order_value", "avg_review_score",
                 "pct_negative_reviews", "avg_sentiment_score", "avg_delivery_delta_days", "pct_late_deliveries",
                 "total_categories_purchased")
CATEGORICAL = ("customer_state", "preferred_payment_type")
EXCLUDED_FROM_CHURN = ("days_since_last_order", "customer_health_score")
REFERENCE_CHURN_RATE = 0.7118
TREES = {"maxIter": 200, "maxDepth": 4, "stepSize": 0.05}
TUNING_GRID = {"maxIter": (100, 200, 400), "maxDepth": (3, 4, 6), "stepSize": (0.01, 0.05, 0.1)}


# -- design matrix -------------------------------------------------------------

@dataclass(frozen=True)
class Design:
    """Fill values and categories captured once and used for every later frame."""

    numeric: tuple[str, ...]
    fills: dict[str, float]
    encoder: PipelineModel

    def transform(self, df: DataFrame) -> DataFrame:
        return self.encoder.transform(_filled(df, self.numeric, self.fills))

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        self.encoder.write().overwrite().save(f"{path}/encoder")
        _write_json(spark, f"{path}/meta", {"numeric": self.numeric, "fills": self.fills})

    @staticmethod
    def load(path: str) -> Design:
        meta = _read_json(SparkSession.active(), f"{path}/meta")
        return Design(tuple(meta["numeric"]), meta["fills"], PipelineModel.load(f"{path}/encoder"))


def _write_json(spark: SparkSession, path: str, value: dict) -> None:
    spark.createDataFrame([(json.dumps(value),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def _read_json(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])


def _filled(df: DataFrame, numeric: Sequence[str], fills: dict[str, float]) -> DataFrame:
    return df.withColumns({f"num_{c}": F.coalesce(F.col(c).cast("double"), F.lit(fills[c])) for c in numeric})


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, median) of numeric columns, exact, all from one sort; a column without a value has no row."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])).alias("x"))
    return exact_percentiles(long.select("x.*"), "value", {"median": "0.5"}, ["column"])


def fit_design(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], zero_fill: Sequence[str] = ()) -> Design:
    """Median fills (0 where a column is all NULL or listed in ``zero_fill``) and one-hot categories.

    Unknown and missing categories become all zeros.
    """
    middle = {r["column"]: r["median"] for r in medians(df, [c for c in numeric if c not in zero_fill]).collect()}
    fills = {c: float(middle.get(c, 0.0)) for c in numeric}
    filled = _filled(df, numeric, fills)
    index = StringIndexer(inputCols=list(categorical), outputCols=[f"idx_{c}" for c in categorical],
                          handleInvalid="keep", stringOrderType="alphabetAsc").fit(filled)
    indexed = index.transform(filled)
    encode = OneHotEncoder(inputCols=[f"idx_{c}" for c in categorical], outputCols=[f"hot_{c}" for c in categorical],
                           dropLast=True).fit(indexed)
    assemble = VectorAssembler(inputCols=[f"num_{c}" for c in numeric] + [f"hot_{c}" for c in categorical],
                               outputCol="features")
    return Design(tuple(numeric), fills, PipelineModel([index, encode, assemble]))


def importances(model, design: Design, df: DataFrame, n: int = 10) -> DataFrame:
    """The n most important features with their names."""
    groups = design.transform(df.limit(0)).schema["features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for kind in groups.values() for a in kind}
    rows = [(names[i].replace("num_", "").replace("hot_", ""), float(v)) for i, v in enumerate(model.featureImportances.toArray())]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature").limit(n)


# -- splits --------------------------------------------------------------------

def _fate(key: str, seed: int) -> Column:
    return F.xxhash64(F.col(key), F.lit(seed))


def with_holdout(df: DataFrame, key: str = PERSON, holdout_percent: int = 20, seed: int = SEED) -> DataFrame:
    """Flag a fixed share of the keys, the same in every run and on any cluster."""
    return df.withColumn("is_holdout", F.when(F.pmod(_fate(key, seed), F.lit(100)) < holdout_percent, 1).otherwise(0))


def with_stratified_holdout(df: DataFrame, label: str, key: str = PERSON, holdout_percent: int = 20,
                            seed: int = SEED) -> DataFrame:
    """The same share of every class, to the row."""
    fates = df.select(key, label, _fate(key, seed).alias("fate"))
    sizes = fates.groupBy(label).agg(F.count(F.lit(1)).alias("size"))
    placed = group_positions(fates, [label], ["fate"], [key]).join(F.broadcast(sizes), label)
    chosen = placed.select(key, F.when(F.col("row") * 100 <= F.col("size") * holdout_percent, 1).otherwise(0).alias("is_holdout"))
    return df.join(chosen, key)


# -- clustering ----------------------------------------------------------------

SCORES = ("recency_score", "frequency_score", "monetary_score")
#: starts per k; the figures of a search and the clusters come from fits of as many starts or more
SEARCH_STARTS, FINAL_STARTS = 5, 10


def score_cells(rfm: DataFrame) -> DataFrame:
    """The at most 125 score combinations with their sizes, standardised over all customers."""
    cells = rfm.groupBy(*SCORES).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    shape = cells.agg(F.sum("weight").alias("n"), *[
        m for c in SCORES for m in (F.sum(F.col(c) * F.col("weight")).alias(f"{c}_s"),
                                    F.sum(F.col(c) * F.col(c) * F.col("weight")).alias(f"{c}_q"))])
    scaled = cells.crossJoin(F.broadcast(shape))
    columns = []
    for c in SCORES:
        mean = F.col(f"{c}_s") / F.col("n")
        spread = F.sqrt(F.greatest(F.col(f"{c}_q") / F.col("n") - mean * mean, F.lit(0.0)))
        columns.append(F.coalesce((F.col(c) - mean) / F.nullif(spread, F.lit(0.0)), F.lit(0.0)).alias(f"z_{c}"))
    return scaled.select(*SCORES, "weight", *columns)


def _lloyd(places: np.ndarray, weights: np.ndarray, k: int, rng: np.random.Generator, steps: int = 100) -> tuple[float, np.ndarray]:
    """Inertia and cluster per place of one start: seeds drawn far apart, then weighted means until nothing moves."""
    def distances(centres: np.ndarray) -> np.ndarray:
        return ((places[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)

    centres = places[[rng.choice(len(places), p=weights / weights.sum())]]
    while len(centres) < k:
        pull = distances(centres).min(axis=1) * weights
        if not pull.sum():
            break  # fewer distinct places than clusters
        centres = np.vstack([centres, places[rng.choice(len(places), p=pull / pull.sum())]])
    for _ in range(steps):
        nearest = distances(centres).argmin(axis=1)
        moved = np.array([np.average(places[nearest == c], axis=0, weights=weights[nearest == c]) if (nearest == c).any() else centres[c]
                          for c in range(len(centres))])
        if np.array_equal(moved, centres):
            break
        centres = moved
    far = distances(centres)
    return float((far.min(axis=1) * weights).sum()), far.argmin(axis=1)


def cluster_fits(cells: DataFrame, candidates: Sequence[int], starts: int, seed: int = SEED) -> DataFrame:
    """The fit of least inertia per k: a row per k and cell with ``k``, ``inertia``, ``km_cluster`` and the columns of ``cells``.

    Every (k, start) is a group of its own that holds the at most 125 cells, so all starts of all k run side by side in one
    job. Clusters are numbered by their first cell.
    """
    names = [*SCORES, "weight", *(f"z_{c}" for c in SCORES)]
    runs = cells.select(*names, F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(i).alias("start")) for k in candidates for i in range(starts)]))
                        .alias("run")).select(*names, "run.*")

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        rows = group.sort_values(list(SCORES)).reset_index(drop=True)
        k, start = int(rows["k"][0]), int(rows["start"][0])
        inertia, nearest = _lloyd(rows[[f"z_{c}" for c in SCORES]].to_numpy(), rows["weight"].to_numpy(), k, np.random.default_rng([seed, k, start]))
        _, first = np.unique(nearest, return_index=True)
        number = {nearest[place]: i for i, place in enumerate(sorted(first))}
        return rows.assign(inertia=inertia, km_cluster=[number[c] for c in nearest])

    schema = T.StructType([*runs.schema.fields, T.StructField("inertia", T.DoubleType()), T.StructField("km_cluster", T.IntegerType())])
    fitted = runs.groupBy("k", "start").applyInPandas(fit, schema)
    best = F.first("start").over(Window.partitionBy("k").orderBy("inertia", "start"))
    return fitted.withColumn("best", best).where(F.col("start") == F.col("best")).drop("best", "start")


def silhouette(labelled: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean Euclidean silhouette over all customers from the at most 125 cells with ``km_cluster`` and ``weight``, per ``by``.

    A customer is as far from its cell's others as zero, and its own cluster counts without itself, so the figure is that of
    the full table. Customers alone in their cluster count 0, as does everything when there is one cluster.
    """
    by = list(by)
    place = F.array(*[f"z_{c}" for c in SCORES])
    one = labelled.select(*by, F.struct(*SCORES).alias("cell"), F.col("km_cluster").alias("own"), F.col("weight").alias("w"), place.alias("at"))
    other = labelled.select(*by, "km_cluster", "weight", place.alias("to"))
    apart = F.sqrt(F.aggregate(F.zip_with("at", "to", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda total, x: total + x))
    paired = one.join(F.broadcast(other), by) if by else one.crossJoin(F.broadcast(other))
    met = paired.groupBy(*by, "cell", "own", "w", "km_cluster").agg(F.sum(apart * F.col("weight")).alias("far"), F.sum("weight").alias("size"))
    mine = F.col("km_cluster") == F.col("own")
    sides = met.groupBy(*by, "cell", "own", "w").agg(
        F.sum(F.when(mine & (F.col("size") > 1), F.col("far") / (F.col("size") - 1))).alias("a"),
        F.min(F.when(~mine, F.col("far") / F.col("size"))).alias("b"))
    value = F.coalesce((F.col("b") - F.col("a")) / F.nullif(F.greatest("a", "b"), F.lit(0.0)), F.lit(0.0))
    mean = F.sum(F.when(F.col("a").isNull() | F.col("b").isNull(), F.lit(0.0)).otherwise(value) * F.col("w")) / F.sum("w")
    return sides.groupBy(*by).agg(mean.alias("silhouette"))


def cluster_search(cells: DataFrame, candidates: Sequence[int] = range(3, 8), seed: int = SEED) -> DataFrame:
    """(k, inertia, silhouette) per candidate. Weighted cells give the figures of the full table."""
    return _judged(materialize(cluster_fits(cells, candidates, SEARCH_STARTS, seed), "cluster-fits"))


def _judged(fits: DataFrame) -> DataFrame:
    return fits.groupBy("k").agg(F.first("inertia").alias("inertia")).join(silhouette(fits, ["k"]), "k")


def segment_clusters(rfm: DataFrame, forced_k: int | None = None, candidates: Sequence[int] = range(3, 8),
                     seed: int = SEED) -> DataFrame:
    """``km_cluster`` per customer; k is the candidate with the best silhouette (the least k on a tie) unless forced."""
    fits = materialize(cluster_fits(score_cells(rfm), [forced_k] if forced_k else candidates, FINAL_STARTS, seed), "cluster-fits")
    if forced_k is None:
        fits = fits.join(F.broadcast(_judged(fits).orderBy(F.desc("silhouette"), "k").limit(1).select("k")), "k")
    return rfm.join(F.broadcast(fits.select(*SCORES, "km_cluster")), list(SCORES), "left")


# -- value model ---------------------------------------------------------------

def train_value_model(train: DataFrame, label: str = "label", tune: bool = False, seed: int = SEED, folds: int = 3,
                      grid: dict[str, Sequence] | None = None, **settings):
    """Boosted trees with the squared loss; one task grows them all where it holds the rows."""
    base = GBTRegressor(featuresCol="features", labelCol=label, predictionCol="prediction", seed=seed, **(TREES | settings))
    if not tune:
        shape = boosting.in_one_task(train, label) if settings.keys() <= boosting.SETTINGS else None
        return boosting.boosted(base, GBTRegressionModel, train, shape, label) if shape else base.fit(train)
    builder = ParamGridBuilder()
    for name, values in (grid or TUNING_GRID).items():
        builder = builder.addGrid(base.getParam(name), list(values))
    search = CrossValidator(estimator=base, estimatorParamMaps=builder.build(), numFolds=folds, seed=seed,
                            evaluator=RegressionEvaluator(labelCol=label, metricName="mae"))
    return search.fit(train).bestModel


def clipped(scored: DataFrame) -> DataFrame:
    """Values cannot be negative."""
    return scored.withColumn("prediction", F.greatest("prediction", F.lit(0.0)))


def regression_metrics(scored: DataFrame, label: str = "label") -> DataFrame:
    error = F.col("prediction") - F.col(label)
    sums = scored.agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(error)).alias("mae"), F.avg(error * error).alias("mse"),
                      F.var_pop(label).alias("variance"), F.avg(label).alias("mean_actual"),
                      F.avg("prediction").alias("mean_predicted"))
    return sums.select("n", "mae", F.sqrt("mse").alias("rmse"),
                       (F.lit(1.0) - F.col("mse") / F.nullif("variance", F.lit(0.0))).alias("r2"), "mean_actual", "mean_predicted")


def _bin(value: str, limits: Sequence[float]) -> Column:
    return reduce(lambda total, limit: total + F.when(F.col(value) > limit, 1).otherwise(0), limits, F.lit(0))


def quantile_limits(df: DataFrame, value: str, bins: int) -> list[float]:
    points = {f"q{i}": str(round(i / bins, 6)) for i in range(1, bins)}
    return sorted({v for v in exact_percentiles(df, value, points).first() or () if v is not None})


@dataclass(frozen=True)
class Band:
    """Split-conformal interval: holdout residual quantiles per decile of the prediction."""

    limits: list[float]
    offsets: dict[int, tuple[float, float]]

    def apply(self, scored: DataFrame) -> DataFrame:
        place = _bin("prediction", self.limits)
        pick = lambda side: F.coalesce(*[F.when(place == b, F.lit(o[side])) for b, o in self.offsets.items()], F.lit(0.0))
        low = F.greatest(F.col("prediction") + pick(0), F.lit(0.0))
        high = F.col("prediction") + pick(1)
        return scored.withColumns({"ci_lower": F.least(low, F.col("prediction")),
                                   "ci_upper": F.greatest(high, F.col("prediction"))})


def fit_band(holdout: DataFrame, label: str = "label", lower: float = 0.1, upper: float = 0.9, deciles: int = 10) -> Band:
    limits = quantile_limits(holdout, "prediction", deciles)
    residuals = holdout.withColumn("_bin", _bin("prediction", limits)).withColumn("_r", F.col(label) - F.col("prediction"))
    rows = exact_percentiles(residuals, "_r", {"low": str(lower), "high": str(upper)}, ["_bin"]).collect()  # one per decile
    return Band(limits, {r["_bin"]: (r["low"], r["high"]) for r in rows})


def band_coverage(scored: DataFrame, label: str = "label") -> DataFrame:
    inside = (F.col(label) >= F.col("ci_lower")) & (F.col(label) <= F.col("ci_upper"))
    return scored.agg(F.avg(F.when(inside, 1.0).otherwise(0.0)).alias("coverage"))


# -- churn model ---------------------------------------------------------------

def train_churn_model(train: DataFrame, label: str = "label", reference_rate: float = REFERENCE_CHURN_RATE,
                      seed: int = SEED, **settings):
    """Lost customers weigh (1 - rate) / rate, with the rate fixed beforehand; one task grows all trees where it holds the rows."""
    weight = F.when(F.col(label) == 1, F.lit((1 - reference_rate) / reference_rate)).otherwise(F.lit(1.0))
    base, rows = GBTClassifier(featuresCol="features", labelCol=label, weightCol="weight", seed=seed, **(TREES | settings)), train.withColumn("weight", weight)
    shape = boosting.in_one_task(rows, label) if settings.keys() <= boosting.SETTINGS else None
    return boosting.boosted(base, GBTClassificationModel, rows, shape, label, "weight") if shape else base.fit(rows)


def with_probability(scored: DataFrame, digits: int | None = None) -> DataFrame:
    value = vector_to_array("probability")[1]
    return scored.withColumn("probability", value if digits is None else F.round(value, digits))


def threshold_curve(scored: DataFrame, label: str = "label") -> DataFrame:
    """Precision, recall and F1 at every distinct score, unrounded; the sums run over range partitions."""
    counts = scored.groupBy(F.col("probability").alias("threshold")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.count(F.lit(1)).alias("n"))
    totals = counts.agg(F.sum("pos").alias("positives"), F.sum("n").alias("total"))
    curve = running_sums(counts, [F.desc("threshold")], {"tp": "pos", "flagged": "n"}).crossJoin(F.broadcast(totals))
    precision = F.col("tp") / F.col("flagged")
    recall = F.coalesce(F.col("tp") / F.nullif(F.col("positives"), F.lit(0)), F.lit(0.0))
    f1 = F.coalesce(F.lit(2.0) * F.col("tp") / F.nullif(F.col("flagged") + F.col("positives"), F.lit(0)), F.lit(0.0))
    return curve.withColumns({"precision": precision, "recall": recall, "f1": f1})


def threshold_metrics(curve: DataFrame, threshold: float | None = None) -> DataFrame:
    """The F1-best threshold (the lowest on a tie) or a given one, with its metrics, ROC-AUC and confusion counts."""
    above = F.col("tp") - F.col("pos")
    area = F.sum((F.col("n") - F.col("pos")) * (above + F.col("pos") / 2))
    negatives = F.max("total") - F.max("positives")
    auc = curve.agg((area / F.nullif(F.max("positives") * negatives, F.lit(0))).alias("roc_auc"))
    if threshold is None:
        best = curve.orderBy(F.desc("f1"), F.asc("threshold")).limit(1)
    else:
        best = curve.where(F.col("threshold") >= threshold).orderBy(F.asc("threshold")).limit(1).withColumn(
            "threshold", F.lit(float(threshold)))
    fp = F.col("flagged") - F.col("tp")
    fn = F.col("positives") - F.col("tp")
    return best.select("threshold", "f1", "precision", "recall", (F.col("total") - F.col("positives") - fp).alias("tn"),
                       fp.alias("fp"), fn.alias("fn"), "tp").crossJoin(F.broadcast(auc))


def save_scorer(path: str, model, design: Design, **details) -> None:
    """Model, categories, fills and anything else needed to score later."""
    model.write().overwrite().save(f"{path}/model")
    design.save(f"{path}/design")
    _write_json(SparkSession.active(), f"{path}/details", details)


def load_scorer(path: str, model_class) -> tuple[object, Design, dict]:
    return (model_class.load(f"{path}/model"), Design.load(f"{path}/design"),
            _read_json(SparkSession.active(), f"{path}/details"))


ship(__name__)
