"""Model steps from marts to stored scores: split, fit, evaluate, refit on all rows, score."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import modelling, quantiles, survival
from ..operators.actions import assign_actions
from ..operators.rules import with_segment
from ..operators.sentiment import customer_sentiment, score_reviews
from ..session import materialize
from ..sources.files import write_back
from .gold import PERSON, Facts, Gold, churn_training_frame, clv_training_frame, pre_cutoff_features


def value_frame(facts: Facts, items: DataFrame, products: DataFrame, clv: DataFrame, cutoff: str) -> DataFrame:
    frame = clv_training_frame(pre_cutoff_features(facts.orders, items, products, cutoff), clv)
    return frame.withColumn("label", F.col("actual_gmv_post_cutoff").cast("double"))


#: rows that one task takes in a pass of boosting; a pass over fewer costs less than to start and gather another task
ROWS_PER_TASK = 20_000


def _designed(frame: DataFrame, numeric, zero_fill=()) -> tuple[DataFrame, modelling.Design]:
    """Stored rows with features, so that boosting rounds do not repeat the work above, in as many tasks as they ask for."""
    design = modelling.fit_design(frame, numeric, modelling.CATEGORICAL, zero_fill)
    rows = materialize(design.transform(frame).select(PERSON, "label", "features"), "features")
    return rows.coalesce(max(1, -(-rows.count() // ROWS_PER_TASK))), design


def _side_by_side(*steps) -> list:
    """Results of steps that do not need each other; each is hundreds of small jobs that leave room."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [started.result() for started in [pool.submit(step) for step in steps]]


@dataclass(frozen=True)
class ValueRun:
    metrics: DataFrame
    coverage: DataFrame
    predictions: DataFrame


def run_value_model(frame: DataFrame, tune: bool = False, band: str = "quantile", band_settings: dict | None = None, **settings) -> ValueRun:
    """Holdout metrics and interval, then predictions of a model refitted on all customers.

    The interval is that of two quantile models (``band_settings``: rounds, depth, step), or of residual quantiles
    per decile of the prediction with ``band="conformal"``, which costs no further fits.
    """
    rows, _ = _designed(frame, modelling.CLV_NUMERIC, modelling.CLV_ZERO_FILL)
    rows = modelling.with_holdout(rows)
    kept = rows.where(F.col("is_holdout") == 0)
    chosen = {"rounds": settings.get("maxIter", modelling.TREES["maxIter"])} | (band_settings or {})
    bands = () if band == "conformal" else (lambda: quantiles.train_quantile_band(kept, **chosen), lambda: quantiles.train_quantile_band(rows, **chosen))
    model, final, *bands = _side_by_side(lambda: modelling.train_value_model(kept, tune=tune, **settings),
                                         lambda: modelling.train_value_model(rows, **settings), *bands)
    holdout = modelling.clipped(model.transform(rows.where(F.col("is_holdout") == 1)))
    if band == "conformal":
        fitted = modelling.fit_band(holdout)
        coverage, scored = modelling.band_coverage(fitted.apply(holdout)), fitted.apply(modelling.clipped(final.transform(rows)))
    else:
        tried, whole = bands
        coverage = quantiles.band_metrics(tried.apply(holdout)).select("coverage")
        scored = whole.apply(modelling.clipped(final.transform(rows)))
    predictions = scored.select(PERSON, F.round("prediction", 2).cast("decimal(14,2)").alias("clv_predicted_6m"),
                                F.round("ci_lower", 2).cast("decimal(14,2)").alias("clv_ci_lower"),
                                F.round("ci_upper", 2).cast("decimal(14,2)").alias("clv_ci_upper"))
    return ValueRun(modelling.regression_metrics(holdout), coverage, predictions)


@dataclass(frozen=True)
class ChurnRun:
    metrics: DataFrame
    importances: DataFrame
    predictions: DataFrame


def run_churn_model(frame: DataFrame, threshold: float | None = None, **settings) -> ChurnRun:
    """Threshold and metrics on a stratified holdout, then probabilities of a model refitted on all customers."""
    frame = frame.withColumn("label", F.col("is_churned").cast("double"))
    rows, design = _designed(frame, modelling.CHURN_NUMERIC)
    rows = modelling.with_stratified_holdout(rows, "label")
    model, final = _side_by_side(lambda: modelling.train_churn_model(rows.where(F.col("is_holdout") == 0), **settings),
                                 lambda: modelling.train_churn_model(rows, **settings))
    holdout = modelling.with_probability(model.transform(rows.where(F.col("is_holdout") == 1)))
    metrics = modelling.threshold_metrics(modelling.threshold_curve(holdout), threshold)
    predictions = modelling.with_probability(final.transform(rows), 4).select(
        PERSON, F.col("probability").cast("decimal(6,4)").alias("churn_probability"))
    return ChurnRun(metrics, modelling.importances(model, design, frame), predictions)


@dataclass(frozen=True)
class PurchaseRun:
    concordance: DataFrame
    predictions: DataFrame


def run_next_purchase(orders: DataFrame, constants: DataFrame, profile: DataFrame, clv: DataFrame) -> PurchaseRun:
    """Weibull AFT over all intervals; expected further days for the customers with an open interval."""
    intervals = survival.with_covariates(survival.purchase_intervals(orders, constants), profile, clv)
    design = modelling.fit_design(intervals, survival.NUMERIC, survival.CATEGORICAL)
    rows = materialize(design.transform(intervals).select(
        PERSON, "duration", "event", "days_since_last_order", "features"), "intervals")
    model = survival.train_survival(rows)
    open_rows = rows.where(F.col("event") == 0)
    return PurchaseRun(survival.concordance(model.transform(rows)), survival.expected_next_purchase(model, open_rows))


def scored_sentiment(scores: DataFrame, lexicon: DataFrame, texts: DataFrame | None = None, key: str = "review_id", **words) -> DataFrame:
    """The review table with scores for the texts that had none.

    ``texts`` is the same table with whole texts, where ``scores`` has only a word in the place of each; these meet the scores by ``key`` then.
    """
    return write_back(scores, score_reviews(scores if texts is None else texts, lexicon, key=key, **words), key)


def score_all(gold: Gold, facts: Facts, items: DataFrame, products: DataFrame, lexicon: DataFrame | None, cutoff: str,
              forced_k: int | None = None, created_at: str | None = None, band_settings: dict | None = None,
              words: dict | None = None, **settings) -> dict[str, DataFrame]:
    """All scoring steps in order: sentiment, segments, value, churn, next purchase, actions. Also what the models say of themselves.

    Without a lexicon the reviews are taken as scored before.
    """
    scores = gold.sentiment_scores if lexicon is None else materialize(scored_sentiment(gold.sentiment_scores, lexicon, **(words or {})), "scores")
    profile = write_back(gold.customer_360, customer_sentiment(scores), PERSON)
    rfm = materialize(modelling.segment_clusters(with_segment(gold.rfm_features), forced_k), "rfm")
    clv = materialize(gold.clv_features, "clv")
    profile = materialize(profile, "customer-360")
    # no model reads what another one predicts
    value, churn, purchase = _side_by_side(
        lambda: run_value_model(value_frame(facts, items, products, clv, cutoff), band_settings=band_settings, **settings),
        lambda: run_churn_model(churn_training_frame(profile, clv), **settings),
        lambda: run_next_purchase(facts.orders, gold.run_constants, profile, clv))
    scored_clv = materialize(write_back(clv, value.predictions, PERSON), "clv")
    scored_profile = materialize(write_back(write_back(profile, churn.predictions, PERSON), purchase.predictions, PERSON), "customer-360")
    clv, profile = scored_clv, scored_profile
    inputs = profile.select(PERSON, "churn_probability", "is_churned", "health_tier").join(
        rfm.select(PERSON, "rfm_segment"), PERSON).join(clv.select(PERSON, "clv_predicted_6m"), PERSON, "left")
    queue = materialize(assign_actions(inputs, created_at=created_at), "action-queue")
    return {"customer_360": profile, "rfm_features": rfm, "clv_features": clv, "sentiment_scores": scores,
            "action_queue": queue, "value_metrics": value.metrics.crossJoin(F.broadcast(value.coverage)),
            "churn_metrics": churn.metrics, "churn_importances": churn.importances, "survival_concordance": purchase.concordance,
            "next_purchase": purchase.predictions}
