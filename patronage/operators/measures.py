"""Dashboard measures: aggregates that can be evaluated over everything or per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as fx
from ..plans.views import mean_of, share_of_total
from .ranking import exact_percentiles

PERSON = "customer_unique_id"


def _rate(part: Column, whole: Column, digits: int = 4) -> Column:
    return F.coalesce(fx.ratio(part, whole, digits), F.lit(0))


def _rows() -> Column:
    return F.count(F.lit(1))


def _counts(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def _sum_where(value: str, condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col(value))), F.lit(0)).cast("decimal(20,2)")


def portfolio(health: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The customer table has one row per customer, so its rows are the distinct customers."""
    gmv, freight = F.sum("total_gmv"), F.sum("total_freight_paid")
    return health.groupBy(*by).agg(
        gmv.cast("decimal(20,2)").alias("total_gmv"), _rows().alias("total_customers"),
        mean_of("avg_order_value", 2).alias("avg_order_value"), freight.cast("decimal(20,2)").alias("total_freight_paid"),
        fx.share(freight, gmv).alias("freight_ratio"),
        F.coalesce(fx.ratio(gmv, _rows(), 2), F.lit(0)).alias("avg_gmv_per_customer"),
        F.max("as_of_date").alias("as_of_date"))


def churn(health: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    churned, risky = _counts(F.col("is_churned") == 1), _counts(F.col("churn_probability") >= fx.HIGH_CHURN_PROBABILITY)
    return health.groupBy(*by).agg(
        churned.alias("churned_customers"), _rate(churned, _rows()).alias("churn_rate"),
        mean_of("churn_probability", 4, 4).alias("avg_churn_probability"), risky.alias("high_churn_customers"),
        _rate(risky, _rows()).alias("high_churn_rate"), mean_of("pct_late_deliveries", 4, 4).alias("avg_pct_late"),
        mean_of("avg_delivery_delta_days", 2).alias("avg_delivery_delta"),
        mean_of("avg_review_score", 2).alias("avg_review_score"),
        mean_of("customer_health_score", 2).alias("avg_health_score"))


def urgency(signals: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return signals.groupBy(*by).agg(_rows().alias("at_risk_customers"), mean_of("urgency_score", 2).alias("avg_urgency_score"))


def actions(health: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A customer without an action counts as not monitored."""
    kind, level = F.col("latest_action_type"), F.col("latest_action_priority")
    active = F.coalesce(kind != "MONITOR", F.lit(True))
    return health.groupBy(*by).agg(
        _counts(level == "HIGH").alias("high_priority"), _counts(level == "MED").alias("med_priority"),
        _counts(level == "LOW").alias("low_priority"), _counts(active).alias("actionable_customers"),
        _rate(_counts(active), _rows()).alias("actionable_pct"), _sum_where("total_gmv", active).alias("flagged_gmv"),
        _sum_where("total_gmv", kind == "RETENTION_CAMPAIGN").alias("retention_gmv"),
        _sum_where("total_gmv", kind == "REACTIVATION").alias("reactivation_gmv"),
        _counts(kind == "RETENTION_CAMPAIGN").alias("retention_count"),
        _counts(kind == "REACTIVATION").alias("reactivation_count"), _counts(kind == "MONITOR").alias("monitor_count"))


def clv(health: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    by = list(by)
    value = F.col("clv_predicted_6m")
    sums = health.groupBy(*by).agg(
        F.count(value).alias("clv_with_prediction"), _rate(F.count(value), _rows()).alias("clv_coverage_pct"),
        mean_of("clv_predicted_6m", 2).alias("avg_clv"), F.max(value).alias("max_clv"),
        F.sum(value).alias("total_clv"))
    points = exact_percentiles(health, "clv_predicted_6m", {"median_clv": "0.5", "p90_clv": "0.9"}, by)
    points = points.select(*by, F.round("median_clv", 4).alias("median_clv"), F.round("p90_clv", 4).alias("p90_clv"))
    return sums.join(points, by, "left") if by else sums.crossJoin(F.broadcast(points))


def median_clv(health: DataFrame) -> DataFrame:
    return exact_percentiles(health, "clv_predicted_6m", {"median_clv": "0.5"})


def sentiment(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    label, scored = fx.sentiment_label("compound_score"), F.count("compound_score")
    return scores.groupBy(*by).agg(
        scored.alias("reviews_scored"), F.count("review_comment_message").alias("reviews_with_text"),
        *[_rate(_counts(label == name), scored).alias(f"pct_{name}") for name in ("positive", "neutral", "negative")],
        mean_of("compound_score", 4, 4).alias("avg_compound_score"),
        _counts(fx.sarcasm()).alias("sarcasm_flags"))


def customer_sentiment(health: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return health.groupBy(*by).agg(F.count("avg_sentiment_score").alias("customers_scored"),
                                   mean_of("avg_sentiment_score", 4, 4).alias("avg_sentiment"))


def geography(geo: DataFrame) -> DataFrame:
    """Each state's share of the national total. The table has one row per state."""
    return geo.select("customer_state", "total_gmv",
                      F.sum("total_gmv").over(Window.partitionBy(F.lit(1))).alias("national_gmv"),
                      share_of_total("total_gmv", 4).alias("state_gmv_share"))


def geography_averages(geo: DataFrame) -> DataFrame:
    return geo.agg(mean_of("churn_rate_pct", 2).alias("avg_state_churn_rate"),
                   mean_of("pct_late_deliveries", 2).alias("avg_state_late_pct"),
                   mean_of("avg_review_score", 2).alias("avg_state_review_score"))


def next_purchase(health: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    days = F.col("expected_next_purchase_days")
    return health.groupBy(*by).agg(
        F.count(days).alias("with_prediction"), mean_of(days, 2).alias("avg_next_purchase_days"),
        F.min(days).alias("min_next_purchase_days"))


def group_share(health: DataFrame, by: str) -> DataFrame:
    """Customers per group and their percent of all customers."""
    return health.groupBy(by).agg(_rows().alias("total_customers")).withColumn(
        "share_pct", share_of_total("total_customers"))


def readiness(health: DataFrame, queue: DataFrame, geo: DataFrame) -> DataFrame:
    """One row: PASS, or the first measure that has no value."""
    facts = health.agg(
        F.sum("total_gmv").alias("gmv"), _rows().alias("customers"), F.avg("churn_probability").alias("churn"),
        F.avg("clv_predicted_6m").alias("clv"), F.avg("avg_sentiment_score").alias("sentiment"),
        F.count_if(F.col("clv_predicted_6m").isNull()).alias("null_clv"),
        F.count_if(F.col("avg_sentiment_score").isNull()).alias("null_sentiment"),
        _counts(F.coalesce(F.col("latest_action_type") != "MONITOR", F.lit(True))).alias("actionable"))
    queued = queue.agg(_rows().alias("queue_rows"))
    national = geo.agg(F.sum("total_gmv").alias("national"))
    status = (F.when(F.col("gmv").isNull(), "FAIL: total_gmv blank")
              .when(F.col("customers") == 0, "FAIL: no customers")
              .when(F.col("churn").isNull(), "FAIL: churn_probability blank")
              .when(F.col("clv").isNull(), "FAIL: clv_predicted_6m blank")
              .when(F.col("sentiment").isNull(), "WARN: avg_sentiment_score blank")
              .when(F.col("actionable") == 0, "FAIL: no actions")
              .when(F.col("national").isNull(), "FAIL: no geography")
              .otherwise("PASS"))
    return facts.crossJoin(F.broadcast(queued)).crossJoin(F.broadcast(national)).select(
        status.alias("status"), "customers", "queue_rows", "null_clv", "null_sentiment")
